import pytest

from ledgerlake.llm.common import prepare


@pytest.fixture
def llm(spark):
    return prepare(spark)
