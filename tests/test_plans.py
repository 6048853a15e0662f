"""Shapes of the physical plans that matter at scale, and the entry points."""

import importlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold, incremental, ingest, monitoring
from ledgerlake.plans import silver
from ledgerlake.plans.catalog import spark_queries, sql_checks
from ledgerlake.plans.fixtures import Fixtures
from ledgerlake.sources import readers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF)


def plan(df) -> str:
    jvm = df.sparkSession._jvm.org.apache.spark.sql.execution
    return df._jdf.queryExecution().explainString(jvm.ExplainMode.fromString("simple"))


def shuffles(df) -> int:
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", plan(df)))


@pytest.mark.parametrize("build, view", [(silver.silver_fraud, "tx_events"), (silver.silver_credit, "account_snapshots"), (silver.silver_churn, "crm_events")])
def test_all_features_of_a_use_case_share_one_shuffle_and_sort(fx, build, view):
    df = build(fx(view))
    assert shuffles(df) == 1
    assert len(re.findall(r"[-+*] Sort |\) Sort ", plan(df))) == 1


def test_gold_is_one_partial_aggregate(fx):
    df = gold.gold_fraud_hourly(fx("tx_scores"))
    assert shuffles(df) == 1 and "partial_count" in plan(df)


def test_rank_filters_prune_before_the_shuffle(fx):
    for df in (incremental.top1_per_key(fx("tx_scores"), ["customer_id"], [F.desc("event_time")]),
               ingest.dedup_events(fx("tx_deliveries"), "event_id", "seq"), monitoring.rate_limit(fx("api_requests"))):
        assert "WindowGroupLimit" in plan(df) and "Partial" in plan(df)


def test_watermark_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    Fixtures(spark, SF)("tx_scores").write.parquet(path)
    fact = readers.read_table(spark, path, ["event_time", "fraud_score"])
    from datetime import datetime

    text = plan(incremental.new_rows(fact, datetime(2024, 1, 15)).select("fraud_score"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(event_time", text)
    assert "ReadSchema: struct<fraud_score:double,event_time:timestamp>" in text


def test_no_query_needs_a_cross_join(spark):
    skip = ("train", "score_fraud_model", "stream_score", "stream_dedup")  # minutes of fitting or state; their plans are scans
    for name, query in spark_queries().items():
        if not name.startswith(skip):
            text = plan(query(spark, SF))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_records_are_parsed_once(fx):
    from ledgerlake.plans.catalog_lake import raw_stream

    raw = raw_stream(fx)
    good, _ = ingest.split_valid(ingest.parse_events(raw))
    assert plan(good).count("Generate explode") == 1
    assert plan(good.select("event_id")).split("Generate")[0].count("parseJson") == 0


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100 and len(sql_checks()) >= 95
