"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that change results or physical plans. All are runtime settings, so they can
# be applied to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


SHUFFLE_BYTES = 1024**3  # of input per shuffle partition


def shuffle_partitions(input_bytes: int, least: int = 200) -> int:
    """Shuffle partitions that keep one task's share in memory: about 100,000 for 100 TB.

    Adaptive execution joins partitions that turn out small, so this is an upper bound. A stream
    keeps the number it was first started with.
    """
    return max(least, -(-input_bytes // SHUFFLE_BYTES))


def state_session(spark: SparkSession, rows: int, rows_each: int = 500_000, least: int = 8) -> SparkSession:
    """A session for streams whose state holds ``rows`` rows: a stream keeps its number of state partitions for
    good and pays for every one of them in every micro-batch, so it follows the data. Being a session of its own, it
    leaves the settings of others alone."""
    own = configure(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(max(least, -(-rows // rows_each))))
    return own


def build_session(app: str = "ledgerlake", master: str | None = None, input_bytes: int | None = None, **conf: str
                  ) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``.

    Only with a local master, where driver and executors are one process, does an unset folder
    fall back to a temporary one of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back. Lineage ends there, the planner knows the
    size, and a join with it shuffles both sides, so that adaptive execution can split a hot key."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever storage it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def instant(value):
    """A literal instant. A datetime without a zone means UTC, as text and dates do; left to the
    driver it would be read in the zone of the driver's machine."""
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value).cast("timestamp")
