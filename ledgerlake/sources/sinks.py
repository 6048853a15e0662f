"""Writers. A table is never overwritten from a plan that still reads it."""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import AUDIT, Contract
from ledgerlake.operators.incremental import top1_per_key, upsert_latest
from ledgerlake.operators.quality import QualityError, check_contract
from ledgerlake.session import instant, remove, shared_dir
from ledgerlake.sources.publish import publish_partitions, publish_table, read_folders, recover

# Statement keywords that are refused as table names.
RESERVED = ("SELECT", "DROP", "DELETE", "INSERT", "UPDATE", "EXEC", "EXECUTE", "ALTER", "CREATE", "TRUNCATE",
            "MERGE", "UNION", "GRANT", "REVOKE")
MAX_ERRORS = 100
LOAD_STATS = "`table` string, rows_loaded bigint, rows_rejected bigint, load_type string, loaded_at timestamp"
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # the default would drop microseconds


def identifier(name: str) -> str:
    """A table name that is safe to place into a path or statement."""
    if not re.fullmatch(r"[A-Za-z0-9_]{1,128}", name) or name.upper() in RESERVED or not name.strip("_"):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def write_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("timestampFormat", JSON_TIME).json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                sort_by: list[str] | None = None, dynamic: bool = False) -> None:
    """Parquet. Rows of one partition value are spread over several writers when they are many:
    the rebalance hint splits large partitions by size at run time.

    Overwriting replaces the whole table, whatever the session says; with ``dynamic`` only the
    partitions that ``df`` has rows for.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolving the schema is the check
        return True
    except AnalysisException:
        return False


def exists_json(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder of JSON Lines; an empty one counts, a missing one does not."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, for as long as it is needed: its plan runs
    once, and a lost executor or a repeated step copies finished files."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "staged")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions ``df`` has rows for, also when ``df`` reads the table itself."""
    publish_partitions(df, path, partition_by)


def _merge_partitions(spark: SparkSession, path: str, good: DataFrame, keys: list[str], column: str) -> None:
    """Upsert into a partitioned table, touching only partitions that gain, lose or change a row.

    A key may come back under another partition value: the partitions that hold the keys now
    are found by a semi join, and one that is left without rows is removed.
    """
    table = spark.read.parquet(path)
    where_now = table.join(good.select(*keys), keys, "left_semi").select(column)
    touched = good.select(column).unionByName(where_now).distinct().withColumnRenamed(column, "__part")
    # A null partition is one like any other, so the join must be null-safe.
    existing = table.join(touched, F.col(column).eqNullSafe(F.col("__part")), "left_semi")
    merged = upsert_latest(existing.select(*good.columns), good, keys)
    publish_partitions(merged, path, [column], read_folders(existing, path))


def load_table(
    df: DataFrame,
    root: str,
    table: str,
    contract: Contract,
    keys: list[str],
    mode: str = "incremental",
    partition_by: str | None = None,
    loaded_at: datetime | None = None,
    max_errors: int = MAX_ERRORS,
) -> DataFrame:
    """Load rows into ``root/table`` and return the load statistics row.

    ``full`` replaces the table, ``incremental`` upserts by key, so repeating a load adds nothing; a
    key that repeats within a load counts once, by its latest row. Up to ``max_errors`` rows
    may break the contract; they go to ``root/table_rejected`` with what they broke. The input is
    computed once, into a staged copy, and the table is published whole: a load that fails at any
    point leaves the old rows, or the new ones once they are complete.
    """
    loads = load_unlogged(df, root, table, contract, keys, mode, partition_by, loaded_at, max_errors)
    log_load(loads, f"{root.rstrip('/')}/load_log")
    return loads.drop("duration_seconds")


def load_unlogged(df: DataFrame, root: str, table: str, contract: Contract, keys: list[str], mode: str = "incremental",
                  partition_by: str | None = None, loaded_at: datetime | None = None, max_errors: int = MAX_ERRORS) -> DataFrame:
    """``load_table`` without its line in the load log, which loads that run side by side must write together: a
    folder takes one appending job at a time. The row returned has the duration, as the log does."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown load mode: {mode}")
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{identifier(table)}"
    recover(spark, path)
    began = time.monotonic()
    broken = F.size("violations") > 0
    with staged(check_contract(df, contract, values=True)) as checked:
        counts = checked.agg(F.count_if(~broken).alias("good"), F.count_if(broken).alias("bad")).first()
        if counts["bad"] > max_errors:
            raise QualityError(f"{table}: {counts['bad']} bad rows, {max_errors} allowed")
        if counts["bad"]:
            rejected = checked.where(broken).withColumn("rejected_at", instant(loaded_at))
            write_table(rejected, f"{path}_rejected", mode="append")
        good = top1_per_key(checked.where(~broken).drop("violations"), keys, [F.desc("updated_at")])
        parts = [partition_by] if partition_by else []
        if mode == "full" or not exists(spark, path):
            publish_table(good, path, parts)
        elif partition_by:
            _merge_partitions(spark, path, good, keys, partition_by)
        else:
            publish_table(upsert_latest(spark.read.parquet(path).select(*df.columns), good, keys), path)
    stats = [(table, counts["good"], counts["bad"], mode, loaded_at, round(time.monotonic() - began, 3))]
    return spark.createDataFrame(stats, f"{LOAD_STATS}, duration_seconds double")


def log_load(stats: DataFrame, path: str) -> None:
    """Append to the load log: what was loaded, rejected, when, and how long it took."""
    stats.write.mode("append").json(path)


def audit_rows(events: DataFrame) -> DataFrame:
    """Events ``(ts, action, resource, user[, metadata])`` in logged form, with the day they belong to."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    metadata = F.col("metadata") if "metadata" in events.columns else F.create_map().cast(AUDIT["metadata"].dataType)
    return events.select(
        stamp.alias("timestamp"), "action", "resource", "user", metadata.alias("metadata"), F.to_date("ts").alias("date")
    )


def audit_append(events: DataFrame, path: str) -> None:
    audit_rows(events).write.mode("append").partitionBy("date").json(path)
