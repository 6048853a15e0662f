"""Watermark-based incremental loads and upserts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import instant, stored
from ledgerlake.sources.publish import Area, table_files

EPOCH = datetime(1970, 1, 1)


def watermark_frame(control: DataFrame, table: str) -> DataFrame:
    """The last processed instant of one table as a one-row frame, 1970-01-01 when unknown."""
    return control.where(F.col("table_name") == table).agg(
        F.coalesce(F.max("last_processed_timestamp"), instant(EPOCH)).alias("last_processed_timestamp")
    )


def get_watermark(control: DataFrame, table: str) -> datetime:
    """The same as a driver value (one row, UTC), so that the filter below is a literal."""
    micros = watermark_frame(control, table).select(F.unix_micros("last_processed_timestamp")).first()[0]
    return EPOCH + timedelta(microseconds=micros)


def new_rows(df: DataFrame, watermark: datetime, col: str = "event_time") -> DataFrame:
    """Rows strictly after the watermark. A literal comparison reaches the Parquet scan."""
    return df.where(F.col(col) > instant(watermark))


def advance(control: DataFrame, table: str, ts: Column | datetime, rows: int, now) -> DataFrame:
    """Control table with ``table`` moved to ``ts`` and its row counter increased."""
    spark = control.sparkSession
    update = spark.range(1).select(
        F.lit(table).alias("table_name"),
        (ts.cast("timestamp") if isinstance(ts, Column) else instant(ts)).alias("__ts"),
        F.lit(rows).cast("bigint").alias("__n"),
    )
    return advance_with(control, update, now)


def advance_with(control: DataFrame, update: DataFrame, now) -> DataFrame:
    """Upsert ``(table_name, __ts, __n)`` rows into the control table."""
    now = instant(now)
    touched = F.col("__n").isNotNull()
    return control.join(update, "table_name", "full_outer").select(
        "table_name",
        F.coalesce("__ts", "last_processed_timestamp").alias("last_processed_timestamp"),
        (F.coalesce("rows_processed", F.lit(0)) + F.coalesce("__n", F.lit(0))).cast("bigint").alias("rows_processed"),
        F.when(touched, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def batch_progress(new: DataFrame, table: str, col: str = "event_time") -> DataFrame:
    """One ``(table_name, __ts, __n)`` row for the batch; no row when the batch is empty."""
    return (
        new.agg(F.max(col).alias("__ts"), F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 0)
        .select(F.lit(table).alias("table_name"), "__ts", "__n")
    )


def top1_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. The rank filter also runs before the shuffle, so copies of one key
    are reduced to one row per task."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__r") == 1).drop("__r")


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first


def upsert_latest(existing: DataFrame, new: DataFrame, keys: list[str], version: str = "updated_at") -> DataFrame:
    """Existing and new rows, keeping the newest version per key; on a tie the new row wins."""
    both = union_all(existing.withColumn("__new", F.lit(0)), new.withColumn("__new", F.lit(1)))
    return top1_per_key(both, keys, [F.desc(version), F.desc("__new")]).drop("__new")


def touched_rows(fact: DataFrame, watermark: datetime, bucket: Callable[[Column], Column], col: str = "event_time",
                 arrival: str | None = None) -> DataFrame:
    """All rows of the buckets that received a row after the watermark.

    ``arrival`` names the column that tells when a row came in. With it the watermark is one of arrival,
    and a row that comes late is aggregated into whatever bucket its event time falls in: the
    buckets of all new rows are looked up. Without it, rows must come in order of event time.
    """
    wm = instant(watermark)
    if arrival is not None:
        return reopened_rows(fact, fact.where(F.col(arrival) > wm), bucket, col)
    return _touched_in_order(fact, wm, bucket, col)


def reopened_rows(fact: DataFrame, new: DataFrame, bucket: Callable[[Column], Column], col: str = "event_time") -> DataFrame:
    """All rows of the buckets that the rows of ``new`` fall into."""
    buckets = stored(new.select(bucket(F.col(col)).alias("__bucket")).distinct(), "touched")
    first = buckets.agg(F.unix_micros(F.min("__bucket").cast("timestamp"))).first()[0]
    if first is None:
        return fact.where(F.lit(False))
    # The earliest bucket as a literal prunes the scan; the join picks the buckets after it.
    recent = fact.where(F.col(col) >= instant(EPOCH + timedelta(microseconds=first)))
    return recent.join(buckets, bucket(F.col(col)) == F.col("__bucket"), "left_semi")


def _touched_in_order(fact: DataFrame, wm: Column, bucket: Callable[[Column], Column], col: str) -> DataFrame:
    """Later buckets hold new rows only, so no join is needed: it is enough to know whether the bucket
    the watermark falls into received any. The lower bound is a literal and prunes partitions and
    row groups.
    """
    at, first = F.col(col), bucket(wm)
    reopened = fact.where((at > wm) & (bucket(at) == first)).agg((F.count(F.lit(1)) > 0).alias("any"))
    return fact.where((at >= first) & ((bucket(at) > first) | reopened.scalar()))


def refresh_gold(
    fact: DataFrame,
    watermark: datetime,
    agg: Callable[[DataFrame], DataFrame],
    bucket: Callable[[Column], Column],
    col: str = "event_time",
    arrival: str | None = None,
) -> DataFrame:
    """Complete aggregates of every bucket touched since the watermark; replace these buckets."""
    return agg(touched_rows(fact, watermark, bucket, col, arrival))


def merge_buckets(existing: DataFrame, refreshed: DataFrame, keys: list[str]) -> DataFrame:
    """Existing Gold with the refreshed buckets replaced."""
    return union_all(existing.join(refreshed.select(*keys).distinct(), keys, "left_anti"), refreshed)


def hour_bucket(c: Column) -> Column:
    return F.date_trunc("hour", c)


def day_bucket(c: Column) -> Column:
    return F.date_trunc("day", c)


def week_bucket(c: Column) -> Column:
    return F.date_trunc("week", c)


# --- progress by files ------------------------------------------------------------------

LEDGER = "file string, run string"


def new_files(spark: SparkSession, path: str, ledger: str) -> list[str]:
    """Files of the table at ``path``, relative to it, that no committed run has processed: those of the runs since the last
    one. From the listing alone, so a row that lands late under an old instant is found as surely as any other."""
    files = table_files(spark, path).where(F.col("file").rlike(r"(^|/)[^/_.][^/]*$"))
    if Area(spark, ledger).exists(ledger):
        files = files.join(spark.read.schema(LEDGER).parquet(ledger), "file", "left_anti")
    return sorted(r.file for r in files.select("file").collect())


def rows_of_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The rows of these files, with the table's partition columns; no other file is opened."""
    root = path.rstrip("/")
    return spark.read.schema(spark.read.parquet(root).schema).option("basePath", root).parquet(*(f"{root}/{f}" for f in files))


def commit_files(spark: SparkSession, ledger: str, files: list[str], run: str) -> None:
    """Record the files as processed, as the last step of a run; recording a run again replaces what it recorded."""
    rows = spark.createDataFrame([(f,) for f in files], "file string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/run={run}")
