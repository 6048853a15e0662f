"""Table operations: replay, backfill, archival, partition layout and maintenance."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.incremental import union_all
from ledgerlake.operators.ingest import dedup_events
from ledgerlake.sources.readers import read_modified
from ledgerlake.session import instant, stored
from ledgerlake.sources.publish import folder_of, publish_files, read_folders, recover, relative, row_file, table_files
from ledgerlake.sources.sinks import JSON_TIME, exists_json, identifier, write_table

# Days a layer stays in the active tables.
RETENTION_DAYS = {"bronze": 90, "silver": 180, "gold": 90}


def bronze_replay(spark: SparkSession, path: str, schema: T.StructType, start: datetime, end: datetime | None = None,
                  target: str | None = None, order: str = "kinesis_sequence", event_id: str = "event_id",
                  run_id: str | None = None) -> DataFrame:
    """Events of the Bronze files written in [start, end], each once.

    Without ``target`` this is a dry run; with it the events are written there as JSON Lines, the
    folder the stream reads. Events the target holds already are left out, so a replay that is repeated, or
    overlaps another, emits each event once. Every run owns a folder ``run=<id>``; one that failed halfway
    is replaced when it is run again under the same id. Events without an id can't be told apart: all are emitted, once per run id.
    """
    events = dedup_events(read_modified(spark, path, schema, start, end), order=order)
    if target is None:
        return events
    run = identifier(run_id or uuid.uuid4().hex)
    if exists_json(spark, target):
        there = spark.read.schema(T.StructType([schema[event_id], T.StructField("run", T.StringType())])).json(target)
        # A failed attempt of this run is about to be replaced; all other runs count.
        emitted = there.where(F.col("run") != run).select(event_id).distinct()
        events = events.join(emitted, event_id, "left_anti").select(*events.columns)
    events = stored(events, "replay")
    events.write.mode("overwrite").option("timestampFormat", JSON_TIME).json(f"{target.rstrip('/')}/run={run}")
    return events


def day_with_lookback(bronze: DataFrame, ts: str, day: date, lookback: timedelta | None) -> DataFrame:
    """Rows a recomputation of ``day`` needs: the day and the history its windows look back on."""
    end = instant(datetime.combine(day + timedelta(days=1), datetime.min.time()))
    rows = bronze.where(F.col(ts).cast("timestamp") < end)
    if lookback is not None:
        start = instant(datetime.combine(day, datetime.min.time()) - lookback)
        rows = rows.where(F.col(ts).cast("timestamp") >= start)
    return rows


def day_with_last_rows(bronze: DataFrame, ts: str, day: date, rows: int, entity: str, tie: str,
                       span: timedelta = timedelta(0), step: timedelta = timedelta(days=1)) -> DataFrame:
    """The day, the ``span`` before it, and of each entity seen in the day the last ``rows`` rows before it.

    Earlier rows are looked for in steps back in time, each twice as long as the one before, and only for entities that
    still lack rows, so the scans end where the last entity is served or history begins; the bounds of a step are
    literals and prune files. Ranks are pruned before the shuffle.
    """
    at = F.col(ts).cast("timestamp")
    first = datetime.combine(day, datetime.min.time())
    base = bronze.where((at >= instant(first - span)) & (at < instant(first + timedelta(days=1))))
    if not rows:
        return base
    spark = bronze.sparkSession
    today = bronze.where((at >= instant(first)) & (at < instant(first + timedelta(days=1))))
    wanting = stored(today.where(F.col(entity).isNotNull()).select(entity).distinct().withColumn("__need", F.lit(rows)), "wanting")
    oldest = bronze.agg(F.unix_micros(F.min(at))).first()[0]  # from the footers' statistics
    oldest = first if oldest is None else datetime(1970, 1, 1) + timedelta(microseconds=oldest)
    # ``span`` rows are in the base already and count for an entity as well.
    upper, parts = first, []
    newest = Window.partitionBy(entity).orderBy(F.desc(ts), F.desc(tie))
    while upper > oldest and not wanting.isEmpty():
        lower = upper - step
        found = bronze.where((at >= instant(lower)) & (at < instant(upper))).join(wanting, entity)
        ranked = found.withColumn("__r", F.row_number().over(newest)).where((F.col("__r") <= rows) & (F.col("__r") <= F.col("__need")))
        part = stored(ranked.drop("__r", "__need"), "look-back")
        parts.append(part)
        counts = part.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
        left = wanting.join(counts, entity, "left").select(entity, (F.col("__need") - F.coalesce("__n", F.lit(0))).cast("int").alias("__need"))
        wanting = stored(left.where("__need > 0"), "wanting")
        upper, step = lower, 2 * step
    early = [p.where(at < instant(first - span)) for p in parts]
    return union_all(base, *(p.select(*bronze.columns) for p in early))


def backfill_silver(bronze: DataFrame, build: Callable[[DataFrame], DataFrame], ts: str, day: date,
                    lookback: timedelta | None = None, rows: int | None = None, entity: str | None = None,
                    tie: str | None = None) -> DataFrame:
    """Silver rows of one day, recomputed from Bronze; equal to that day of a full build.

    ``lookback`` is the time the windows look back on. Windows over a number of rows name it in ``rows``, with the ``entity``
    they belong to and the column that breaks ties: then the last rows of each entity before the day are read, however long
    ago they came, and no others. With neither, all history before the day is read, which only features over a
    whole history need.
    """
    if rows is not None:
        needed = day_with_last_rows(bronze, ts, day, rows, entity, tie, lookback or timedelta(0))
    else:
        needed = day_with_lookback(bronze, ts, day, lookback)
    return build(needed).where(F.col(ts).cast("date") == F.lit(day))


def expired(df: DataFrame, ts: str, cutoff) -> DataFrame:
    return df.where(F.col(ts) < instant(cutoff))


def retained(df: DataFrame, ts: str, cutoff) -> DataFrame:
    return df.where((F.col(ts) >= instant(cutoff)) | F.col(ts).isNull())


def _fingerprint(df: DataFrame) -> tuple:
    """Row count and an order-free sum over all columns."""
    row = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return tuple(df.agg(F.count(F.lit(1)), F.sum(row)).first())


def archive_rows(df: DataFrame, ts: str, cutoff, dst: str | None = None, partition_by: list[str] | None = None,
                 run_id: str | None = None) -> DataFrame:
    """Copy rows older than the cutoff to ``dst`` and verify the copy. Returns ``(archived, verified)``.

    Every run has a folder of its own under ``dst`` (``run=<id>``), so a later run never touches
    what an earlier one has stored. A dry run (no ``dst``) only counts.
    """
    spark, old = df.sparkSession, expired(df, ts, cutoff)
    expected = _fingerprint(old)
    if dst is not None and expected[0]:
        path = f"{dst.rstrip('/')}/run={identifier(run_id or uuid.uuid4().hex)}"
        write_table(old, path, partition_by, mode="errorifexists")
        found = _fingerprint(spark.read.schema(old.schema).parquet(path).select(*old.columns))
        if found != expected:
            raise RuntimeError(f"archive {path} holds {found[0]} rows that differ from the {expected[0]} to archive")
    return spark.createDataFrame([(expected[0], dst is not None)], "archived bigint, verified boolean")


def archive_table(spark: SparkSession, path: str, ts: str, cutoff, dst: str, partition_by: list[str] | None = None,
                  run_id: str | None = None) -> DataFrame:
    """Move rows older than the cutoff out of the table at ``path``: archive, verify, then remove.

    Only partitions that hold such rows are rewritten, and only the files that were read: files added meanwhile,
    and all other partitions, stay as they are. A failure leaves the table with all of its rows.
    """
    recover(spark, path)
    table = spark.read.parquet(path)
    done = archive_rows(table, ts, cutoff, dst, partition_by, run_id)
    if done.first()["verified"]:
        folders = set(read_folders(expired(table, ts, cutoff), path))
        files = [relative(spark, path, f) for f in table.inputFiles()]
        touched = [f for f in files if f.rpartition("/")[0] in folders]
        rest = spark.read.schema(table.schema).option("basePath", path).parquet(*(f"{path.rstrip('/')}/{f}" for f in touched))
        publish_files(retained(rest, ts, cutoff), path, partition_by or [], touched)
    return done


def month_cutoff(today: date, months: int = 3) -> date:
    """First of the month 30 * months days back."""
    return (today - timedelta(days=30 * months)).replace(day=1)


def relative_boundaries(today: date, scheme: str) -> list[date]:
    """Sliding partition boundaries: DAILY at -30, -7 and 0 days, WEEKLY at -12, -4 and 0 weeks."""
    days = {"DAILY": (30, 7, 0), "WEEKLY": (84, 28, 0)}
    if scheme not in days:
        raise ValueError(f"unsupported partition scheme: {scheme}")
    return [today - timedelta(days=d) for d in days[scheme]]


def partition_assign(df: DataFrame, ts: str, boundaries: list[date]) -> DataFrame:
    """Add the month bucket and the partition number, boundaries belonging to the right side."""
    number = F.lit(1)
    for b in boundaries:
        number = number + (F.col(ts) >= F.lit(b).cast("timestamp")).cast("int")
    return df.withColumns({"month": F.to_date(F.date_trunc("month", ts)), "partition_number": number})


def table_maintenance(spark: SparkSession, table: str) -> DataFrame:
    """Column statistics for the cost-based optimizer; returns what was recorded for the table."""
    name = ".".join(identifier(p) for p in table.split("."))
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where(F.col("col_name") == "Statistics").select(
        F.lit(table).alias("table"), F.col("data_type").alias("statistics")
    )


def compact(spark: SparkSession, path: str, dst: str, sort_by: list[str], partition_by: list[str] | None = None) -> None:
    """Rewrite into full-sized, sorted files, so that row-group ranges prune filters on ``sort_by``."""
    write_table(spark.read.parquet(path), dst, partition_by, sort_by=sort_by)


FILE_BYTES = 128 << 20
SMALL_FILES = 8  # in a partition, before they are worth joining


def maintain(spark: SparkSession, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
             target_bytes: int = FILE_BYTES, least_files: int = SMALL_FILES) -> DataFrame:
    """Join the small files of a table in place; returns ``(partitions, files_before, files_after, bytes)`` of what was rewritten.

    Small files, of less than half the target, are found from the listing alone. Partitions with ``least_files`` or
    more of them get these joined into files of about the target size; other files and partitions keep
    theirs. The table holds all of its rows at every moment a failure could come.
    """
    recover(spark, path)
    partition_by = partition_by or []
    small = table_files(spark, path).where((F.col("bytes") < target_bytes // 2) & F.col("file").rlike(r"(^|/)[^/_.][^/]*$"))
    bins = F.greatest(F.lit(1), F.ceil(F.sum("bytes") / target_bytes)).cast("int")
    per_folder = small.groupBy(folder_of(F.col("file")).alias("__folder")).agg(
        F.collect_list("file").alias("__files"), F.sum("bytes").alias("__bytes"), bins.alias("__bins"))
    many = stored(per_folder.where(F.size("__files") >= least_files), "small-files")
    found = many.collect()  # one row for each partition to rewrite
    before, after = sorted(f for r in found for f in r["__files"]), 0
    if found:
        rows = spark.read.option("basePath", path).parquet(*(f"{path.rstrip('/')}/{f}" for f in before))
        placed = rows.withColumn("__folder", folder_of(row_file(spark, path))).join(many.select("__folder", "__bins"), "__folder")
        way = F.pmod(F.xxhash64(*rows.columns), F.col("__bins"))
        dealt = placed.withColumn("__bin", way).repartition(sum(r["__bins"] for r in found), "__folder", "__bin").select(*rows.columns)
        after = publish_files(dealt, path, partition_by, before, sort_by, spread=False)
    total = sum(r["__bytes"] for r in found)
    return spark.createDataFrame([(len(found), len(before), after, total)], "partitions int, files_before int, files_after int, bytes bigint")
