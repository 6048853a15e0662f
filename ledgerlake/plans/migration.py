"""Encrypting a whole layer, resumable file by file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.privacy import ENCRYPTED, decrypt_fields, encrypt_fields, encryption_coverage, field_value, pii_fields
from ledgerlake.sources.publish import Area, inside, row_file, table_files
from ledgerlake.sources.readers import stream_events
from ledgerlake.streaming.pipelines import append_stream


def encrypt_migrate(spark: SparkSession, src: str, dst: str, layer: str, dataset: str, key: bytes, checkpoint: str,
                    max_files: int = 1000) -> DataFrame:
    """Encrypt every file of ``src`` into ``dst`` and report the coverage reached.

    The checkpoint remembers the files already done: an interrupted migration resumes, and files
    that arrive later are picked up by the next call.
    """
    schema = spark.read.parquet(src).schema
    rows = stream_events(spark, src, schema, max_files, format="parquet")
    sealed = encrypt_fields(rows, pii_fields(layer, dataset), key)
    append_stream(sealed, dst, checkpoint, once=True).awaitTermination()
    return encryption_coverage(spark.read.schema(schema).parquet(dst), list(pii_fields(layer, dataset)))


FILE_LOG = "path string, batchId bigint"


def migration_status(spark: SparkSession, src: str, checkpoint: str) -> DataFrame:
    """``(file, bytes, state)`` of every file of ``src``: done, failed (its batch was begun and never committed) or pending.

    From the listing of the source, the log of files that the stream has taken and the batches it has committed; neither
    source nor target is read. A migration that was interrupted reports what is left for the next call.
    """
    area = Area(spark, src)
    files = table_files(spark, src).where(F.col("file").rlike(r"(^|/)[^/_.][^/]*$"))
    log, commits = f"{checkpoint.rstrip('/')}/sources/0", f"{checkpoint.rstrip('/')}/commits"
    committed = max((int(c) for c in area.children(commits) if c.isdigit()), default=-1)
    if not area.exists(log):
        return files.select("file", "bytes", F.lit("pending").alias("state"))
    entries = spark.read.text(log).where(F.col("value").startswith("{")).select(F.from_json("value", FILE_LOG).alias("e")).select("e.*")
    taken = entries.groupBy(inside(spark, src, F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("file")).agg(
        F.min("batchId").alias("batch"))
    state = F.when(F.col("batch").isNull(), "pending").when(F.col("batch") <= committed, "done").otherwise("failed")
    return files.join(taken, "file", "left").select("file", "bytes", state.alias("state"))


def encrypted_files(spark: SparkSession, path: str, layer: str, dataset: str) -> DataFrame:
    """``(file, rows, encrypted, plain)`` of every file of a layer: values of its personal fields that are encrypted and
    that are not."""
    rows = spark.read.parquet(path)
    values = [v for v in (field_value(rows, f) for f in pii_fields(layer, dataset)) if v is not None]
    sealed = reduce(Column.__add__, [F.coalesce(v.startswith(ENCRYPTED), F.lit(False)).cast("bigint") for v in values], F.lit(0))
    there = reduce(Column.__add__, [v.isNotNull().cast("bigint") for v in values], F.lit(0))
    counted = rows.select(row_file(spark, path).alias("file"), sealed.alias("sealed"), there.alias("there"))
    return counted.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum("sealed").alias("encrypted"),
                                       (F.sum("there") - F.sum("sealed")).alias("plain"))


def rollback(spark: SparkSession, encrypted: str, layer: str, dataset: str, key: bytes) -> DataFrame:
    return decrypt_fields(spark.read.parquet(encrypted), pii_fields(layer, dataset), key)
