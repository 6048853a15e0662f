"""Readers. Schemas are declared, never inferred; filters and projections stay with the scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import AUDIT
from ledgerlake.session import instant


class MissingColumns(ValueError):
    """A table lacks columns its readers need."""


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines. A value of the wrong type becomes null, which the contract check reports."""
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str, required: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Parquet table; only its schema is looked at to check the required columns."""
    df = spark.read.parquet(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"{path}: missing columns {missing}")
    return df


def read_labels(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _modified_between(df: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    changed = F.col("_metadata.file_modification_time")
    if start is not None:
        df = df.where(changed >= instant(start))
    if end is not None:
        df = df.where(changed <= instant(end))
    return df


def read_modified(spark: SparkSession, path: str, schema: T.StructType | None = None, start: datetime | None = None,
                  end: datetime | None = None, format: str = "json") -> DataFrame:
    """Rows of the files modified in [start, end], both inclusive.

    The filter on file metadata is decided while files are listed; other files are not opened.
    """
    reader = spark.read.format(format).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return _modified_between(reader.load(path), start, end)


def files_older_than(spark: SparkSession, path: str, cutoff: datetime, format: str = "json",
                     schema: T.StructType | None = None) -> DataFrame:
    """``(file, rows, modified)`` of the files last modified before the cutoff."""
    reader = spark.read.format(format).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    changed = F.col("_metadata.file_modification_time")
    return (
        reader.load(path)
        .where(changed < instant(cutoff))
        .groupBy(F.col("_metadata.file_path").alias("file"), changed.alias("modified"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def read_audit(spark: SparkSession, path: str, start_date: str | None = None) -> DataFrame:
    """Audit log, partitioned by day; with a start date only later days are listed."""
    schema = T.StructType([*AUDIT.fields, T.StructField("date", T.DateType())])
    df = spark.read.schema(schema).json(path)
    return df.where(F.col("date") >= F.lit(start_date).cast("date")) if start_date else df


def stream_events(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100, glob: str | None = None,
                  format: str = "json") -> DataFrame:
    """Files as a stream: each is read once, however often the query restarts.

    For a broker, ``spark.readStream.format('kafka')`` yields the same columns; nothing downstream
    depends on the source.
    """
    reader = spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
