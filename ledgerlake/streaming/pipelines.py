"""Streaming ingest, deduplication, hourly Gold and scoring."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerlake.functions.stats import clean_double
from ledgerlake.operators.gold import FLAG, HIGH
from ledgerlake.operators.ingest import parse_events, split_valid
from ledgerlake.operators.models import FRAUD, cell_scores, score_fraud
from ledgerlake.sources.sinks import JSON_TIME, staged

TRIGGER = "60 seconds"
STREAM_ID, BATCH_ID = "stream_id", "batch_id"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _trigger(writer: DataStreamWriter, once: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


def stream_id(df: DataFrame) -> str:
    """The id of the running stream: kept in its checkpoint, so it outlives restarts and differs for
    every new checkpoint."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def write_batch(df: DataFrame, batch_id: int, path: str, format: str, stream: str | None = None) -> None:
    """A micro-batch of a stream owns one partition; writing it again after a failure replaces it. A stream with a
    new checkpoint counts its batches from 0 again, under an id of its own."""
    (
        df.withColumns({STREAM_ID: F.lit(stream or stream_id(df)), BATCH_ID: F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampFormat", JSON_TIME)
        .partitionBy(STREAM_ID, BATCH_ID)
        .format(format)
        .save(path)
    )


def stream_ingest(raw: DataFrame, bronze: str, dlq: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Parse raw records into Bronze and the dead-letter table.

    Each sink is a separate job over the parsed micro-batch; both are replaced per stream and batch, so
    the pair is effectively written once.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch)
        with staged(parse_events(batch)) as parsed:  # parsed once for both sinks
            good, bad = split_valid(parsed)
            write_batch(good, batch_id, bronze, "json", stream)
            write_batch(bad, batch_id, dlq, "json", stream)

    writer = raw.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    return _trigger(writer, once).start()


def stream_dedup(events: DataFrame, key: str = "event_id", ts: str = "event_time", delay: str = "24 hours",
                 spread: str | None = None, ways: int = 16) -> DataFrame:
    """First delivery of each event; state is kept for ``delay``, the retention of the source.

    Where one event may be delivered very often, ``spread`` names a column that differs between
    deliveries: copies are then dropped in ``ways`` independent groups first, so that at most
    ``ways`` of them meet in one task.
    """
    out = events.withWatermark(ts, delay)
    if spread is not None:
        out = out.withColumn("__way", F.pmod(F.xxhash64(spread), F.lit(ways)))
        out = out.dropDuplicatesWithinWatermark([key, "__way"]).drop("__way")
    return out.dropDuplicatesWithinWatermark([key])


def stream_gold_hourly(scores: DataFrame, delay: str = "1 hour", flag: float = FLAG, high: float = HIGH) -> DataFrame:
    """Hourly fraud metrics, emitted once the watermark passes the hour; later rows are dropped."""
    s = clean_double(F.col("fraud_score"))
    return (
        scores.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour").alias("w"))
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.count_if(s >= flag).alias("flagged_transactions"),
            F.count_if(s >= high).alias("high_risk_count"),
            F.avg(s).alias("avg_fraud_score"),
        )
        .select(
            F.col("w.start").alias("hour_bucket"),
            "total_transactions",
            "flagged_transactions",
            "high_risk_count",
            "avg_fraud_score",
            F.try_divide("flagged_transactions", "total_transactions").alias("fraud_rate"),
        )
    )


def stream_score(features: DataFrame, model, version: str, sink: str, checkpoint: str,
                 clock: Callable[[], datetime] = utc_now, once: bool = False) -> StreamingQuery:
    """Score micro-batches; rows that cannot be scored are answered with ``allow``."""
    cells = cell_scores(model, FRAUD)  # once for the stream

    def score(batch: DataFrame, batch_id: int) -> None:
        write_batch(score_fraud(batch, model, version, clock(), cells), batch_id, sink, "parquet")

    writer = features.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return _trigger(writer, once).start()


def append_stream(df: DataFrame, path: str, checkpoint: str, once: bool = False, format: str = "parquet") -> StreamingQuery:
    writer = df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, once).start(path)
