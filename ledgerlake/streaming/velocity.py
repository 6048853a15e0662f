"""Fraud features on a stream, late events included, by the windows of the batch build.

Each micro-batch is joined by a *carry*: of every customer the rows of the allowed delay and a minute before it, and the
last few rows before those. That is all the windows of a row can look back on as long as it is no later than the
delay, so the features of ``silver_fraud`` over carry and batch are those over the whole history. The carry is a table in
shared storage, one version per micro-batch; nothing is kept in Python or in one task, and a hot customer's rows are
sliced as in the batch build.

* A late event gets the features it would have had in time, and rows written earlier that it changes (a minute after it,
  or among the next few of its customer) are written again. ``current_features`` takes the newest version of every event.
* The watermark is the newest event time less the delay. Events behind it go to a side table, for ``backfill_silver``.
* A customer's last rows are dropped ``ttl`` after them; an event after that has no predecessor.
* A micro-batch that is repeated starts from the carry before it and replaces what it has written. An event that is
  delivered again while it is carried counts once.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.features import DEVICE_ROWS, HOT_ROWS, MICROS, VELOCITY_SECONDS, fraud_features
from ledgerlake.operators.incremental import top1_per_key
from ledgerlake.session import remove
from ledgerlake.sources.publish import Area
from ledgerlake.sources.sinks import staged
from ledgerlake.streaming.pipelines import BATCH_ID, _trigger, stream_id, write_batch

FEATURES = ("tx_velocity_1m", "geo_distance_km", "device_entropy")
INPUT = ("event_id", "transaction_id", "customer_id", "event_time", "device_id", "latitude", "longitude")
DELAY, TTL = timedelta(hours=1), timedelta(days=90)


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _carried(rows: DataFrame, newest: int, delay: timedelta, ttl: timedelta) -> DataFrame:
    """What later batches can look back on, given the newest event time in microseconds."""
    at, edge = F.unix_micros("event_time"), newest - _micros(delay) - VELOCITY_SECONDS * MICROS
    last = Window.partitionBy("customer_id").orderBy(F.desc("event_time"), F.desc("event_id"))
    before = rows.where((at <= edge) & (at > newest - _micros(ttl)) & F.col("customer_id").isNotNull())
    tail = before.withColumn("__r", F.row_number().over(last)).where(F.col("__r") < DEVICE_ROWS).drop("__r")
    return rows.where(at > edge).unionByName(tail)


def _process(batch: DataFrame, batch_id: int, sink: str, state: str, delay: timedelta, ttl: timedelta, hot_rows: int) -> None:
    spark, stream = batch.sparkSession, stream_id(batch)
    area = Area(spark, f"{state.rstrip('/')}/carry")
    before, after = (f"{area.table}-{stream}-{i}" for i in (batch_id - 1, batch_id))
    old = spark.read.parquet(before) if area.exists(before) else None
    new = batch.select(*INPUT)
    if old is None:
        mark = None
    else:
        mark = old.agg(F.unix_micros(F.max("event_time"))).first()[0]
        mark = None if mark is None else mark - _micros(delay)
        seen = (F.col("n.event_id").eqNullSafe(F.col("o.event_id"))) & (F.col("n.event_time") == F.col("o.event_time")) & (
            F.col("n.customer_id").eqNullSafe(F.col("o.customer_id")))
        new = new.alias("n").join(old.alias("o"), seen, "left_anti")
    # An event without a time belongs to no window; it goes to the side table as well.
    in_time = F.col("event_time").isNotNull() & (F.lit(True) if mark is None else F.unix_micros("event_time") >= mark)
    none = [F.lit(None).cast(t).alias(f"old_{c}") for c, t in zip(FEATURES, ("bigint", "double", "double"))]
    fresh = new.where(in_time).select("*", *none, F.lit(True).alias("fresh"))
    both = fresh if old is None else fresh.unionByName(old.withColumn("fresh", F.lit(False)))
    write_batch(new.where(~in_time), batch_id, f"{sink.rstrip('/')}_late", "parquet", stream)
    with staged(fraud_features(both, hot_rows=hot_rows)) as rows:
        # The oldest carried rows have lost their own history: what was written for them stands.
        whole = F.lit(True) if mark is None else F.unix_micros("event_time") >= mark
        value = {c: F.when(whole, F.col(c)).otherwise(F.col(f"old_{c}")) for c in FEATURES}
        rows = rows.withColumns(value)
        same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in FEATURES]
        changed = F.col("fresh") | ~(same[0] & same[1] & same[2])
        out = rows.where(changed).select("customer_id", "transaction_id", "event_id", "event_time", *FEATURES)
        write_batch(out, batch_id, sink, "parquet", stream)
        newest = rows.agg(F.unix_micros(F.max("event_time"))).first()[0]
        kept = rows.select(*INPUT, *[F.col(c).alias(f"old_{c}") for c in FEATURES])
        if newest is not None:
            kept = _carried(kept, newest, delay, ttl)
        kept.write.mode("overwrite").parquet(after)
    remove(spark, f"{area.table}-{stream}-{batch_id - 2}")  # the one before is needed if this batch is repeated


def stream_velocity(events: DataFrame, sink: str, checkpoint: str, delay: timedelta = DELAY, ttl: timedelta = TTL,
                    once: bool = False, hot_rows: int = HOT_ROWS) -> StreamingQuery:
    """Write the three fraud features of a stream of events to ``sink``, those behind the watermark to ``sink_late``.

    The carry lies beside the checkpoint, as it belongs to it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        _process(batch, batch_id, sink, f"{checkpoint.rstrip('/')}_carry", delay, ttl, hot_rows)

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(writer, once).start()


def current_features(spark: SparkSession, sink: str) -> DataFrame:
    """The newest version of every event's features."""
    rows = spark.read.parquet(sink)
    latest = top1_per_key(rows, ["customer_id", "event_id", "transaction_id", "event_time"], [F.desc(BATCH_ID)])
    return latest.select("customer_id", "transaction_id", "event_id", "event_time", *FEATURES)
