"""Streaming jobs. Each runs over files derived from the given tables until none is left."""

from pyspark.sql import functions as F

from ledgerlake.operators import ingest, models
from ledgerlake.plans import silver
from ledgerlake.plans.catalog import query
from ledgerlake.plans.catalog_features import SILVER_FRAUD, rounded
from ledgerlake.plans.catalog_gold import DIGITS, FRAUD_HOURLY
from ledgerlake.plans.catalog_lake import bronze_files, raw_stream
from ledgerlake.plans.catalog_models import fraud_sets
from ledgerlake.session import shared_dir, state_session
from ledgerlake.sources import readers
from ledgerlake.streaming import pipelines, velocity


def run(df, name: str):
    """Drive a stream into a table until its input is used up; return the table."""
    spark = df.sparkSession
    path, checkpoint = shared_dir(spark, name), shared_dir(spark, "checkpoint")
    pipelines.append_stream(df, path, checkpoint, once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


ARRIVALS = 4


def arriving(fx, view: str, build, name: str):
    """The view delivered in time order, a fraction of its period at a time.

    After each delivery the stream runs until its input is used up and stops; the next run resumes
    from the checkpoint. Returns the sink table.
    """
    spark, df = fx.spark, fx(view)
    src, dst, checkpoint = (shared_dir(spark, d) for d in ("arriving", name, "checkpoint"))
    first, last, n = df.agg(F.min("event_time"), F.max("event_time"), F.count(F.lit(1))).first()
    step = (last - first) / ARRIVALS
    own = state_session(spark, n)
    for i in range(ARRIVALS):
        rows = df if i == 0 else df.where(F.col("event_time") >= F.lit(first + i * step))
        if i < ARRIVALS - 1:
            rows = rows.where(F.col("event_time") < F.lit(first + (i + 1) * step))
        rows.write.mode("append").parquet(src)
        out = build(readers.stream_events(own, src, df.schema, max_files=1_000, format="parquet"))
        pipelines.append_stream(out, dst, checkpoint, once=True).awaitTermination()
    return spark.read.schema(out.schema).parquet(dst)


@query("stream_bronze", "SELECT seq, customer_id, event_time, event_type FROM {crm_events}")
def _(fx):
    path = bronze_files(fx, "crm_events", "seq", "customer_id", "event_time", "event_type")
    events = readers.stream_events(fx.spark, path, fx("crm_events").schema, max_files=4)
    return run(events, "bronze").select("seq", "customer_id", "event_time", "event_type")


@query("file_arrival", "SELECT seq, event_id, event_time FROM {tx_deliveries}")
def _(fx):
    """Only JSON files count as arrivals, each once."""
    path = bronze_files(fx, "tx_deliveries", "seq", "event_id", "event_time")
    events = readers.stream_events(fx.spark, path, fx("tx_deliveries").schema, max_files=1, glob="*.json")
    return run(events, "arrived").select("seq", "event_id", "event_time")


@query(
    "stream_ingest",
    """SELECT 'bronze' AS target, seq, json_extract_string(raw, '$.event_id') AS event_id,
              coalesce(json_extract_string(raw, '$.payload.customer_id'), 'none') AS customer_id
       FROM {tx_raw} WHERE raw NOT IN ('{{bad', '[1]')
       UNION ALL SELECT 'dlq', seq, NULL, NULL FROM {tx_raw} WHERE raw IN ('{{bad', '[1]')""",
)
def _(fx):
    spark = fx.spark
    src, bronze, dlq, checkpoint = (shared_dir(spark, d) for d in ("raw", "bronze", "dlq", "checkpoint"))
    raw = raw_stream(fx)
    raw.write.parquet(src)
    stream = readers.stream_events(spark, src, raw.schema, max_files=2, format="parquet")
    pipelines.stream_ingest(stream, bronze, dlq, checkpoint, once=True).awaitTermination()

    good = ingest.payload_fields(spark.read.schema("seq bigint, event_id string, payload string").json(bronze))
    good = good.select(F.lit("bronze").alias("target"), "seq", "event_id", F.coalesce("customer_id", F.lit("none")).alias("customer_id"))
    null = F.lit(None).cast("string")
    bad = spark.read.schema("seq bigint").json(dlq).select(F.lit("dlq").alias("target"), "seq", null.alias("event_id"), null.alias("customer_id"))
    return good.unionByName(bad)


@query("stream_dedup", "SELECT DISTINCT event_id, event_time FROM {tx_deliveries}")
def _(fx):
    def build(s):
        return pipelines.stream_dedup(s, spread="seq").select("event_id", "event_time")

    return arriving(fx, "tx_deliveries", build, "unique")


@query(
    "stream_gold_hourly",
    f"""SELECT * FROM ({FRAUD_HOURLY}) h
        WHERE hour_bucket + INTERVAL 2 HOURS <= (SELECT max(event_time) FROM {{tx_scores}})""",
)
def _(fx):
    """The hours the watermark (one hour behind the newest event) has passed; the rest is still open."""
    return rounded(arriving(fx, "tx_scores", pipelines.stream_gold_hourly, "hourly"), DIGITS, "avg_fraud_score", "fraud_rate")


@query("stream_velocity", SILVER_FRAUD)
def _(fx):
    """In four deliveries; every other event of the half hour before a cut comes late, in the delivery after it."""
    spark, df = fx.spark, fx("tx_events")
    src, sink, checkpoint = (shared_dir(spark, d) for d in ("arriving", "features", "checkpoint"))
    at = F.unix_micros("event_time")
    first, last, n = df.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    step = (last - first) // ARRIVALS + 1
    place = at - F.lit(first)
    late = (F.col("event_id") % 2 == 0) & (step - place % step < 1_800_000_000)
    turn = F.least(F.floor(place / step) + late.cast("int"), F.lit(ARRIVALS - 1))
    own = state_session(spark, n)
    for i in range(ARRIVALS):
        df.where(turn == i).write.mode("append").parquet(src)
        events = readers.stream_events(own, src, df.schema, max_files=1_000, format="parquet")
        velocity.stream_velocity(events, sink, checkpoint, once=True).awaitTermination()
    rows = velocity.current_features(spark, sink).drop("event_id")
    return rounded(rows, 6, "geo_distance_km", "device_entropy")


@query("stream_score", "SELECT transaction_id FROM {tx_events}")
def _(fx):
    """Every streamed transaction is answered once."""
    src, sink, checkpoint = (shared_dir(fx.spark, d) for d in ("features", "decisions", "checkpoint"))
    rows = silver.silver_fraud(fx("tx_events"))
    rows.write.parquet(src)
    train, _ = fraud_sets(fx, fx.spark.read.schema(rows.schema).parquet(src))
    model = models.train(train, models.FRAUD)
    stream = readers.stream_events(fx.spark, src, rows.schema, max_files=2, format="parquet")
    pipelines.stream_score(stream, model, "fraud_v1", sink, checkpoint, once=True).awaitTermination()
    return fx.spark.read.parquet(sink).where("decision IN ('allow', 'challenge', 'block')").select("transaction_id")

