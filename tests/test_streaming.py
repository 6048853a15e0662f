import random
from datetime import datetime, timedelta

import pytest

from ledgerlake.operators import gold
from ledgerlake.plans import silver
from ledgerlake.plans.fixtures import Fixtures
from ledgerlake.session import shared_dir
from ledgerlake.sources import readers, sinks
from ledgerlake.streaming import pipelines, velocity
from tests.test_tables import content

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


class Feed:
    """A folder of files and a stream over it, run until its input is used up."""

    def __init__(self, spark, schema, build):
        self.spark, self.schema, self.build = spark, schema, build
        self.src, self.dst, self.checkpoint = (shared_dir(spark, d) for d in ("src", "dst", "checkpoint"))

    def deliver(self, rows):
        df = self.spark.createDataFrame(rows, self.schema) if isinstance(rows, list) else rows
        df.write.mode("append").parquet(self.src)
        return self.run()

    def run(self):
        stream = readers.stream_events(self.spark, self.src, self.spark.read.parquet(self.src).schema, format="parquet")
        out = self.build(stream)
        pipelines.append_stream(out, self.dst, self.checkpoint, once=True).awaitTermination()
        return self.spark.read.schema(out.schema).parquet(self.dst)


@pytest.mark.parametrize("spread", [None, "seq"])
def test_replayed_deliveries_are_dropped_across_restarts(spark, spread):
    feed = Feed(spark, "event_id string, event_time timestamp, seq bigint", lambda s: pipelines.stream_dedup(s, spread=spread))
    rows = [("e1", T0, 1), ("e2", T0, 2), ("e1", T0, 3)]
    feed.deliver(rows)
    feed.deliver([("e1", T0, 4), ("e3", T0 + timedelta(minutes=5), 5)])
    assert sorted(r["event_id"] for r in feed.run().collect()) == ["e1", "e2", "e3"]


def test_hourly_gold_closes_hours_and_drops_what_is_too_late(spark):
    feed = Feed(spark, "transaction_id string, event_time timestamp, fraud_score double", lambda s: pipelines.stream_gold_hourly(s, "30 minutes"))
    at = lambda h, m: T0 + timedelta(hours=h, minutes=m)
    feed.deliver([("a", at(0, 10), 0.9), ("b", at(0, 50), 0.1), ("c", at(1, 10), 0.8)])
    feed.deliver([("late but in time", at(0, 45), 0.75), ("d", at(1, 45), 0.2)])
    feed.deliver([("too late", at(0, 20), 0.9), ("e", at(3, 0), 0.2)])
    got = {r["hour_bucket"].hour: (r["total_transactions"], r["flagged_transactions"]) for r in feed.run().collect()}
    assert got == {0: (3, 2), 1: (2, 1)}


def test_ingest_writes_each_record_once_even_when_a_batch_is_repeated(spark):
    fx = Fixtures(spark, SF)
    from ledgerlake.plans.catalog_lake import raw_stream

    raw = raw_stream(fx)
    src, bronze, dlq, checkpoint = (shared_dir(spark, d) for d in ("raw", "bronze", "dlq", "cp"))
    raw.write.parquet(src)
    stream = readers.stream_events(spark, src, raw.schema, format="parquet")
    pipelines.stream_ingest(stream, bronze, dlq, checkpoint, once=True).awaitTermination()
    def stored(path):
        return spark.read.schema("seq bigint, batch_id bigint").json(path).count()

    good, bad = stored(bronze), stored(dlq)
    assert good + bad == raw.count() and bad > 0
    # a restart finds nothing new
    pipelines.stream_ingest(stream, bronze, dlq, checkpoint, once=True).awaitTermination()
    assert (stored(bronze), stored(dlq)) == (good, bad)
    # a batch that is written again replaces its first attempt
    stream = spark.read.json(dlq).first()["stream_id"]
    pipelines.write_batch(spark.range(3).toDF("seq"), 0, dlq, "json", stream)
    assert stored(dlq) == 3


EVENT = "event_id bigint, transaction_id string, customer_id string, event_time timestamp, device_id string, latitude double, longitude double"


class VelocityFeed:
    """Deliveries of events to ``stream_velocity``, a run after each."""

    def __init__(self, spark, **how):
        self.spark, self.how = spark, how
        self.src, self.sink, self.checkpoint = (shared_dir(spark, d) for d in ("src", "features", "checkpoint"))

    def deliver(self, rows):
        self.spark.createDataFrame(rows, EVENT).coalesce(2).write.mode("append").parquet(self.src)
        return self.run()

    def run(self):
        stream = readers.stream_events(self.spark, self.src, self.spark.read.parquet(self.src).schema, format="parquet")
        velocity.stream_velocity(stream, self.sink, self.checkpoint, once=True, **self.how).awaitTermination()
        return velocity.current_features(self.spark, self.sink)

    def late(self):
        return sorted(r.event_id for r in self.spark.read.schema(EVENT).parquet(f"{self.sink}_late").collect())


def features_of(df):
    return {r.event_id: (r.tx_velocity_1m, round(r.geo_distance_km or 0, 6), round(r.device_entropy or 0, 6)) for r in df.collect()}


def test_velocity_crosses_file_and_restart_boundaries(spark):
    feed = VelocityFeed(spark)
    at = lambda s: T0 + timedelta(seconds=s)
    feed.deliver([(1, "t1", "c", at(0), "a", 0.0, 0.0), (2, "t2", "c", at(30), None, None, None)])
    got = feed.deliver([(3, "t3", "c", at(59), "b", 0.0, 1.0), (4, "t4", "c", at(60), "b", 0.0, 2.0), (5, "t5", "d", at(60), "b", 0.0, 2.0)])
    rows = {r["transaction_id"]: r for r in got.collect()}
    assert [rows[f"t{i}"]["tx_velocity_1m"] for i in range(1, 6)] == [1, 2, 3, 3, 1]
    assert rows["t3"]["geo_distance_km"] == 0.0  # the previous event had no place
    assert rows["t4"]["geo_distance_km"] == pytest.approx(111.19, abs=0.01)
    assert rows["t4"]["device_entropy"] == pytest.approx(1.5)


@pytest.mark.parametrize("hot_rows", [2_000_000, 25])
def test_late_and_repeated_events_give_the_batch_result(spark, hot_rows):
    """Events of three hours in random order within 40 minutes, some twice, in six deliveries."""
    rng = random.Random(5)
    events = []
    for i in range(240):
        at = T0 + timedelta(seconds=rng.randrange(10_800), microseconds=rng.randrange(10**6))
        events.append((i, f"t{i}", rng.choice(["hot", "hot", "b", "c", None]), at, rng.choice("xyz"), rng.uniform(-80, 80), rng.uniform(-170, 170)))
    arrival = sorted(events, key=lambda e: e[3] + timedelta(seconds=rng.randrange(2_400)))
    feed = VelocityFeed(spark, delay=timedelta(minutes=40), hot_rows=hot_rows)
    for i in range(6):
        again = rng.sample(arrival[max(0, 40 * i - 20): 40 * i], 3) if i else []
        got = feed.deliver(arrival[40 * i: 40 * (i + 1)] + again)
    want = silver.silver_fraud(spark.createDataFrame(events, EVENT)).join(spark.createDataFrame(events, EVENT).select("transaction_id", "event_id"), "transaction_id")
    assert features_of(got) == features_of(want) and got.count() == 240
    assert feed.late() == []


def test_events_behind_the_watermark_and_expired_customers(spark):
    feed = VelocityFeed(spark, delay=timedelta(minutes=10), ttl=timedelta(days=1))
    at = lambda **k: T0 + timedelta(**k)
    feed.deliver([(1, "t1", "a", at(), "x", 0.0, 0.0), (2, "t2", "b", at(minutes=30), "x", 0.0, 0.0)])
    got = feed.deliver([(3, "t3", "a", at(minutes=15), "x", 0.0, 9.0), (4, "t4", "b", at(days=2), "x", 0.0, 1.0), (5, "t5", "b", None, "x", 0.0, 1.0)])
    assert feed.late() == [3, 5] and set(features_of(got)) == {1, 2, 4} and features_of(got)[4][1] > 100
    got = features_of(feed.deliver([(6, "t6", "a", at(days=2), "x", 0.0, 5.0), (7, "t7", "b", at(days=2, seconds=5), "x", 0.0, 1.0)]))
    assert got[6] == (1, 0.0, 0.0) and got[7] == (2, 0.0, 0.0)  # the rows of "a" have expired, those of "b" have not
    assert features_of(feed.run()) == got


def test_a_repeated_velocity_batch_replaces_its_first_attempt(spark):
    batch = lambda rows: spark.createDataFrame(rows, EVENT)
    sink, state = shared_dir(spark, "sink"), shared_dir(spark, "state")
    how = (sink, state, timedelta(hours=1), timedelta(days=9), 1000)
    velocity._process(batch([(1, "t1", "a", T0, "x", 0.0, 0.0)]), 0, *how)
    for _ in range(2):
        velocity._process(batch([(2, "t2", "a", T0 + timedelta(seconds=5), "x", 0.0, 1.0)]), 1, *how)
    got = features_of(velocity.current_features(spark, sink))
    assert got[2][0] == 2 and len(got) == 2 and spark.read.parquet(sink).count() == 2


def test_microseconds_survive_json(spark):
    path, t = shared_dir(spark, "json"), datetime(2024, 1, 1, 0, 0, 0, 123456)
    df = spark.createDataFrame([(t,)], "event_time timestamp")
    sinks.write_bronze(df, path)
    assert readers.read_bronze(spark, path, df.schema).first()[0] == t


def test_streamed_hours_equal_batch_hours(spark):
    scores = Fixtures(spark, SF)("tx_scores")
    feed = Feed(spark, scores.schema, pipelines.stream_gold_hourly)
    out = feed.deliver(scores)
    batch = gold.gold_fraud_hourly(scores).select(*out.columns)
    assert set(content(out)[1]) <= set(content(batch)[1]) and out.count() > 0
