"""Slicing a hot entity must not change any result, and must actually split it."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import features, hotkeys
from ledgerlake.plans import silver
from ledgerlake.plans.fixtures import Fixtures

HOT = 700


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one customer; ties in time, missing devices and ids included."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(6000):
        who = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"c{rng.randrange(40)}"
        # bursts: many events within a minute, and equal instants
        t = start + timedelta(seconds=rng.randrange(0, 3600 * 24 * 5) // 37 * 37, microseconds=rng.choice([0, 1, 999999]))
        lat = None if i % 29 == 0 else float(rng.randrange(-90, 90))
        lon = None if lat is None else float(rng.randrange(-180, 180))
        rows.append((i, f"tx{i}", who, t, rng.choice(["d1", "d2", "d3", None]), lat, lon,
                     rng.choice(["complaint", "login", "pay"])))
    cols = ("event_id bigint, transaction_id string, customer_id string, event_time timestamp, device_id string, "
            "latitude double, longitude double, event_type string")
    df = spark.createDataFrame(rows, cols).withColumn("seq", F.col("event_id"))
    path = f"{spark.conf.get('spark.checkpoint.dir')}/skewed"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def same(a, b, key):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left = {r[key]: r for r in a.select(cols).collect()}
    right = {r[key]: r for r in b.select(cols).collect()}
    assert left.keys() == right.keys()
    for k, r in left.items():
        for c in cols:
            x, y = r[c], right[k][c]
            assert x == (pytest.approx(y, rel=1e-9, abs=1e-9) if isinstance(y, float) else y), (k, c, x, y)


@pytest.mark.parametrize("feature", ["feat_tx_velocity", "feat_geo_distance", "feat_device_entropy"])
def test_fraud_features(skewed, feature):
    fn = getattr(features, feature)
    same(fn(skewed), fn(skewed, hot_rows=HOT), "event_id")


def test_silver_fraud(skewed):
    same(silver.silver_fraud(skewed), silver.silver_fraud(skewed, hot_rows=HOT), "transaction_id")


def test_silver_fraud_with_tiny_slices(skewed):
    same(silver.silver_fraud(skewed), silver.silver_fraud(skewed, hot_rows=20), "transaction_id")


@pytest.mark.parametrize("feature", ["feat_tx_decay", "feat_login_inactivity", "feat_complaint_freq"])
def test_churn_features(skewed, feature):
    fn = getattr(features, feature)
    same(fn(skewed), fn(skewed, hot_rows=HOT), "event_id")


def test_silver_churn(skewed):
    same(silver.silver_churn(skewed), silver.silver_churn(skewed, hot_rows=50), "seq")


def test_silver_credit(spark):
    snaps = Fixtures(spark, "/root/testdata/sf0.001")("account_snapshots")
    snaps = snaps.withColumn("account_id", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("account_id")))
    same(silver.silver_credit(snaps), silver.silver_credit(snaps, hot_rows=60), "seq")
    same(features.feat_balance_volatility(snaps), features.feat_balance_volatility(snaps, hot_rows=60), "seq")


def test_rows_without_entity_have_no_features(skewed):
    lone = silver.silver_fraud(skewed).where("customer_id IS NULL")
    assert lone.count() > 0
    assert lone.where("tx_velocity_1m IS NOT NULL OR geo_distance_km IS NOT NULL").count() == 0


def test_hot_entity_is_cut_into_bounded_slices(skewed):
    found, limit = hotkeys.hot_entities(skewed, "customer_id", HOT)
    assert [r["customer_id"] for r in found.collect()] == ["hot"] and limit == HOT
    placed = skewed.withColumn("__pos", F.unix_micros("event_time"))
    sliced = hotkeys._with_halo(placed, "customer_id", "event_id", 4, 60_000_000, 60_000_000, 200, found)
    sliced = sliced.where("customer_id = 'hot'")
    sizes = [r["count"] for r in sliced.groupBy("__slice").count().collect()]
    assert len(sizes) >= 8
    assert max(sizes) < 400
    assert sliced.where("NOT __halo").count() == 2000


@pytest.mark.parametrize("hot_rows", [1, 50, 700])
def test_rows_per_task_follow_the_limit_whatever_the_total(skewed, hot_rows):
    """However small the limit against the total: every entity above it is hot, and its slices keep to it."""
    found, limit = hotkeys.hot_entities(skewed, "customer_id", hot_rows)
    counts = {r["customer_id"]: r["count"] for r in skewed.where("customer_id is not null").groupBy("customer_id").count().collect()}
    assert limit == hot_rows
    assert {r["customer_id"] for r in found.collect()} == {c for c, n in counts.items() if n > hot_rows}
    placed = skewed.withColumn("__pos", F.unix_micros("event_time"))
    sliced = hotkeys._with_halo(placed, "customer_id", "event_id", 0, 0, 60_000_000, 100, found)
    busiest = max(r["count"] for r in sliced.groupBy("customer_id", "__slice").count().where("customer_id is not null").collect())
    assert busiest <= max(hot_rows, 100 + 40)  # a minute's rows stay together
    assert sliced.count() == skewed.count()
