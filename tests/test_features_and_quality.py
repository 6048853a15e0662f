import math
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import BRONZE_CHURN, FACT_FRAUD
from ledgerlake.operators import features, gold, ingest, quality
from ledgerlake.operators.quality import QualityError

T0 = datetime(2024, 1, 1)


def tx(spark, seconds, customer="c"):
    rows = [(i, f"t{i}", customer, T0 + timedelta(seconds=s), "d", 0.0, 0.0) for i, s in enumerate(seconds)]
    cols = ("event_id bigint, transaction_id string, customer_id string, event_time timestamp, device_id string, "
            "latitude double, longitude double")
    return spark.createDataFrame(rows, cols)


def column(df, name, by):
    return [r[name] for r in df.orderBy(by).collect()]


def test_velocity_excludes_an_event_exactly_a_minute_old_and_counts_ties(spark):
    df = features.feat_tx_velocity(tx(spark, [0, 59, 60, 60, 119]))
    assert column(df, "tx_velocity_1m", "event_id") == [1, 2, 3, 3, 4 - 1]


def test_distance_is_zero_for_the_first_event_and_unknown_places(spark):
    rows = [(0, T0, 0.0, 0.0), (1, T0 + timedelta(1), 0.0, 180.0), (2, T0 + timedelta(2), None, None),
            (3, T0 + timedelta(3), 10.0, 10.0)]
    df = spark.createDataFrame(rows, "event_id bigint, event_time timestamp, latitude double, longitude double")
    got = column(features.feat_geo_distance(df.withColumn("customer_id", F.lit("c"))), "geo_distance_km", "event_id")
    assert got == [0.0, pytest.approx(math.pi * 6371), 0.0, 0.0]


def test_entropy_treats_a_missing_device_as_one_of_its_own(spark):
    rows = [(i, T0 + timedelta(i), d) for i, d in enumerate(["a", "b", None, None, "a", "a", "a", "a", "a"])]
    df = spark.createDataFrame(rows, "event_id bigint, event_time timestamp, device_id string").withColumn("customer_id", F.lit("c"))
    got = column(features.feat_device_entropy(df), "device_entropy", "event_id")
    assert got[0] == 0.0 and got[1] == pytest.approx(1.0) and got[3] == pytest.approx(1.5) and got[8] == 0.0


def test_credit_features_on_few_rows(spark):
    rows = [("a", date(2024, 1, 1), Decimal("10"), "paid", 1), ("a", date(2024, 3, 30), Decimal("20"), "missed", 2),
            ("a", date(2024, 3, 31), Decimal("40"), None, 3)]
    df = spark.createDataFrame(rows, "account_id string, snapshot_date date, balance decimal(18,2), repayment_status string, seq bigint")
    got = features.credit_features(df).orderBy("seq").collect()
    assert got[0]["balance_volatility"] is None  # one row has no deviation
    assert got[1]["balance_volatility"] == pytest.approx(math.sqrt(50))  # 89 days apart: same window
    assert got[2]["balance_volatility"] == pytest.approx(math.sqrt(200))  # the first has left the window
    assert got[1]["delinquency_trends"] == 0.5 and got[2]["repayment_history"] == ["paid", "missed"]


def test_decay_and_inactivity(spark):
    df = features.churn_features(tx(spark, [0, 86_399, 86_400, 200_000]).withColumn("event_type", F.lit("x")), tie="event_id")
    got = df.orderBy("event_id").collect()
    assert got[0]["transaction_decay"] == pytest.approx(sum(math.exp(-0.01 * i) for i in range(4)))
    assert [r["login_inactivity"] for r in got] == [2, 1, 1, 0]


def raw(spark, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "seq bigint, text string")
    return df.select("seq", F.base64(F.encode("text", "UTF-8")).alias("data"), F.lit("s").alias("sequence"), F.lit(0.0).alias("arrival"))


def test_defaults_apply_to_absent_keys_only(spark):
    parsed = ingest.parse_events(raw(spark, '{"event_id":"a"}', '{"event_id":"b","event_type":null,"payload":null}',
                                     ' {"event_id":7,"event_time":"2024-01-01T00:00:00Z","source_system":"pos"}'))
    a, b, c = parsed.orderBy("seq").collect()
    assert (a["event_type"], a["source_system"], a["payload"]) == ("payment_authorised", "cards", "{}")
    assert b["event_type"] is None and b["payload"] is None and b["source_system"] == "cards"
    assert c["event_id"] == "7" and c["event_time"] == T0 and c["source_system"] == "pos"


def test_unreadable_records_go_to_the_dead_letters(spark):
    good = raw(spark, '{"event_id":"a"}')
    bad = raw(spark, "{bad", "[1]", '"text"', "null", "").unionByName(
        good.select("seq", F.lit("%%%").alias("data"), "sequence", "arrival")
    ).unionByName(good.select("seq", F.base64(F.unhex(F.lit("7B22FF227D"))).alias("data"), "sequence", "arrival"))
    ok, dlq = ingest.split_valid(ingest.parse_events(good.unionByName(bad)), F.lit(T0))
    assert ok.count() == 1 and dlq.count() == 7
    assert {r["error"] for r in dlq.collect()} == {"invalid json", "record is not a json object"}


def test_ingest_counts_and_dedup(spark):
    counts = ingest.ingest_counts(ingest.parse_events(raw(spark, "{}", "x", "{}"))).first()
    assert (counts["processed"], counts["failed"], counts["total"]) == (2, 1, 3)
    df = spark.createDataFrame([("e", "2"), ("e", "1"), ("f", "9")], "event_id string, kinesis_sequence string")
    once = ingest.dedup_events(df)
    assert sorted(map(tuple, once.collect())) == [("e", "1"), ("f", "9")]
    assert sorted(map(tuple, ingest.dedup_events(once).collect())) == [("e", "1"), ("f", "9")]


def test_contract_fails_fast_or_splits(spark):
    df = spark.createDataFrame([("c", "2024-01-01", "x"), (None, "never", "x")], "customer_id string, event_time string, event_type string")
    checked = quality.check_contract(df, BRONZE_CHURN).collect()
    assert checked[0]["violations"] == [] and checked[1]["violations"] == ["customer_id:required", "event_time:type"]
    with pytest.raises(QualityError, match="customer_id:required=1"):
        quality.check_contract(df, BRONZE_CHURN, mode="fail")
    with pytest.raises(QualityError, match="event_type:missing"):
        quality.check_contract(df.drop("event_type"), BRONZE_CHURN, mode="fail")


def test_nan_counts_as_missing_not_as_too_large(spark):
    df = spark.createDataFrame([(0.5,), (float("nan"),), (None,), (1.5,)], "fraud_score double")
    r = quality.dq_fraud(df).first()
    assert (r["total_records"], r["null_scores"], r["out_of_range"], r["null_pct"], r["passed"]) == (4, 2, 1, 50.0, False)


def test_invalid_bands_are_counted(spark):
    df = spark.createDataFrame([("high", 0.5), ("none", 0.5), (None, None)], "risk_band string, score double")
    r = quality.dq_credit(df).first()
    assert (r["invalid_bands"], r["null_scores"], r["passed"]) == (2, 1, False)
    with pytest.raises(QualityError):
        quality.gate(quality.dq_credit(df))


@pytest.mark.parametrize(
    "tid, ok",
    [("a", True), ("tx-1_b", True), ("---", False), ("a b", False), ("", False), (None, False), ("x" * 100, True), ("x" * 101, False), ("é", False)],
)
def test_request_ids(spark, tid, ok):
    df = spark.createDataFrame([(tid, 0.0, 20000.0, 10.0)], "transaction_id string, tx_velocity_1m double, geo_distance_km double, device_entropy double")
    assert quality.validate_requests(df).first()["valid"] is ok


def test_constraints_report_surplus_keys(spark):
    rows = [("t1", "c", 0.5, 0.5, "m", T0), ("t1", "c", 1.5, 0.5, "m" * 51, T0), ("t1", None, 0.1, 0.5, "m", T0)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, fraud_score double, confidence double, model_version string, event_time timestamp")
    got = {(r["constraint"], r["column"]): r["violations"] for r in quality.check_constraints(df, FACT_FRAUD).collect()}
    assert got[("primary_key", "transaction_id")] == 2 and got[("not_null", "customer_id")] == 1
    assert got[("range", "fraud_score")] == 1 and got[("max_length", "model_version")] == 1


def test_gold_thresholds_are_inclusive_and_weeks_start_on_monday(spark):
    scores = [0.7, 0.85, 0.6999, float("nan"), None]
    df = spark.createDataFrame([(f"t{i}", T0, s) for i, s in enumerate(scores)], "transaction_id string, event_time timestamp, fraud_score double")
    r = gold.gold_fraud_hourly(df).first()
    assert (r["total_transactions"], r["flagged_transactions"], r["high_risk_count"]) == (5, 2, 1)
    assert r["avg_fraud_score"] == pytest.approx((0.7 + 0.85 + 0.6999) / 3) and r["fraud_rate"] == 0.4
    rows = [("a", datetime(2024, 1, 7, 23, 59), 0.7, 0.8), ("a", datetime(2024, 1, 8), 0.4, 0.79), ("b", datetime(2024, 1, 8), 0.39, None)]
    weekly = gold.gold_churn_weekly(spark.createDataFrame(rows, "customer_id string, event_time timestamp, churn_probability double, confidence double"))
    got = {(r["week"], r["risk_segment"]): r["high_confidence_count"] for r in weekly.collect()}
    assert got == {(date(2024, 1, 1), "high_risk"): 1, (date(2024, 1, 8), "medium_risk"): 0, (date(2024, 1, 8), "low_risk"): 0}


def test_approximate_cohorts_are_close(spark):
    df = spark.range(20_000).select(
        F.concat(F.lit("c"), F.col("id") % 5000).alias("customer_id"), F.lit(T0).alias("event_time"),
        F.lit(0.9).alias("churn_probability"), F.lit(0.9).alias("confidence"))
    assert gold.gold_churn_approx(df).first()["customer_count"] == pytest.approx(5000, rel=0.06)
