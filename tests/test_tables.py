"""Incremental loads, dimensions, privacy and table operations."""

import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import FACT_FRAUD
from ledgerlake.operators import dimensions, gold, incremental, operations, privacy, relations
from ledgerlake.operators.quality import QualityError
from ledgerlake.plans.fixtures import Fixtures
from ledgerlake.plans.migration import encrypt_migrate, rollback
from ledgerlake.session import shared_dir
from ledgerlake.sources import readers, sinks
from tests.compare import rows as canonical_rows

SF = "/root/testdata/sf0.001"
KEY = bytes(range(32))


def content(df):
    return canonical_rows(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF)


@pytest.mark.parametrize("wm", [datetime(2024, 1, 10, 12), datetime(2024, 1, 10, 12, 59, 59, 999999), datetime(2023, 1, 1), datetime(2025, 1, 1)])
def test_incremental_equals_full(fx, wm):
    scores = fx("tx_scores")
    full = gold.gold_fraud_hourly(scores)
    old = gold.gold_fraud_hourly(scores.where(F.col("event_time") <= F.lit(wm)))
    new = incremental.refresh_gold(scores, wm, gold.gold_fraud_hourly, incremental.hour_bucket)
    assert content(incremental.merge_buckets(old, new, ["hour_bucket"])) == content(full)


def test_a_bucket_without_new_rows_is_not_touched(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 5),), (datetime(2024, 1, 1, 11, 0),)], "event_time timestamp")
    touched = incremental.touched_rows(df, datetime(2024, 1, 1, 10, 30), incremental.hour_bucket)
    assert [r[0].hour for r in touched.collect()] == [11]


def test_upsert_is_idempotent_and_prefers_the_newest(spark):
    a = spark.createDataFrame([("k", 1, datetime(2024, 1, 1)), ("l", 1, datetime(2024, 1, 1))], "k string, v int, updated_at timestamp")
    b = spark.createDataFrame([("k", 2, datetime(2024, 1, 1)), ("m", 2, datetime(2024, 1, 2))], "k string, v int, updated_at timestamp")
    once = incremental.upsert_latest(a, b, ["k"])
    assert sorted((r["k"], r["v"]) for r in once.collect()) == [("k", 2), ("l", 1), ("m", 2)]
    assert content(incremental.upsert_latest(once, b, ["k"])) == content(once)


def test_watermark_defaults_and_advances(spark):
    control = spark.createDataFrame([("a", datetime(2024, 1, 1), 5, None)], "table_name string, last_processed_timestamp timestamp, rows_processed bigint, updated_at timestamp")
    assert incremental.get_watermark(control, "zzz") == datetime(1970, 1, 1)
    moved = incremental.advance(control, "a", datetime(2024, 2, 1), 3, datetime(2024, 3, 1))
    assert tuple(moved.first()) == ("a", datetime(2024, 2, 1), 8, datetime(2024, 3, 1))
    assert incremental.advance(control, "b", datetime(2024, 2, 1), 3, datetime(2024, 3, 1)).count() == 2


def test_scd2_twice_is_once(fx):
    def load(dim, ts):
        return dimensions.scd2_apply(dim, fx("customer_src_v2"), "customer_id", ts, "crm", tracked=["customer_segment", "risk_profile"])

    first = dimensions.scd2_initial(fx("customer_src_v1"), "2023-01-01", "crm")
    once = load(first, "2024-01-01")
    assert content(load(once, "2024-02-01")) == content(once)
    assert once.where("is_current").groupBy("customer_id").count().where("count > 1").count() == 0


def test_scd2_takes_the_last_row_of_a_batch_and_null_is_a_value(spark):
    dim = dimensions.scd2_initial(spark.createDataFrame([("a", None), ("b", "x")], "id string, v string"), "2023-01-01", "s")
    src = spark.createDataFrame([("a", "p", 1), ("a", None, 2), ("b", None, 1)], "id string, v string, n int")
    out = dimensions.scd2_apply(dim, src, "id", "2024-01-01", "s", tracked=["v"], order="n")
    assert sorted((r["id"], r["v"] or "", r["is_current"]) for r in out.collect()) == [("a", "", True), ("b", "", True), ("b", "x", False)]


def test_surrogate_keys_stay_over_loads(spark):
    dim = dimensions.scd2_initial(spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "id string, v string"), "2023-01-01", "s",
                                  "id_key", "id")
    dim = dim.withColumn("is_current", F.when(F.col("id") != "c", F.col("is_current")))  # unknown: history, not lost
    src = spark.createDataFrame([("a", "y"), ("b", "x"), ("d", "x")], "id string, v string")
    load = lambda d, ts: dimensions.scd2_apply(d, src, "id", ts, "s", tracked=["v"], surrogate="id_key")
    once = load(dim, "2024-01-01")
    assert sorted((r.id, r.v, r.id_key) for r in once.collect()) == [("a", "x", 1), ("a", "y", 4), ("b", "x", 2), ("c", "x", 3), ("d", "x", 5)]
    assert content(load(once, "2024-02-01")) == content(once)
    with pytest.raises(ValueError, match="'a' comes 2 times"):
        dimensions.scd2_apply(dim, src.unionByName(src), "id", "2024-01-01", "s", tracked=["v"])


def test_account_balance_tolerance(spark):
    cols = "account_id string, account_status string, balance double"
    dim = dimensions.scd2_initial(spark.createDataFrame([("a", "s", 1.0), ("b", "s", None), ("c", "s", 1.0)], cols), "2023-01-01", "s")
    src = spark.createDataFrame([("a", "s", 1.005), ("b", "s", 0.0), ("c", "s", 1.02)], cols)
    out = dimensions.scd2_apply(dim, src, "account_id", "2024-01-01", "s", changed=dimensions.account_changed())
    assert {r["account_id"] for r in out.where("NOT is_current").collect()} == {"c"}


def test_calendar(spark):
    days = {r["date"]: r for r in dimensions.dim_date(spark).collect()}
    assert len(days) == 4018
    assert days[date(2021, 1, 3)]["week"] == 53 and days[date(2021, 1, 3)]["day_of_week"] == 6
    assert (days[date(2024, 6, 30)]["fiscal_year"], days[date(2024, 6, 30)]["fiscal_quarter"]) == (2023, 4)
    assert (days[date(2024, 7, 1)]["fiscal_year"], days[date(2024, 7, 1)]["fiscal_quarter"]) == (2024, 1)
    assert days[date(2024, 12, 30)]["date_key"] == 20241230 and days[date(2024, 12, 30)]["day_name"] == "Monday"


def test_dense_keys_do_not_depend_on_partitioning(fx):
    src = fx("customer_src_v2").select("customer_id")
    a = dimensions.assign_keys(src.repartition(3), ["customer_id"], start=10)
    b = dimensions.assign_keys(src.repartition(7), ["customer_id"], start=10)
    assert content(a) == content(b)
    keys = sorted(r["surrogate_key"] for r in a.collect())
    assert keys == list(range(11, 11 + len(keys)))


def test_labels_must_be_one_to_one(spark):
    f = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    with pytest.raises(relations.NotOneToOne, match="labels"):
        relations.join_labels(f, f.union(f), "k")
    assert relations.join_labels(f, f.where("k = 'a'").select("k", F.lit(1).alias("y")), "k").count() == 1


def test_audit_filters_are_optional(spark):
    e = spark.createDataFrame([("2024-01-02T00:00:00", "a", "r", "u")], "timestamp string, action string, resource string, user string")
    assert relations.query_audit(e).count() == 1
    assert relations.query_audit(e, action="a", start="2024-01-02").count() == 1
    assert relations.query_audit(e, user="v").count() == 0


def test_masking(spark):
    text = "mail a.b@c.org, call 555-123-4567, ssn 123-45-6789, card 4111 1111 1111 1111"
    df = spark.createDataFrame([(text, "c1"), (None, None)], "note string, customer_id string")
    out = privacy.mask_table(df, "salt").collect()
    assert out[0]["note"] == "mail ***MASKED***, call ***MASKED***, ssn ***MASKED***, card ***MASKED***"
    assert len(out[0]["customer_id"]) == 16 and out[1]["note"] is None and out[1]["customer_id"] is None
    found = {r["pattern"]: r["matches"] for r in privacy.pii_report(df, ["note"]).collect()}
    assert found["email"] == 1 and found["ssn"] == 1 and found["phone"] >= 1 and found["credit_card"] == 1


def test_hashes_are_not_mistaken_for_cards(spark):
    df = spark.createDataFrame([("4111111111111111",)], "customer_id string")
    out = privacy.mask_table(df, "").first()["customer_id"]
    assert out == privacy.hash_columns(df, ["customer_id"], "").first()["customer_id"]


def test_encryption_round_trip_is_idempotent_and_random(spark):
    df = spark.createDataFrame([("a", ("d", 1)), ("a", (None, 2)), (None, None)], "customer_id string, payload struct<device_id:string,n:int>")
    fields = ["customer_id", "payload.device_id", "absent"]
    sealed = privacy.encrypt_fields(df, fields, KEY, strict=False)
    values = [r["customer_id"] for r in sealed.collect()]
    assert values[0] != values[1] and values[0].startswith("ENC:") and values[2] is None
    twice = privacy.encrypt_fields(sealed, fields, KEY, strict=False)
    assert content(privacy.decrypt_fields(twice, fields, KEY)) == content(df)
    assert content(privacy.decrypt_fields(df, fields, KEY)) == content(df)
    assert privacy.undecryptable(sealed, ["customer_id"], bytes(32)).count() == 2
    assert privacy.encrypt_fields(df, fields, KEY, enabled=False) is df


def test_coverage_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "customer_id string")
    assert {r["percentage"] for r in privacy.encryption_coverage(empty, ["customer_id"]).collect()} == {0.0}


def test_migration_resumes(spark, fx):
    src, dst, progress = (shared_dir(spark, d) for d in ("m1", "m2", "m3"))
    rows = fx("tx_scores")
    rows.where("fraud_score < 0.5").write.parquet(src)
    encrypt_migrate(spark, src, dst, "silver", "fraud", KEY, progress)
    rows.where("fraud_score >= 0.5").write.mode("append").parquet(src)
    report = encrypt_migrate(spark, src, dst, "silver", "fraud", KEY, progress)
    assert {r["percentage"] for r in report.collect()} == {100.0}
    assert content(rollback(spark, dst, "silver", "fraud", KEY)) == content(rows)


def test_load_is_idempotent_and_bounded(spark, fx):
    root = shared_dir(spark, "w")
    rows = relations.derive_defaults(fx("tx_scores"), "2024-02-01", "m").withColumn("day", F.to_date("event_time"))
    for mode in ("full", "incremental", "incremental"):
        stats = sinks.load_table(rows, root, "fact", FACT_FRAUD, ["transaction_id"], mode, "day")
    assert stats.first()["rows_loaded"] == rows.count()
    assert content(spark.read.schema(rows.schema).parquet(f"{root}/fact")) == content(rows)
    bad = rows.withColumn("fraud_score", F.lit(None).cast("double"))
    with pytest.raises(QualityError, match="100 allowed"):
        sinks.load_table(bad, root, "fact", FACT_FRAUD, ["transaction_id"])


@pytest.mark.parametrize("name", ["", "drop", "a;b", "x" * 129, "___"])
def test_bad_identifiers(name):
    with pytest.raises(ValueError):
        sinks.identifier(name)


def test_required_columns(spark):
    with pytest.raises(readers.MissingColumns, match="nope"):
        readers.read_table(spark, f"{SF}/events.parquet", ["event_id", "nope"])


def test_files_by_modification_time(spark):
    path = shared_dir(spark, "mt")
    for v, age in ((1, 200), (2, 10)):
        spark.range(v).write.mode("append").json(path)
        for f in os.listdir(path):
            full = os.path.join(path, f)
            if f.endswith(".json") and os.path.getmtime(full) > time.time() - 100:
                stamp = time.time() - age * 86400
                if v == 1 or os.path.getmtime(full) > time.time() - 50:
                    os.utime(full, (stamp, stamp))
    now = datetime.now()
    schema = spark.range(1).schema
    assert readers.read_modified(spark, path, schema, now - timedelta(30), now).count() == 2
    old = readers.files_older_than(spark, path, now - timedelta(90), schema=schema)
    assert old.agg(F.sum("rows")).first()[0] == 1


def test_partition_numbers_belong_to_the_right_side(spark):
    bounds = operations.relative_boundaries(date(2024, 2, 1), "DAILY")
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 59),), (datetime(2024, 1, 2),), (datetime(2024, 2, 1),)], "ts timestamp")
    got = operations.partition_assign(df, "ts", bounds).orderBy("ts").collect()
    assert [r["partition_number"] for r in got] == [1, 2, 4] and got[2]["month"] == date(2024, 2, 1)
    assert operations.relative_boundaries(date(2024, 3, 25), "WEEKLY")[0] == date(2024, 1, 1)
    assert operations.month_cutoff(date(2024, 5, 20)) == date(2024, 2, 1)
    with pytest.raises(ValueError):
        operations.relative_boundaries(date(2024, 1, 1), "HOURLY")


def test_archive_keeps_every_row(spark, fx):
    scores, cut, dst = fx("tx_scores"), "2024-01-20", shared_dir(spark, "archive")
    dry = operations.archive_rows(scores, "event_time", cut).first()
    done = operations.archive_rows(scores, "event_time", cut, dst).first()
    assert dry["archived"] == done["archived"] and done["verified"] and not dry["verified"]
    both = operations.retained(scores, "event_time", cut).unionByName(spark.read.parquet(dst).drop("run"))
    assert content(both) == content(scores)


def test_statistics(spark, fx):
    fx("tx_scores").limit(10).write.mode("overwrite").saveAsTable("stats_target")
    assert "10 rows" in operations.table_maintenance(spark, "stats_target").first()["statistics"]
    spark.sql("DROP TABLE stats_target")


def test_backfill_of_a_day_equals_the_full_build(fx):
    from ledgerlake.plans.silver import silver_fraud

    full = silver_fraud(fx("tx_events")).where("CAST(event_time AS DATE) = DATE '2024-01-09'")
    assert content(operations.backfill_silver(fx("tx_events"), silver_fraud, "event_time", date(2024, 1, 9))) == content(full)


def test_dense_keys_over_many_buckets(fx, monkeypatch):
    monkeypatch.setattr(dimensions, "ROWS_PER_BUCKET", 10)
    src = fx("customer_src_v2").select("customer_id")
    keys = sorted(r["surrogate_key"] for r in dimensions.assign_keys(src, ["customer_id"]).collect())
    assert keys == list(range(1, len(keys) + 1))
