"""Loads, archives and stream sinks must not lose, repeat or overwrite rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import FACT_FRAUD
from ledgerlake.operators import ingest, monitoring, operations, privacy
from ledgerlake.operators.quality import QualityError
from ledgerlake.session import instant, shared_dir
from ledgerlake.sources import sinks
from ledgerlake.streaming import pipelines

COLS = ("transaction_id string, customer_id string, fraud_score double, confidence double, model_version string, "
        "event_time timestamp, updated_at timestamp, day string")
T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def facts(spark, *rows, at=T0):
    data = [(t, "c", s, 0.9, "v1", at, at, day) for t, s, day in rows]
    return spark.createDataFrame(data, COLS).withColumns({"created_at": F.col("updated_at"), "data_source": F.lit("m")})


def load(spark, root, df, mode="incremental", **kw):
    sinks.load_table(df, root, "fact", FACT_FRAUD, ["transaction_id"], mode, "day", T0, **kw)
    out = spark.read.schema(df.schema).parquet(f"{root}/fact")
    return sorted((r.transaction_id, r.fraud_score, r.day or "") for r in out.collect())


def test_null_partitions_are_merged(spark):
    root = shared_dir(spark, "w")
    load(spark, root, facts(spark, ("a", 0.1, None), ("b", 0.2, "x"), ("z", 0.3, "y")))
    got = load(spark, root, facts(spark, ("c", 0.4, None), ("d", 0.5, "x"), at=T1))
    assert got == [("a", 0.1, ""), ("b", 0.2, "x"), ("c", 0.4, ""), ("d", 0.5, "x"), ("z", 0.3, "y")]


def test_a_key_may_change_its_partition(spark):
    root = shared_dir(spark, "w")
    load(spark, root, facts(spark, ("a", 0.1, "x y"), ("b", 0.2, "z"), ("c", 0.3, "z")))
    moved = facts(spark, ("a", 0.9, "z"), ("b", 0.8, "new"), at=T1)
    assert load(spark, root, moved) == [("a", 0.9, "z"), ("b", 0.8, "new"), ("c", 0.3, "z")]
    assert load(spark, root, moved) == [("a", 0.9, "z"), ("b", 0.8, "new"), ("c", 0.3, "z")]


def test_full_load_replaces_everything_and_repeats_count_once(spark):
    root = shared_dir(spark, "w")
    load(spark, root, facts(spark, ("a", 0.1, "x"), ("b", 0.2, "y")), "full")
    assert load(spark, root, facts(spark, ("b", 0.3, "y"), ("b", 0.3, "y"), at=T1), "full") == [("b", 0.3, "y")]


def test_rejected_rows_are_kept_aside_with_what_they_broke(spark):
    root = shared_dir(spark, "w")
    rows = facts(spark, ("a", 0.1, "x"), ("b", 1.7, "x"), ("c", None, "x"))
    assert load(spark, root, rows, max_errors=2) == [("a", 0.1, "x")]
    rejected = {r.transaction_id: r.violations for r in spark.read.parquet(f"{root}/fact_rejected").collect()}
    assert rejected == {"b": ["fraud_score:range"], "c": ["fraud_score:required"]}
    log = spark.read.json(f"{root}/load_log").first()
    assert (log["rows_loaded"], log["rows_rejected"]) == (1, 2) and log["duration_seconds"] > 0
    with pytest.raises(QualityError):
        load(spark, root, rows, max_errors=1)


def test_archiving_twice_keeps_both_runs_and_shrinks_the_table(spark):
    path, dst = shared_dir(spark, "active"), shared_dir(spark, "archive")
    rows = spark.createDataFrame([(i, datetime(2024, 1, 1 + i)) for i in range(9)] + [(99, None)], "id int, ts timestamp")
    rows.write.parquet(path)
    for day in (4, 6, 6):
        operations.archive_table(spark, path, "ts", datetime(2024, 1, day), dst)
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [5, 6, 7, 8, 99]


def test_a_new_checkpoint_does_not_overwrite_earlier_batches(spark):
    src, bronze, dlq = (shared_dir(spark, d) for d in ("raw", "bronze", "dlq"))
    schema = "data string, sequence string, arrival timestamp"
    data = [(ids, f"{i}", T0) for i, ids in enumerate(("eyJldmVudF9pZCI6ImEifQ==", "bm9wZQ=="))]
    spark.createDataFrame(data, schema).write.parquet(src)
    for cp in ("cp1", "cp2"):
        raw = spark.readStream.schema(schema).parquet(src)
        pipelines.stream_ingest(raw, bronze, dlq, shared_dir(spark, cp), once=True).awaitTermination()
    assert spark.read.json(bronze).count() == 2 and spark.read.json(dlq).count() == 2


def test_events_without_an_id_stay_and_sequences_are_numbers(spark):
    rows = [("a", "10"), ("a", "9"), (None, "1"), (None, "1"), ("b", "007"), ("b", "12")]
    df = spark.createDataFrame(rows, "event_id string, kinesis_sequence string")
    got = sorted(((r[0] or ""), r[1]) for r in ingest.dedup_events(df).collect())
    assert got == [("", "1"), ("", "1"), ("a", "9"), ("b", "007")]


def test_requests_without_a_client_are_limited(spark):
    df = spark.createDataFrame([(None, 1, i, i) for i in range(5)], "client_id string, minute_bucket int, req_sec int, seq int")
    assert [r.accepted for r in monitoring.rate_limit(df, rpm=2).orderBy("seq").collect()] == [True, True, False, False, False]


def test_fields_inside_a_json_payload_are_sealed(spark):
    key = bytes(range(32))
    payload = '{"device_id":"d \\"1\\"","customer_id":"c-1","transaction_id":"t-1","n":[1,2.5,null]}'
    df = spark.createDataFrame([(payload,), ("no json",), (None,)], "payload string")
    fields = privacy.pii_fields("bronze", "fraud")
    sealed = privacy.encrypt_fields(df, fields, key)
    text = sealed.first()["payload"]
    assert "c-1" not in text and "t-1" not in text and '"n":[1,2.5,null]' in text
    coverage = {r["field"]: r["encrypted"] for r in privacy.encryption_coverage(sealed, [*fields, "absent"]).collect()}
    assert coverage == {"customer_id": 1, "transaction_id": 1, "payload.device_id": 1, "absent": 0, "__all__": 3}
    opened = privacy.decrypt_fields(sealed, fields, key)
    same = opened.select(F.try_parse_json("payload").cast("string").alias("v")).first()["v"]
    assert "c-1" in same and '"d \\"1\\""' in same
    with pytest.raises(privacy.MissingField):
        privacy.encrypt_fields(df.select(F.lit(1).alias("x")), fields, key)


def test_fields_inside_a_json_payload_are_changed_in_one_pass(spark):
    """Odd objects keep their form, an unreadable value leaves valid JSON, and each text is parsed once for all its fields."""
    fields, key = privacy.pii_fields("bronze", "fraud"), bytes(range(32))
    texts = ['{"a": 1}', '{"customer_id":null, "a": 1}', "{}", "[1]", '{"customer_id":"c\\n\\"1","device_id":7,"n":null,"q\\"":"ü"}']
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    sealed = privacy.encrypt_fields(df, fields, key)
    got = [r.payload for r in sealed.collect()]
    assert got[:4] == texts[:4] and json.loads(got[4])["device_id"].startswith("ENC:")
    opened = [r.payload for r in privacy.decrypt_fields(sealed, fields, key).collect()]
    assert opened[:4] == texts[:4] and json.loads(opened[4]) == {**json.loads(texts[4]), "device_id": "7"}
    lost = json.loads(privacy.decrypt_fields(sealed, fields, bytes(32)).collect()[4]["payload"])
    assert lost == {**json.loads(texts[4]), "customer_id": None, "device_id": None}
    plan = sealed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_naive_instants_are_utc(spark):
    stamp = spark.range(1).select(F.unix_micros(instant(datetime(2024, 1, 1, 5)))).first()[0]
    assert stamp == 1704085200000000
