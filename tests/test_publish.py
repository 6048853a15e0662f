"""Whatever step of a publication fails, the table has all of its old rows or all of its new ones."""

import dataclasses
import glob
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.contracts import FACT_FRAUD
from ledgerlake.operators import features, operations
from ledgerlake.plans import refresh, silver
from ledgerlake.session import shared_dir
from ledgerlake.sources import publish, sinks
from tests.test_writers import T0, T1, facts


class Stopped(Exception):
    pass


def stop_at(monkeypatch, step: int, after: bool):
    """Raise at the given file operation of a publication, before or after it is done."""
    count = {"n": 0}
    for name in ("move", "delete", "write_text"):
        real = getattr(publish.Area, name)

        def wrapped(self, *args, real=real):
            count["n"] += 1
            if count["n"] == step and not after:
                raise Stopped
            out = real(self, *args)
            if count["n"] == step and after:
                raise Stopped
            return out

        monkeypatch.setattr(publish.Area, name, wrapped)


def rows_of(spark, path):
    publish.recover(spark, path)
    return sorted((r.transaction_id, r.fraud_score, r.day) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("mode, partition_by", [("full", None), ("full", "day"), ("incremental", None), ("incremental", "day")])
def test_a_load_stopped_anywhere_leaves_old_or_new_rows(spark, mode, partition_by):
    root = shared_dir(spark, "w")
    old = facts(spark, ("a", 0.1, "x"), ("b", 0.2, "y"), ("c", 0.3, "z"))
    new = facts(spark, ("a", 0.9, "y"), ("d", 0.4, "x y"), ("b", 0.8, "y"), at=T1)
    keys = ["transaction_id"]
    sinks.load_table(old, root, "want", FACT_FRAUD, keys, "full", partition_by, T0)
    before = rows_of(spark, f"{root}/want")
    sinks.load_table(new, root, "want", FACT_FRAUD, keys, mode, partition_by, T1)
    after = rows_of(spark, f"{root}/want")
    assert before != after and len(after) == (3 if mode == "full" else 4)
    sinks.load_table(old, root, "fact", FACT_FRAUD, keys, "full", partition_by, T0)
    seen = set()
    for step in range(1, 40):
        for late in (False, True):
            with pytest.MonkeyPatch.context() as patch:
                stop_at(patch, step, late)
                try:
                    sinks.load_table(new, root, "fact", FACT_FRAUD, keys, mode, partition_by, T1)
                    ended = True
                except Stopped:
                    ended = False
            got = rows_of(spark, f"{root}/fact")
            assert got in (before, after)
            seen.add(got == after)
            assert not os.path.exists(f"{root}/_fact.incoming")
            sinks.load_table(old, root, "fact", FACT_FRAUD, keys, "full", partition_by, T0)
            assert rows_of(spark, f"{root}/fact") == before
        if ended:
            break
    assert ended and seen == {False, True}


def test_a_job_that_fails_leaves_the_table(spark):
    root = shared_dir(spark, "w")
    sinks.load_table(facts(spark, ("a", 0.1, "x")), root, "fact", FACT_FRAUD, ["transaction_id"], "full", None, T0)
    bad = facts(spark, ("b", 0.1, "x")).withColumn("day", F.expr("raise_error('no')"))
    for write in (lambda: publish.publish_table(bad, f"{root}/fact"), lambda: publish.publish_partitions(bad, f"{root}/fact", ["day"])):
        with pytest.raises(Exception, match="no"):
            write()
        assert rows_of(spark, f"{root}/fact") == [("a", 0.1, "x")]


def test_rows_appended_during_an_archive_stay(spark, monkeypatch):
    path, dst = shared_dir(spark, "active"), shared_dir(spark, "archive")
    rows = spark.range(40).select("id", (F.col("id") % 4).alias("part"), F.timestamp_seconds(F.col("id") * 86_400).alias("ts"))
    rows.write.partitionBy("part").parquet(path)
    spark.range(100, 104).select("id", (F.col("id") % 4).alias("part"), F.timestamp_seconds(F.lit(50 * 86_400)).alias("ts")).where(
        "part = 3").write.mode("append").partitionBy("part").parquet(path)
    real = operations.archive_rows

    def slow(*args, **kw):
        out = real(*args, **kw)
        spark.range(200, 204).select("id", (F.col("id") % 4).alias("part"), F.timestamp_seconds(F.lit(0)).alias("ts")).write.mode(
            "append").partitionBy("part").parquet(path)
        return out

    monkeypatch.setattr(operations, "archive_rows", slow)
    operations.archive_table(spark, path, "ts", datetime(1970, 1, 11), dst, ["part"], "one")
    left = sorted(r.id for r in spark.read.parquet(path).collect())
    assert left == [*range(10, 40), 103, 200, 201, 202, 203]
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == list(range(10))


def test_an_archive_stopped_anywhere_loses_nothing(spark):
    path = shared_dir(spark, "active")
    spark.range(20).select("id", F.timestamp_seconds(F.col("id") * 86_400).alias("ts")).write.parquet(path)
    dst = shared_dir(spark, "archive")
    for step in range(1, 30):
        with pytest.MonkeyPatch.context() as patch:
            stop_at(patch, step, step % 2 == 0)
            try:
                operations.archive_table(spark, path, "ts", datetime(1970, 1, 6), dst)
                ended = True
            except Stopped:
                ended = False
        publish.recover(spark, path)
        there = {r.id for r in spark.read.parquet(path).collect()}
        assert there in (set(range(20)), set(range(5, 20)))
        assert there | {r.id for r in spark.read.parquet(dst).collect()} == set(range(20))
        if ended:
            break
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(5, 20))


def files(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_maintenance_joins_small_files_and_leaves_the_rest(spark, partition_by):
    path = shared_dir(spark, "table")
    rows = spark.range(3000).select("id", F.concat(F.lit("p "), F.when(F.col("id") < 2000, 0).otherwise(1)).alias("part"), F.rand(1).alias("v"))
    rows.where("id < 2000").repartition(12).write.partitionBy(*partition_by).parquet(path)
    rows.where("id >= 2000").repartition(2).write.mode("append").partitionBy(*partition_by).parquet(path)
    before, want = files(path), sorted(map(tuple, spark.read.parquet(path).select("id", "part", "v").collect()))
    report = operations.maintain(spark, path, partition_by, ["id"], target_bytes=1 << 20, least_files=4).first()
    after = files(path)
    joined = 12 if partition_by else 14
    assert (report["partitions"], report["files_before"], report["files_after"]) == (1, joined, 1)
    assert len(after) == len(before) - joined + 1
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "part", "v").collect())) == want
    if partition_by:
        kept = {f for f in before if "p%201" in f or "p 1" in f}
        assert len(kept) == 2 and {f: before[f] for f in kept} == {f: after[f] for f in kept}
    assert operations.maintain(spark, path, partition_by, target_bytes=1 << 20, least_files=4).first()["files_before"] == 0
    assert files(path) == after
    several = operations.maintain(spark, path, partition_by, target_bytes=8 << 10, least_files=1).first()
    assert several["files_before"] == 0  # none is small against that


def test_twenty_refreshes_in_a_row(spark):
    root, facts_dir = shared_dir(spark, "warehouse"), shared_dir(spark, "facts")
    jobs = [f(f"{facts_dir}/{n}", "ingested_at") for n, f in
            (("fraud", refresh.fraud_job), ("risk", refresh.risk_job), ("churn", refresh.churn_job))]
    at = datetime(2024, 1, 1)
    for run in range(20):
        stamp = at + timedelta(days=run)
        base = spark.range(3).select(F.concat(F.lit("k"), F.col("id")).alias("transaction_id"), F.lit("c").alias("customer_id"),
                                     F.lit("a").alias("account_id"), F.lit(0.5).alias("fraud_score"), F.lit(0.5).alias("score"),
                                     F.lit(0.5).alias("churn_probability"), F.lit(0.9).alias("confidence"), F.lit("high").alias("risk_band"),
                                     F.lit(stamp).alias("event_time"), F.lit(stamp).alias("ingested_at"))
        for job in jobs:
            base.coalesce(1).write.mode("append").parquet(job.fact)
        assert refresh.warehouse_refresh(spark, jobs, root, stamp, least_files=6).count() == 3
    log = spark.read.json(f"{root}/load_log")
    assert log.count() == 60 and log.where("duration_seconds > 0").count() == 60
    control = {r.table_name: r.rows_processed for r in spark.read.parquet(f"{root}/cdc_control").collect()}
    assert control == {job.source: 60 for job in jobs}
    assert spark.read.parquet(f"{root}/{jobs[0].contract.name}").count() == 20


def test_a_repeated_replay_emits_each_event_once(spark):
    path, target = shared_dir(spark, "bronze"), shared_dir(spark, "stream")
    schema = "event_id string, seq bigint, value double"
    rows = [(f"e{i % 30}", i, 0.5) for i in range(50)] + [(None, 99, 1.0)]
    df = spark.createDataFrame(rows, schema)
    df.write.json(path)
    start = datetime.now() - timedelta(hours=1)

    def replay(run=None):
        operations.bronze_replay(spark, path, df.schema, start, target=target, order="seq", run_id=run).count()
        there = spark.read.schema(schema).json(target)
        return sorted(r.seq for r in there.where("event_id is not null").collect())

    assert replay("one") == list(range(30)) == replay("two") == replay("one") == replay()
    spark.createDataFrame([("e7", 70, 0.0), ("new", 71, 0.0)], schema).write.mode("append").json(path)
    assert replay("three") == [*range(30), 71]


def test_backfill_by_rank_equals_the_full_build_and_reads_what_it_needs(spark, tmp_path):
    path, day = str(tmp_path / "snapshots"), date(2024, 3, 1)
    first = datetime(2021, 1, 1)
    rows = []
    for i in range(1200):
        who = "abcdefgh"[i % 8]
        if who == "a":  # seen long ago and on the day
            at = first + timedelta(days=i % 40)
        elif who == "b":
            at = datetime(2023, 6, 1) + timedelta(hours=7 * i % 6000)
        elif who == "h":  # not on the day
            at = first + timedelta(days=i % 400)
        else:
            at = datetime(2024, 2, 1) + timedelta(hours=i % 600)
        rows.append((who, at, float(i * 37 % 101), "paid late missed".split()[i % 3], i))
    rows += [(w, datetime(2024, 3, 1, 3), 5.0, "paid", 5000 + i) for i, w in enumerate("abcdefg")] + [(None, datetime(2024, 3, 1, 4), 1.0, "late", 6000)]
    df = spark.createDataFrame(rows, "account_id string, snapshot_date timestamp, balance double, repayment_status string, seq bigint")
    df = df.withColumn("balance", F.col("balance").cast("decimal(18,2)"))
    df.repartitionByRange(24, "snapshot_date").sortWithinPartitions("snapshot_date").write.parquet(path)
    table = spark.read.parquet(path)
    args = dict(rows=features.REPAYMENT_ROWS - 1, entity="account_id", tie="seq")
    got = operations.backfill_silver(table, silver.silver_credit, "snapshot_date", day, timedelta(days=features.VOLATILITY_DAYS), **args)
    full = silver.silver_credit(table).where(F.col("snapshot_date").cast("date") == F.lit(day))
    key = lambda r: (r.account_id or "", r.seq)
    show = lambda d: [(key(r), r.repayment_history, round(r.delinquency_trends or 0, 9), round(r.balance_volatility or 0, 6))
                      for r in sorted(d.collect(), key=key)]
    assert show(got) == show(full) and len(show(got)) == 8
    needed = operations.day_with_last_rows(table, "snapshot_date", day, 11, "account_id", "seq", timedelta(days=90))
    early = needed.where(F.col("snapshot_date") < F.lit("2023-12-02").cast("timestamp")).groupBy("account_id").count().collect()
    assert {r.account_id: r["count"] for r in early} == {"a": 11}  # the others are served by the 90 days
    none = operations.day_with_last_rows(table, "snapshot_date", date(2030, 1, 1), 11, "account_id", "seq")
    assert none.count() == 0


def test_a_row_of_the_watermark_instant_that_lands_later_reaches_gold(spark):
    """Progress by instants skips it, progress by files does not; a run that stops before its last step is repeated."""
    stamp = datetime(2024, 1, 2)

    def fact(name, *ids):
        rows = [(f"t{i}", "c", 0.5, stamp, stamp) for i in ids]
        cols = "transaction_id string, customer_id string, fraud_score double, event_time timestamp, ingested_at timestamp"
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(name)

    for by_files, want in ((False, 2), (True, 3)):
        root, path = shared_dir(spark, "warehouse"), shared_dir(spark, "fact")
        job = dataclasses.replace(refresh.fraud_job(path, "ingested_at"), by_files=by_files)
        fact(path, 1, 2)
        refresh.warehouse_refresh(spark, [job], root, stamp)
        fact(path, 3)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(refresh.incremental, "commit_files", lambda *a: (_ for _ in ()).throw(Stopped()))
            try:
                refresh.warehouse_refresh(spark, [job], root, stamp + timedelta(hours=1))
            except Stopped:
                pass
        refresh.warehouse_refresh(spark, [job], root, stamp + timedelta(hours=2))
        assert spark.read.parquet(f"{root}/{job.contract.name}").first().total_transactions == want
        assert refresh.warehouse_refresh(spark, [job], root, stamp + timedelta(hours=3)).count() == 0


def test_an_interrupted_migration_reports_what_is_left(spark):
    from ledgerlake.plans.migration import encrypt_migrate, encrypted_files, migration_status

    src, dst, progress = (shared_dir(spark, d) for d in ("plain", "sealed", "progress"))
    key, cols = bytes(range(32)), "customer_id string, transaction_id string, v int"
    assert publish.Area(spark, src).exists(src) is False
    spark.createDataFrame([("c1", "t1", 1), ("c2", None, 2)], cols).coalesce(1).write.parquet(src)
    first = set(files(src))
    assert {r.state for r in migration_status(spark, src, progress).collect()} == {"pending"}
    encrypt_migrate(spark, src, dst, "silver", "fraud", key, progress, max_files=1)
    assert {r.state for r in migration_status(spark, src, progress).collect()} == {"done"}
    with open(f"{src}/part-zzz-broken.parquet", "wb") as f:
        f.write(b"PAR1 not parquet")
    with pytest.raises(Exception):
        encrypt_migrate(spark, src, dst, "silver", "fraud", key, progress, max_files=1)
    with open(f"{src}/part-zzzz-later.parquet", "wb") as f:
        f.write(b"PAR1 neither")
    states = {r.file: r.state for r in migration_status(spark, src, progress).collect()}
    assert states == {**dict.fromkeys(first, "done"), "part-zzz-broken.parquet": "failed", "part-zzzz-later.parquet": "pending"}
    assert [(r.rows, r.encrypted, r.plain) for r in encrypted_files(spark, dst, "silver", "fraud").collect()] == [(2, 3, 0)]
