import math
import os
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlake.contracts import FACT_CREDIT
from ledgerlake.operators import evaluation, models, monitoring
from ledgerlake.operators.cumulative import running_totals

T0 = datetime(2024, 1, 1)


def test_decisions_use_the_unrounded_score_and_fail_open(spark):
    df = spark.createDataFrame([(0.84999,), (0.85,), (0.5,), (0.49999,), (None,), (float("nan"),)], "fraud_score double")
    got = [(r["decision"], r["fraud_score"]) for r in models.decide(df).collect()]
    assert got[:4] == [("challenge", 0.85), ("block", 0.85), ("challenge", 0.5), ("allow", 0.5)]
    assert [d for d, _ in got[4:]] == ["allow", "allow"]
    assert models.decide(df).where("error IS NOT NULL").count() == 2


def test_bands_and_segments(spark):
    df = spark.createDataFrame([(0.5, 0.7), (0.2, 0.4), (0.1999, 0.3999), (None, None)], "pd_score double, churn_probability double")
    assert [r["risk_band"] for r in models.band_scores(df).collect()] == ["high", "medium", "low", None]
    assert [r["segment"] for r in models.segment_scores(df).collect()] == ["high_risk", "medium_risk", "low_risk", None]


def test_scores_become_facts(spark):
    df = spark.createDataFrame([("a", 0.3, "medium", "v", T0)], "account_id string, pd_score double, risk_band string, model_version string, scored_at timestamp")
    r = models.score_to_fact(df, FACT_CREDIT, {"pd_score": "score", "scored_at": "event_time"}, "pd_score")
    assert r.columns == FACT_CREDIT.columns and r.first()["event_time"] == T0


def test_training_finds_the_signal_and_scores_every_row(spark):
    rng = random.Random(1)
    rows = [(f"t{i}", float(v), rng.random(), rng.random(), int(v > 50)) for i in range(600) for v in [rng.randrange(100)]]
    df = spark.createDataFrame(rows, "transaction_id string, tx_velocity_1m double, geo_distance_km double, device_entropy double, is_fraud int")
    spec = models.ForestSpec(models.FRAUD.features, "is_fraud", 10, 1, 5, 0.5)
    model = models.train(df, spec)
    report = evaluation.eval_binary(models.probability(model, df, spec, "p"), "is_fraud", "p").first()
    assert report["auc"] > 0.98
    gaps = df.withColumn("device_entropy", F.when(F.col("tx_velocity_1m") > 90, F.col("device_entropy")))
    scored = models.score_fraud(gaps, model, "v1", T0)
    assert scored.count() == 600
    assert scored.where("fraud_score IS NULL AND decision <> 'allow'").count() == 0
    assert scored.where("error IS NOT NULL").count() == df.where("tx_velocity_1m <= 90").count()


def test_credit_and_churn_scoring_answer_every_row(spark):
    rng = random.Random(2)
    credit = spark.createDataFrame(
        [(f"a{i}", ["missed"] * (i % 3) or None, rng.random() if i % 7 else None, float(i % 2), i % 2) for i in range(400)],
        "account_id string, repayment_history array<string>, balance_volatility double, delinquency_trends double, is_default int")
    spec = models.ForestSpec(models.CREDIT.features, "is_default", 5, 5, 3, 0.5)
    scored = models.score_credit(credit, models.train(models.encode_repayment(credit), spec), "v", T0)
    assert scored.count() == 400 and scored.where("pd_score IS NULL AND risk_band IS NULL").count() == 58
    churn = spark.createDataFrame([(f"c{i}", float(i), i % 9, 0.1, int(i > 350)) for i in range(400)],
                                  "customer_id string, transaction_decay double, login_inactivity int, complaint_frequency double, churned int")
    spec = models.ForestSpec(models.CHURN.features, "churned", 5, 5, 3, 0.3, balanced=True)
    model = models.train(churn, spec)
    got = models.score_churn(churn, model, "v", T0)
    assert got.count() == 400 and got.where("segment = 'high_risk'").count() >= 40


def test_models_survive_a_save(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 0.0, 0.0, i % 2, f"t{i}") for i in range(50)],
                               "tx_velocity_1m double, geo_distance_km double, device_entropy double, is_fraud int, transaction_id string")
    model = models.train(df, models.ForestSpec(models.FRAUD.features, "is_fraud", 3, 1, 3, 0.5))
    again = models.load_model(models.save_model(model, str(tmp_path), "fraud_v1"))
    pick = lambda m: [r["fraud_score"] for r in models.score_fraud(df, m, "v", T0).orderBy("transaction_id").collect()]
    assert pick(model) == pick(again)


def test_forests_grow_on_counts(spark, monkeypatch):
    """What a fit reads does not grow with the rows, and each cell is scored as most of its rows are."""
    read, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: read.append(df.count()) or fit(self, df))
    rows = spark.range(40_000).select(
        (F.col("id") % 2).cast("double").alias("tx_velocity_1m"), (F.col("id") % 5).cast("double").alias("geo_distance_km"),
        (F.col("id") % 3 / 7).alias("device_entropy"),
        ((F.pmod(F.hash("id"), F.lit(10)) == 0) != ((F.col("id") % 5 + F.col("id") % 2) % 2 == 0)).cast("int").alias("is_fraud"))
    spec = models.ForestSpec(models.FRAUD.features, "is_fraud", 9, 1, models.DEEPEST, 0.5)
    model = models.train(rows, spec)
    assert len(read) == 9 and max(read) <= 2 * 30 and model.stages[-1].getNumTrees == 9
    shares = models.probability(model, rows, spec, "p").groupBy(*spec.features).agg(F.avg("is_fraud").alias("share"), F.max("p").alias("p")).collect()
    assert len(shares) == 30 and all((r.share > 0.5) == (r.p > 0.5) for r in shares)
    assert models.train(rows.repartition(5), spec).stages[-1].toDebugString.count("Predict") == model.stages[-1].toDebugString.count("Predict")


def test_leaves_hold_so_many_rows_and_gaps_have_no_score(spark):
    rows = spark.range(300).select(F.col("id").cast("double").alias("tx_velocity_1m"), F.lit(1.0).alias("geo_distance_km"),
                                   F.lit(0.5).alias("device_entropy"), (F.col("id") < 40).cast("int").alias("is_fraud"))
    spec = models.ForestSpec(models.FRAUD.features, "is_fraud", 5, 100, 30, 0.5)
    assert all(t.numNodes <= 5 for t in models.train(rows, spec).stages[-1].trees)
    alone = models.train(rows, models.ForestSpec(models.FRAUD.features, "is_fraud", 5, 200, 30, 0.5))
    assert all(t.numNodes == 1 for t in alone.stages[-1].trees)
    gaps = rows.select(F.lit(None).cast("double").alias("tx_velocity_1m"), "geo_distance_km", F.lit(float("nan")).alias("device_entropy"))
    assert models.probability(alone, gaps, spec, "p").where("p IS NULL").count() == 300


def test_rows_are_scored_by_their_cells(spark, monkeypatch):
    """A forest sees its cells, whatever the number of rows, and every row gets what the forest would give it."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.pmod(F.hash("id"), F.lit(7)).cast("double").alias("tx_velocity_1m"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.hash("id", F.lit(1)), F.lit(20_000)) / 3).alias("geo_distance_km"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 3 / 7).otherwise(F.lit(float("nan"))).alias("device_entropy"),
        (F.pmod(F.hash("id"), F.lit(7)) + F.pmod(F.hash("id", F.lit(2)), F.lit(5)) > 6).cast("int").alias("is_fraud"))
    spec = models.ForestSpec(models.FRAUD.features, "is_fraud", 5, 1, models.DEEPEST, 0.5)
    model = models.train(rows, spec)
    p = F.get(models.vector_to_array(F.col("probability")), F.lit(1))
    want = {r[0]: r[1] for r in model.transform(rows).where("geo_distance_km IS NOT NULL AND NOT isnan(device_entropy)")
            .select("transaction_id", p).collect()}
    read, transform = [], models.PipelineModel.transform
    monkeypatch.setattr(models.PipelineModel, "transform", lambda self, df: read.append(df.count()) or transform(self, df))
    got = {r[0]: r[1] for r in models.probability(model, rows, spec, "p").select("transaction_id", "p").collect()}
    assert len(read) == 1 and read[0] <= 7 * 32 * 3
    assert len(got) == 20_000 and {k: v for k, v in got.items() if v is not None} == want
    cells = models.cell_scores(model, spec)
    read.clear()
    assert models.score_fraud(rows, model, "v", T0, cells).count() == 20_000 and not read


def test_balanced_training_weights_the_classes(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 9 + [(None,)], "churned int")
    w = {r["churned"]: r["weight"] for r in models.class_weights(df, "churned").collect()}
    assert w == {1: pytest.approx(2.0), 0: pytest.approx(12 / 18)}


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    a = models.dataset_fingerprint(df).first()
    assert a == models.dataset_fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    assert a != models.dataset_fingerprint(df.where("id > 0")).first()


@pytest.mark.parametrize("range_rows", [10**6, 10])
def test_auc_is_exact(spark, range_rows):
    rng = random.Random(3)
    rows = [(rng.choice([round(rng.random(), 2), rng.random(), 0.5]), int(rng.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = evaluation.eval_binary(df, "y", "s", range_rows=range_rows).first()
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="d", numBins=0).evaluate(df.withColumn("d", F.col("y").cast("double")))
    assert got["auc"] == pytest.approx(want, abs=1e-12)
    tp = sum(1 for s, y in rows if s > 0.5 and y)
    fp = sum(1 for s, y in rows if s > 0.5 and not y)
    assert (got["tp"], got["fp"], got["test_size"]) == (tp, fp, 2000)


def test_metrics_of_a_silent_model(spark):
    df = spark.createDataFrame([(0.5, 1), (0.1, 0)], "s double, y int")
    r = evaluation.eval_binary(df, "y", "s").first()
    assert (r["precision"], r["recall"], r["f1"], r["auc"]) == (0.0, 0.0, 0.0, 1.0)  # 0.5 is not above 0.5


@pytest.mark.parametrize("group", ["g", None])
def test_running_totals_over_ranges_equal_a_plain_window(spark, group):
    rng = random.Random(5)
    values = sorted({rng.choice([rng.gauss(0, 1), float(rng.randrange(5))]) for _ in range(3000)})
    df = spark.createDataFrame([("g", v, i % 7) for i, v in enumerate(values)], "g string, v double, n int")
    a = running_totals(df, "v", ["n"], group, range_rows=10**6)
    b = running_totals(df, "v", ["n"], group, range_rows=37)
    pick = lambda d: sorted((r["v"], r["cum_n"], r["total_n"]) for r in d.collect())
    assert pick(a) == pick(b)


@pytest.mark.parametrize("range_rows", [10**6, 5])
def test_drift(spark, range_rows):
    rng = np.random.default_rng(0)
    a, b, c = rng.normal(0, 1, 1000), rng.normal(0.5, 1, 1000), rng.normal(0, 1, 1000)
    ref = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, a)] + [(None, float("nan"))], "moved double, same double")
    cur = spark.createDataFrame([(float(x), float(y)) for x, y in zip(b, c)], "moved double, same double")
    got = {r["column"]: r for r in evaluation.drift_ks(ref, cur, range_rows=range_rows).collect()}
    grid = np.sort(np.concatenate([a, b]))
    d = np.abs(np.searchsorted(np.sort(a), grid, "right") - np.searchsorted(np.sort(b), grid, "right")).max() / 1000
    assert got["moved"]["statistic"] == pytest.approx(d) and got["moved"]["drift_detected"] and got["moved"]["p_value"] < 1e-6
    assert not got["same"]["drift_detected"] and got["same"]["p_value"] > 0.05
    assert evaluation.any_drift(evaluation.drift_ks(ref, cur))


def test_p_value_against_known_points(spark):
    # Kolmogorov distribution: P(K > 1.3581) = 0.05, P(K > 1.6276) = 0.01
    from ledgerlake.functions.stats import ks_p_value

    n = 10**8
    en = math.sqrt(n * n / (2 * n))
    for lam, p in ((1.3581, 0.05), (1.6276, 0.01)):
        got = spark.range(1).select(ks_p_value(F.lit(lam / en), F.lit(float(n)), F.lit(float(n))).alias("p")).first()["p"]
        assert got == pytest.approx(p, rel=1e-3)


def breaches(spark, *rows):
    metrics = spark.createDataFrame([("l", m, v) for m, v, _ in rows], "layer string, metric string, value double")
    slo = spark.createDataFrame([("l", m, s) for m, _, s in rows], "layer string, metric string, slo double")
    return {r["metric"]: r["severity"] for r in monitoring.slo_breaches(metrics, slo).collect()}


def test_severity(spark):
    got = breaches(
        spark, ("event_latency_p99", 751.0, 500.0), ("dlq_count", 125.0, 100.0), ("data_freshness", 17.9, 15.0),
        ("schema_drift_count", 1.0, 0.0), ("drift_score", 0.05, 0.05), ("daily_spend", 1.0, 0.0), ("model_accuracy", 89.0, 90.0),
        ("delivery_success_rate", 99.8, 99.9), ("etl_success_rate", 99.9, 99.9), ("table_freshness", float("inf"), 60.0),
    )
    assert got == {"event_latency_p99": "critical", "dlq_count": "warning", "data_freshness": "info",
                   "schema_drift_count": "critical", "daily_spend": "warning", "model_accuracy": "info",
                   "delivery_success_rate": "critical", "table_freshness": "critical"}


def test_freshness_of_an_empty_table_is_infinite(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    assert monitoring.freshness(empty, "ts", T0).first()[0] == float("inf")


def test_alarm_needs_consecutive_periods_and_gaps_do_not_breach(spark):
    at = lambda m: T0 + timedelta(minutes=m)
    samples = [("m", at(0), 90.0), ("m", at(5), 90.0), ("m", at(15), 90.0), ("m", at(20), 90.0), ("m", at(25), 80.0)]
    df = spark.createDataFrame(samples, "metric string, ts timestamp, value double")
    rules = spark.createDataFrame([("a", "m", "Average", 300, 80.0, 2)], "alarm string, metric string, statistic string, period_s int, threshold double, n int")
    got = [(r["breach"], r["firing"]) for r in monitoring.windowed_alarms(df, rules).orderBy("period_start").collect()]
    assert got == [(True, False), (True, True), (False, False), (True, False), (True, True), (False, False)]


def test_counter_restart(spark):
    rows = [("s", T0 + timedelta(seconds=60 * i), v) for i, v in enumerate([10, 40, 5, 65])]
    df = spark.createDataFrame(rows, "s string, ts timestamp, value bigint")
    got = [r["rate"] * 300 for r in monitoring.counter_rate(df, "s").orderBy("ts").collect()]
    assert got == pytest.approx([0, 30, 35, 95])


def test_quantile_interpolates_inside_the_bucket(spark):
    inf = float("inf")
    rows = [("a", 1.0, 50), ("a", 2.0, 100), ("a", inf, 100), ("b", 1.0, 0), ("b", inf, 10)]
    df = spark.createDataFrame(rows, "k string, le double, cum_count bigint")
    got = {r["k"]: r["quantile"] for r in monitoring.histogram_quantile(df, 0.95, ["k"]).collect()}
    assert got == {"a": pytest.approx(1.9), "b": 1.0}


def test_replay_guard_against_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, f"c{rng.randrange(2)}", rng.choice(["hot", f"n{rng.randrange(4)}"]), rng.randrange(4000), rng.choice([0, 300, 301, -301])) for i in range(1500)]
    df = spark.createDataFrame(rows, "seq bigint, client_id string, nonce string, req_sec bigint, skew_sec int")
    want, last = {}, {}
    for seq, c, n, t, skew in sorted(rows, key=lambda r: (r[3], r[0])):
        if abs(skew) > 300:
            want[seq] = "skewed"
        elif (c, n) in last and t - last[c, n] <= 300:
            want[seq] = "replayed"
        else:
            want[seq], last[c, n] = "accepted", t
    assert {r["seq"]: r["verdict"] for r in monitoring.replay_guard(df).collect()} == want


def test_rate_limit_against_brute_force(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice(["hot", "hot", f"c{rng.randrange(3)}"]), rng.randrange(5), rng.randrange(60)) for i in range(1200)]
    df = spark.createDataFrame(rows, "seq bigint, client_id string, minute_bucket int, req_sec bigint")
    used, want = defaultdict(int), {}
    for seq, c, m, s in sorted(rows, key=lambda r: (r[3], r[0])):
        used[c, m] += 1
        want[seq] = used[c, m] <= 20
    assert {r["seq"]: r["accepted"] for r in monitoring.rate_limit(df, rpm=20).collect()} == want


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_replay_guard_of_long_runs(spark, block):
    """Runs without a pause, ties, nulls and several keys, cut into blocks of any length."""
    rng = random.Random(2)
    rows = []
    for key in ("a", "b", "c", None):
        t = -2000
        for _ in range(400):
            t += rng.choice([0, 1, 40, 150, 299, 300, 301, 900])
            rows.append((len(rows), key, "n", t, rng.choice([0, 0, 0, 301])))
    df = spark.createDataFrame(rows, "seq bigint, client_id string, nonce string, req_sec bigint, skew_sec int")
    last, want = {}, {}
    for seq, key, _, t, skew in sorted(rows, key=lambda r: (r[3], r[0])):
        free = key is not None and (key not in last or t - last[key] > 300)
        want[seq] = "skewed" if skew > 300 else "accepted" if free else "replayed"
        if want[seq] == "accepted":
            last[key] = t
    assert {r.seq: r.verdict for r in monitoring.replay_guard(df, block=block).collect()} == want


def test_replay_guard_of_a_million_seconds(spark):
    """One nonce used every second for eleven days: accepted is every 301st, and no plan collects a group in a row."""
    df = spark.range(1_000_000).select(
        F.col("id").alias("seq"), F.lit("c").alias("client_id"), F.lit("n").alias("nonce"), F.col("id").alias("req_sec"), F.lit(0).alias("skew_sec"))
    out = monitoring.replay_guard(df)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    found = out.groupBy("verdict").agg(F.count("*").alias("n"), F.sum((F.col("seq") % 301 == 0).cast("int")).alias("m")).collect()
    assert {(r.verdict, r.n, r.m) for r in found} == {("accepted", 3323, 3323), ("replayed", 1_000_000 - 3323, 0)}


def test_exact_p_value_counts_interleavings():
    """Against the share of all orders of two samples whose statistic is as large; no formula in common."""
    from itertools import combinations
    from math import comb

    from ledgerlake.functions.stats import ks_exact

    for n1, n2 in ((1, 1), (2, 3), (4, 4), (5, 7), (6, 3)):
        found = []
        for places in combinations(range(n1 + n2), n1):
            a = b = worst = 0
            for i in range(n1 + n2):
                a, b = (a + 1, b) if i in places else (a, b + 1)
                worst = max(worst, abs(a * n2 - b * n1))
            found.append(worst)
        for d in {*found, 0}:
            want = sum(x >= d for x in found) / comb(n1 + n2, n1)
            assert ks_exact(d / (n1 * n2), n1, n2) == pytest.approx(want, abs=1e-12)
    assert ks_exact(0.05, 4000, 5000) == pytest.approx(2.8e-5, rel=0.2)  # the series says 2.9e-5


def test_small_samples_get_the_exact_p_value(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(5)], "v double")
    cur = spark.createDataFrame([(i + 3.5,) for i in range(4)], "v double")
    got = evaluation.drift_ks(ref, cur).first()
    assert got.statistic == pytest.approx(0.8) and got.p_value == pytest.approx(10 / 126)
    assert evaluation.drift_ks(ref, cur, exact_size=3).first().p_value != pytest.approx(10 / 126)


def test_file_freshness_opens_no_file(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not a parquet file")  # reading it would fail
    os.utime(path / "part-0.parquet", (1_700_000_000, 1_700_000_000))
    now = datetime.fromtimestamp(1_700_000_600, timezone.utc)
    assert monitoring.file_freshness(spark, str(path), now).first()[0] == pytest.approx(10.0)
    (path / "part-0.parquet").unlink()
    assert monitoring.file_freshness(spark, str(path), now).first()[0] == float("inf")
