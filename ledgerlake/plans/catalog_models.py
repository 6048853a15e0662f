"""Training, scoring, evaluation and drift."""

from pyspark.sql import functions as F

from ledgerlake.contracts import FACT_CHURN, FACT_CREDIT
from ledgerlake.operators import evaluation, features, models, relations
from ledgerlake.plans import silver
from ledgerlake.plans.catalog import query
from ledgerlake.plans.catalog_features import rounded
from ledgerlake.session import stored

CUT = "2024-01-20 00:00:00"
SCORED_AT = "2024-02-01 00:00:00"


def report(model, test, spec, train):
    """The evaluation row of a fitted model on the held-out rows."""
    scored = models.probability(model, test, spec, "p")
    return evaluation.eval_binary(scored, spec.label, "p", spec.threshold).withColumn("train_size", F.lit(train.count()))


def fraud_features(fx):
    # Features are computed once: the label check, the fit, the report and scoring all read them.
    return stored(silver.silver_fraud(fx("tx_events")), "features")


def fraud_sets(fx, known):
    rows = relations.join_labels(known, fx("fraud_labels"), "transaction_id")
    return relations.time_split(rows, "event_time", CUT)


@query("train_fraud")
def _(fx):
    train, test = fraud_sets(fx, fraud_features(fx))
    return report(models.train(train, models.FRAUD), test, models.FRAUD, train)


def credit_sets(fx):
    latest = features.feature_snapshot(silver.silver_credit(fx("account_snapshots")), "account_id", "snapshot_date", "seq")
    rows = models.encode_repayment(relations.join_labels(stored(latest, "features"), fx("credit_labels"), "account_id"))
    return relations.time_split(rows, "snapshot_date", "2001-06-01 00:00:00")


@query("train_credit")
def _(fx):
    train, test = credit_sets(fx)
    return report(models.train(train, models.CREDIT), test, models.CREDIT, train)


def churn_sets(fx):
    """Features from what is known at the cutoff, labels from what follows; split by the last event before it."""
    known = fx("crm_events").where(F.col("event_time") < F.lit(CUT).cast("timestamp"))
    latest = features.feature_snapshot(silver.silver_churn(known), "customer_id", "event_time", "seq")
    rows = relations.join_labels(stored(latest, "features"), fx("churn_labels"), "customer_id")
    return relations.time_split(rows, "event_time", "2024-01-19 18:00:00")


@query("train_churn")
def _(fx):
    train, test = churn_sets(fx)
    return report(models.train(train, models.CHURN), test, models.CHURN, train)


@query(
    "class_weights",
    """SELECT is_fraud, count(*) AS n, round((SELECT count(*) FROM {fraud_labels}) / (2 * count(*)), 6) AS weight
       FROM {fraud_labels} GROUP BY 1""",
)
def _(fx):
    return rounded(models.class_weights(fx("fraud_labels"), "is_fraud"), 6, "weight")


@query(
    "dataset_fingerprint",
    """SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(1), customer_id, event_id, transaction_id)), 1, 15) AS BIGINT))
              AS VARCHAR) AS content_hash FROM {tx_scores}""",
)
def _(fx):
    return models.dataset_fingerprint(fx("tx_scores").select("event_id", "transaction_id", "customer_id"))


@query(
    "score_fraud",
    """SELECT event_id, round(fraud_score, 4) AS fraud_score,
              CASE WHEN fraud_score >= 0.85 THEN 'block' WHEN fraud_score >= 0.5 THEN 'challenge' ELSE 'allow' END AS decision,
              CASE WHEN fraud_score IS NULL THEN 'incomplete features' END AS error
       FROM {dirty_scores}""",
)
def _(fx):
    return models.decide(fx("dirty_scores")).select("event_id", "fraud_score", "decision", "error")


@query("score_fraud_model", "SELECT event_id, transaction_id FROM {tx_events}")
def _(fx):
    """Train, then score every transaction; the check covers that each one gets an answer."""
    rows = fraud_features(fx)
    train, _ = fraud_sets(fx, rows)
    model = models.train(train, models.FRAUD)
    scored = models.score_fraud(rows, model, "fraud_v1", SCORED_AT).where("decision IN ('allow', 'challenge', 'block')")
    return scored.select(F.substr("transaction_id", F.lit(4)).cast("bigint").alias("event_id"), "transaction_id")


@query(
    "score_credit",
    """SELECT seq, account_id, score, CASE WHEN score >= 0.5 THEN 'high' WHEN score >= 0.2 THEN 'medium' ELSE 'low' END AS risk_band
       FROM {risk_scores}""",
)
def _(fx):
    return models.band_scores(fx("risk_scores"), "score").select("seq", "account_id", "score", "risk_band")


@query(
    "score_churn",
    """SELECT seq, customer_id, churn_probability, CASE WHEN churn_probability >= 0.7 THEN 'high_risk'
              WHEN churn_probability >= 0.4 THEN 'medium_risk' ELSE 'low_risk' END AS segment
       FROM {churn_scores}""",
)
def _(fx):
    return models.segment_scores(fx("churn_scores")).select("seq", "customer_id", "churn_probability", "segment")


@query(
    "score_to_fact",
    """SELECT account_id AS id, risk_band AS class, score, greatest(score, 1 - score) AS confidence, 'risk_v1' AS model_version,
              event_time, event_time AS created_at, 'credit_risk_model' AS data_source FROM {risk_scores}
       UNION ALL
       SELECT customer_id, NULL, churn_probability, greatest(churn_probability, 1 - churn_probability), 'churn_v1',
              event_time, event_time, 'churn_model' FROM {churn_scores}""",
)
def _(fx):
    renames = {"pd_score": "score", "scored_at": "event_time"}
    credit = fx("risk_scores").select(
        "account_id", "risk_band", F.col("score").alias("pd_score"), F.col("event_time").alias("scored_at"),
        F.lit("risk_v1").alias("model_version"),
    )
    churn = fx("churn_scores").select(
        "customer_id", "churn_probability", F.col("event_time").alias("scored_at"), F.lit("churn_v1").alias("model_version")
    )
    a = models.score_to_fact(credit, FACT_CREDIT, renames, "pd_score")
    b = models.score_to_fact(churn, FACT_CHURN, {"scored_at": "event_time"}, "churn_probability")
    p = F.col("score")
    a = a.select(F.col("account_id").alias("id"), F.col("risk_band").alias("class"), "score",
                 F.greatest(p, 1 - p).alias("confidence"), "model_version", "event_time", "created_at", "data_source")
    b = b.select(F.col("customer_id").alias("id"), F.lit(None).cast("string").alias("class"),
                 F.col("churn_probability").alias("score"), "confidence", "model_version", "event_time", "created_at",
                 "data_source")
    return a.unionByName(b)


@query(
    "eval_binary",
    """WITH s AS (SELECT fraud_score AS s, is_fraud AS y FROM {tx_scores} JOIN {fraud_labels} USING (transaction_id)),
            g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY s),
            c AS (SELECT *, sum(neg) OVER (ORDER BY s) - neg / 2 AS below FROM g),
            t AS (SELECT sum(pos) FILTER (WHERE s > 0.5) AS tp, sum(neg) FILTER (WHERE s > 0.5) AS fp,
                         sum(neg) FILTER (WHERE s <= 0.5) AS tn, sum(pos) FILTER (WHERE s <= 0.5) AS fn,
                         sum(pos * below) AS u FROM c)
       SELECT CAST(tp + fp + tn + fn AS BIGINT) AS test_size, round(u / ((tp + fn) * (fp + tn)), 6) AS auc,
              round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
              CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn
       FROM t""",
)
def _(fx):
    scored = fx("tx_scores").join(fx("fraud_labels"), "transaction_id")
    return rounded(evaluation.eval_binary(scored, "is_fraud", "fraud_score"), 6, "auc", "precision", "recall", "f1")


@query(
    "ref_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                   CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {{drift_reference}}"""
        for c in ("value", "k")
    ),
)
def _(fx):
    return rounded(evaluation.ref_stats(fx("drift_reference"), ["value", "k"]), 6, "mean", "std")


def ks_sql(ref: str, cur: str, cols: dict[str, str]) -> str:
    one = """
      SELECT '{name}' AS "column", max(abs(f1 - f2)) AS d, max(n1) AS n1, max(n2) AS n2 FROM (
        SELECT v, sum(a) OVER w / CAST(n1 AS DOUBLE) AS f1, sum(b) OVER w / CAST(n2 AS DOUBLE) AS f2, n1, n2 FROM (
          SELECT v, count(*) FILTER (WHERE s = 1) AS a, count(*) FILTER (WHERE s = 2) AS b FROM (
            SELECT CAST({col} AS DOUBLE) AS v, 1 AS s FROM {{{ref}}} UNION ALL
            SELECT CAST({col} AS DOUBLE), 2 FROM {{{cur}}}) x WHERE v IS NOT NULL GROUP BY v) g,
          (SELECT count({col}) AS n1 FROM {{{ref}}}) c1, (SELECT count({col}) AS n2 FROM {{{cur}}}) c2
        WINDOW w AS (ORDER BY v)) y"""
    parts = " UNION ALL ".join(one.format(name=n, col=c, ref=ref, cur=cur) for n, c in cols.items())
    return f"""
      WITH ks AS ({parts}),
      l AS (SELECT *, sqrt(n1 * n2 / CAST(n1 + n2 AS DOUBLE)) AS en FROM ks),
      p AS (SELECT *, (en + 0.12 + 0.11 / en) * d AS lam FROM l),
      r AS (SELECT "column", d, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
             lambda i: (CASE WHEN i % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * i * i * lam * lam))))) END AS p FROM p)
      SELECT "column", round(d, 6) AS statistic, round(p, 2) AS p_near, p < 0.05 AS drift_detected FROM r"""


def near(found):
    """The exact p-value to the digits that it shares with the series the check computes."""
    return rounded(rounded(found, 6, "statistic").withColumn("p_near", F.round("p_value", 2)).drop("p_value"), 2, "p_near")


@query("drift_ks", ks_sql("drift_reference", "drift_current", {"value": "value", "k": "k"}))
def _(fx):
    return near(evaluation.drift_ks(fx("drift_reference"), fx("drift_current")))


@query("drift_predictions", ks_sql("tx_scores", "dirty_scores", {"fraud_score": "fraud_score"}))
def _(fx):
    found = evaluation.drift_predictions(fx("tx_scores"), fx("dirty_scores"), "fraud_score")
    return near(found)
