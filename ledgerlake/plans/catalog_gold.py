"""Gold aggregates, incremental loads and relational operators."""

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.contracts import FACT_FRAUD
from ledgerlake.operators import gold, incremental, relations
from ledgerlake.plans.catalog import query
from ledgerlake.plans.catalog_features import rounded
from ledgerlake.session import shared_dir
from ledgerlake.sources import sinks

WM = datetime(2024, 1, 15, 10, 30)
WM_SQL = "TIMESTAMP '2024-01-15 10:30:00'"
T0, T1 = "2024-01-15 12:00:00", "2024-02-01 00:00:00"

# Averages of two-digit scores: enough digits that no exact result lies half-way between two of them.
DIGITS = 10

FRAUD_MEASURES = """count(transaction_id) AS total_transactions, count(*) FILTER (WHERE fraud_score >= 0.7) AS flagged_transactions,
    count(*) FILTER (WHERE fraud_score >= 0.85) AS high_risk_count, round(avg(fraud_score), 10) AS avg_fraud_score,
    round(count(*) FILTER (WHERE fraud_score >= 0.7) / count(transaction_id), 10) AS fraud_rate"""
FRAUD_HOURLY = f"SELECT date_trunc('hour', event_time) AS hour_bucket, {FRAUD_MEASURES} FROM {{tx_scores}} GROUP BY 1"


def fraud_hourly(df, **kw):
    return rounded(gold.gold_fraud_hourly(df, **kw), DIGITS, "avg_fraud_score", "fraud_rate")


@query("gold_fraud_hourly", FRAUD_HOURLY)
def _(fx):
    return fraud_hourly(fx("tx_scores"))


@query(
    "gold_risk_daily",
    """SELECT CAST(event_time AS DATE) AS date, risk_band, count(DISTINCT account_id) AS account_count,
              round(avg(score), 10) AS avg_score, round(sum(score), 6) AS total_exposure
       FROM {risk_scores} GROUP BY 1, 2""",
    dates=("date",),
)
def _(fx):
    return rounded(rounded(gold.gold_risk_daily(fx("risk_scores")), DIGITS, "avg_score"), 6, "total_exposure")


SEGMENT = "CASE WHEN churn_probability >= 0.7 THEN 'high_risk' WHEN churn_probability >= 0.4 THEN 'medium_risk' ELSE 'low_risk' END"


@query(
    "gold_churn_weekly",
    f"""SELECT CAST(date_trunc('week', event_time) AS DATE) AS week, {SEGMENT} AS risk_segment,
               count(DISTINCT customer_id) AS customer_count, round(avg(churn_probability), 10) AS avg_churn_probability,
               count(*) FILTER (WHERE confidence >= 0.8) AS high_confidence_count
        FROM {{churn_scores}} GROUP BY 1, 2""",
    dates=("week",),
)
def _(fx):
    return rounded(gold.gold_churn_weekly(fx("churn_scores")), DIGITS, "avg_churn_probability")


@query(
    "gold_churn_approx",
    f"""SELECT CAST(date_trunc('week', event_time) AS DATE) AS week, {SEGMENT} AS risk_segment, true AS near,
               round(avg(churn_probability), 10) AS avg_churn_probability,
               count(*) FILTER (WHERE confidence >= 0.8) AS high_confidence_count
        FROM {{churn_scores}} GROUP BY 1, 2""",
    dates=("week",),
)
def _(fx):
    """The sketched count must lie within four standard errors of the exact one."""
    scores, keys = fx("churn_scores"), ["week", "risk_segment"]
    exact = gold.gold_churn_weekly(scores).select(*keys, F.col("customer_count").alias("exact"))
    both = gold.gold_churn_approx(scores).join(exact, keys)
    near = F.abs(F.col("customer_count") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 4 * 0.02)
    return rounded(both.withColumn("near", near).drop("customer_count", "exact"), DIGITS, "avg_churn_probability")


PERIOD = ("1995-01-01", "1997-12-31")
BILLED = "FROM {billing} WHERE usage_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'"


@query(
    "billing_by_service",
    f"SELECT cloud, replace(lower(service), ' ', '_') AS service, round(sum(cost), 2) AS total_cost {BILLED} GROUP BY 1, 2",
)
def _(fx):
    return rounded(gold.billing_by_service(fx("billing"), *PERIOD), 2, "total_cost")


@query(
    "billing_total",
    f"""SELECT cloud, service, round(sum(cost), 2) AS total_cost
        FROM (SELECT cloud, replace(lower(service), ' ', '_') AS service, cost {BILLED}) t GROUP BY ROLLUP (cloud, service)""",
)
def _(fx):
    return rounded(gold.billing_total(fx("billing"), *PERIOD), 2, "total_cost")


@query("load_rowcount", "SELECT count(*) AS rows FROM {tx_scores}")
def _(fx):
    return gold.load_rowcount(fx("tx_scores"))


# --- incremental ------------------------------------------------------------------------


@query(
    "cdc_watermark",
    """SELECT t.table_name, coalesce(c.last_processed_timestamp, TIMESTAMP '1970-01-01 00:00:00') AS last_processed_timestamp
       FROM (VALUES ('fraud_scores'), ('churn_scores'), ('credit_risk')) t(table_name)
       LEFT JOIN {cdc_control} c ON c.table_name = t.table_name""",
)
def _(fx):
    control = fx("cdc_control")
    one = [
        incremental.watermark_frame(control, t).select(F.lit(t).alias("table_name"), "last_processed_timestamp")
        for t in ("fraud_scores", "churn_scores", "credit_risk")
    ]
    return incremental.union_all(*one)


@query("cdc_new_rows", f"SELECT transaction_id, event_time, fraud_score FROM {{tx_scores}} WHERE event_time > {WM_SQL}")
def _(fx):
    return incremental.new_rows(fx("tx_scores"), WM).select("transaction_id", "event_time", "fraud_score")


NEW_AFTER_CONTROL = """
    WITH new AS (
      SELECT 'fraud_scores' AS table_name, max(event_time) AS ts, count(*) AS n FROM {tx_scores}
      WHERE event_time > (SELECT last_processed_timestamp FROM {cdc_control} WHERE table_name = 'fraud_scores')
      UNION ALL SELECT 'credit_risk', max(event_time), count(*) FROM {risk_scores})"""


@query(
    "cdc_advance",
    NEW_AFTER_CONTROL + """
    SELECT coalesce(c.table_name, n.table_name) AS table_name, coalesce(n.ts, c.last_processed_timestamp) AS last_processed_timestamp,
           CAST(coalesce(c.rows_processed, 0) + coalesce(n.n, 0) AS BIGINT) AS rows_processed,
           CASE WHEN n.n IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE c.updated_at END AS updated_at
    FROM {cdc_control} c FULL JOIN new n ON n.table_name = c.table_name""",
)
def _(fx):
    control = fx("cdc_control")
    fraud = relations.rows_after_watermark(fx("tx_scores"), control, "fraud_scores")
    risk = relations.rows_after_watermark(fx("risk_scores"), control, "credit_risk")
    update = incremental.union_all(
        incremental.batch_progress(fraud, "fraud_scores"), incremental.batch_progress(risk, "credit_risk")
    )
    return incremental.advance_with(control, update, T1)


def _old_and_new_gold(fx):
    scores = fx("tx_scores")
    old = gold.gold_fraud_hourly(scores.where(F.col("event_time") <= F.lit(WM)), batch_ts=T0)
    return old, scores


@query(
    "gold_upsert_latest",
    f"""WITH old AS (SELECT date_trunc('hour', event_time) AS hour_bucket, {FRAUD_MEASURES} FROM {{tx_scores}}
                     WHERE event_time <= {WM_SQL} GROUP BY 1),
             new AS (SELECT date_trunc('hour', event_time) AS hour_bucket, {FRAUD_MEASURES} FROM {{tx_scores}}
                     WHERE event_time > {WM_SQL} GROUP BY 1)
        SELECT *, TIMESTAMP '{T1}' AS updated_at FROM new
        UNION ALL SELECT *, TIMESTAMP '{T0}' FROM old WHERE hour_bucket NOT IN (SELECT hour_bucket FROM new)""",
)
def _(fx):
    old, scores = _old_and_new_gold(fx)
    new = gold.gold_fraud_hourly(incremental.new_rows(scores, WM), batch_ts=T1)
    merged = incremental.upsert_latest(old, new, ["hour_bucket"]).drop("created_at")
    return rounded(merged, DIGITS, "avg_fraud_score", "fraud_rate")


@query("gold_incremental", FRAUD_HOURLY)
def _(fx):
    old, scores = _old_and_new_gold(fx)
    refreshed = incremental.refresh_gold(
        scores, WM, lambda df: gold.gold_fraud_hourly(df, batch_ts=T1), incremental.hour_bucket
    )
    merged = incremental.merge_buckets(old, refreshed, ["hour_bucket"]).drop("created_at", "updated_at")
    return rounded(merged, DIGITS, "avg_fraud_score", "fraud_rate")


@query(
    "load_table",
    """SELECT transaction_id, customer_id, fraud_score, event_time, CAST(event_time AS DATE) AS day FROM {dirty_scores}
       WHERE fraud_score BETWEEN 0 AND 1""",
    dates=("day",),
)
def _(fx):
    """A full load under other days and with repeats, a full load of the rows up to the watermark, then
    all rows incrementally: nothing of the first is left, keys don't repeat, bad scores stay out."""
    rows = fx("dirty_scores").withColumn("day", F.to_date("event_time"))
    root = shared_dir(fx.spark, "warehouse")
    args = dict(contract=FACT_FRAUD, keys=["transaction_id"], partition_by="day", max_errors=10**12)
    first = rows.withColumn("day", F.to_date(F.lit("1999-01-01"))).withColumn("fraud_score", F.lit(0.5))
    doubled = relations.derive_defaults(first.unionByName(first), T0, "fraud_ml_model")
    sinks.load_table(doubled, root, "fact_fraud_scores", mode="full", **args)
    stamped = relations.derive_defaults(rows, T0, "fraud_ml_model")
    sinks.load_table(stamped.where(F.col("event_time") <= F.lit(WM)), root, "fact_fraud_scores", mode="full", **args)
    again = relations.derive_defaults(rows, T1, "fraud_ml_model")
    sinks.load_table(again, root, "fact_fraud_scores", mode="incremental", **args)
    loaded = fx.spark.read.schema(again.schema).parquet(f"{root}/fact_fraud_scores")
    return loaded.select("transaction_id", "customer_id", "fraud_score", "event_time", "day")


# --- joins, filters, sets ---------------------------------------------------------------


@query("join_labels", "SELECT s.transaction_id, fraud_score, is_fraud FROM {tx_scores} s JOIN {fraud_labels} l USING (transaction_id)")
def _(fx):
    joined = relations.join_labels(fx("tx_scores"), fx("fraud_labels"), "transaction_id")
    return joined.select("transaction_id", "fraud_score", "is_fraud")


@query(
    "join_watermark",
    """SELECT transaction_id, event_time FROM {tx_scores}
       WHERE event_time > (SELECT last_processed_timestamp FROM {cdc_control} WHERE table_name = 'fraud_scores')""",
)
def _(fx):
    return relations.rows_after_watermark(fx("tx_scores"), fx("cdc_control"), "fraud_scores").select(
        "transaction_id", "event_time"
    )


@query(
    "join_semi",
    f"""SELECT transaction_id, event_time FROM {{tx_scores}} WHERE date_trunc('hour', event_time) IN
          (SELECT date_trunc('hour', event_time) FROM {{tx_scores}} WHERE event_time > {WM_SQL})""",
)
def _(fx):
    scores = fx("tx_scores").withColumn("hour", incremental.hour_bucket(F.col("event_time")))
    touched = incremental.new_rows(scores, WM).select("hour").distinct()
    return relations.join_semi(scores, touched, "hour").select("transaction_id", "event_time")


@query(
    "touched_rows",
    f"""SELECT transaction_id, event_time FROM {{tx_scores}} WHERE date_trunc('hour', event_time) IN
          (SELECT date_trunc('hour', event_time) FROM {{tx_scores}} WHERE event_time > {WM_SQL})""",
)
def _(fx):
    return incremental.touched_rows(fx("tx_scores"), WM, incremental.hour_bucket).select("transaction_id", "event_time")


GAPS = """SELECT h AS hour FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-02-01 23:00:00',
    INTERVAL 1 HOUR)) AS h) t WHERE h NOT IN (SELECT date_trunc('hour', event_time) FROM {tx_events})"""


@query("bronze_gaps", GAPS)
def _(fx):
    return relations.bronze_gaps(fx("tx_events"), "2024-01-01 00:00:00", "2024-02-01 23:00:00")


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM {customer} WHERE c_custkey NOT IN (SELECT user_id FROM {events})""",
)
def _(fx):
    seen = fx("events").select(F.col("user_id").alias("c_custkey"))
    return fx("customer").select("c_custkey", "c_name").join(seen, "c_custkey", "left_anti")


@query(
    "sort_entity_time",
    """SELECT customer_id, event_time, seq, event_type, row_number() OVER (ORDER BY customer_id, event_time, seq) - 1 AS place
       FROM {crm_events}""",
)
def _(fx):
    """Written in order and read back file by file: every row's place in the files is its place in the order."""
    path = shared_dir(fx.spark, "sorted")
    relations.sort_entity_time(fx("crm_events"), "customer_id", "event_time", "seq").write.parquet(path)
    files = fx.spark.read.parquet(path).select(
        "customer_id", "event_time", "seq", "event_type", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i"))
    # One row for each file, in the order of their numbers.
    sizes = files.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    return files.join(begins, "file").withColumn("place", F.col("begin") + F.col("i")).drop("file", "i", "begin")


@query(
    "top1_per_key",
    """SELECT customer_id, transaction_id, fraud_score FROM {tx_scores}
       QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY fraud_score DESC, event_id) = 1""",
)
def _(fx):
    top = incremental.top1_per_key(fx("tx_scores"), ["customer_id"], [F.desc("fraud_score"), F.asc("event_id")])
    return top.select("customer_id", "transaction_id", "fraud_score")


@query(
    "union_all",
    """SELECT 'fraud' AS model, transaction_id AS id, fraud_score AS score FROM {tx_scores}
       UNION ALL SELECT 'credit', account_id, score FROM {risk_scores}
       UNION ALL SELECT 'churn', customer_id, churn_probability FROM {churn_scores}""",
)
def _(fx):
    def part(model, view, key, score):
        return fx(view).select(F.lit(model).alias("model"), F.col(key).alias("id"), F.col(score).alias("score"))

    return incremental.union_all(
        part("fraud", "tx_scores", "transaction_id", "fraud_score"),
        part("credit", "risk_scores", "account_id", "score"),
        part("churn", "churn_scores", "customer_id", "churn_probability"),
    )


@query(
    "filter_time_split",
    """SELECT CASE WHEN event_time < TIMESTAMP '2024-01-20 00:00:00' THEN 'train' ELSE 'test' END AS part,
              count(*) AS rows, min(event_time) AS first_time, max(event_time) AS last_time
       FROM {tx_scores} GROUP BY 1""",
)
def _(fx):
    train, test = relations.time_split(fx("tx_scores"), "event_time", "2024-01-20 00:00:00")
    parts = [df.withColumn("part", F.lit(name)) for name, df in (("train", train), ("test", test))]
    return incremental.union_all(*parts).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time")
    )


@query(
    "filter_audit",
    """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp, action, resource, "user" FROM {audit_events}
       WHERE action = 'fraud_score_request' AND resource = 'res1'
         AND strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' >= '2024-01-10T06:30:00'""",
)
def _(fx):
    logged = sinks.audit_rows(fx("audit_events"))
    found = relations.query_audit(logged, "fraud_score_request", "res1", None, "2024-01-10T06:30:00")
    return found.select("timestamp", "action", "resource", "user")


DEFAULTED = """SELECT transaction_id, customer_id, fraud_score, confidence, model_version, event_time,
    TIMESTAMP '2024-02-01 00:00:00' AS created_at, 'fraud_ml_model' AS data_source FROM {tx_scores}"""


@query("project_contract", DEFAULTED)
def _(fx):
    return relations.project_contract(relations.derive_defaults(fx("tx_scores"), T1, "fraud_ml_model"), FACT_FRAUD)


@query(
    "derive_defaults",
    """SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at,
              'credit_risk_model' AS data_source FROM {risk_scores}""",
)
def _(fx):
    return relations.derive_defaults(fx("risk_scores"), T1, "credit_risk_model")


