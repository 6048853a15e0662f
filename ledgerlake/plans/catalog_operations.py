"""Metrics, objectives, alarms, request guards and table operations."""

import re
import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ledgerlake.contracts import BRONZE_CHURN, FACT_FRAUD
from ledgerlake.operators import evaluation, features, gold, monitoring, operations, quality, relations
from ledgerlake.operators.ingest import parse_events, split_valid
from ledgerlake.plans import refresh, silver
from ledgerlake.plans.catalog import query
from ledgerlake.plans.catalog_features import COMPLAINTS, DECAY, INACTIVITY, SILVER_FRAUD, rounded
from ledgerlake.plans.catalog_lake import bronze_files, raw_stream
from ledgerlake.session import shared_dir
from ledgerlake.sources import readers, sinks

NOW = "2024-02-01 00:00:00"
BILLING_PERIOD = ("1996-01-01", "1996-01-30")

FRESH = "(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(event_time))) / 60000000.0"


@query("freshness", f"SELECT round({FRESH}, 6) AS freshness_minutes FROM {{tx_events}}")
def _(fx):
    return rounded(monitoring.freshness(fx("tx_events"), "event_time", NOW), 6, "freshness_minutes")


@query("file_freshness", "SELECT event_type AS folder, count(*) AS rows, true AS fresh FROM {tx_events} GROUP BY 1")
def _(fx):
    """Partitions written just now are fresh by the time of their files, whatever the time of their events."""
    path = shared_dir(fx.spark, "bronze")
    fx("tx_events").write.partitionBy("event_type").parquet(path)
    ages = monitoring.file_freshness(fx.spark, path, datetime.now().astimezone(), by_folder=True)
    ages = ages.select(F.regexp_extract("folder", "=(.*)$", 1).alias("folder"), (F.abs("freshness_minutes") < 60).alias("fresh"))
    rows = fx.spark.read.parquet(path).groupBy(F.col("event_type").alias("folder")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(ages, "folder")


FIVE_MIN = "time_bucket(INTERVAL '5 minutes', event_time)"
LATENCY = f"""SELECT {FIVE_MIN} AS window_start, max(latency_ms) AS max_latency_ms,
    round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms, round(sum(delivered) * 100.0 / count(*), 6) AS success_rate,
    count(*) AS records FROM {{arrivals}} GROUP BY 1"""


@query("stream_latency", LATENCY)
def _(fx):
    return rounded(monitoring.stream_latency(fx("arrivals")), 6, "p99_latency_ms", "success_rate")


BAD = "(raw = '{{bad' OR raw = '[1]')"


def dead_letters(fx):
    """Unreadable records, failed when they arrived."""
    arrived = F.timestamp_seconds("kinesis_timestamp")
    return split_valid(parse_events(raw_stream(fx)).withColumn("arrived", arrived), F.col("arrived"))[1]


@query(
    "dlq_hourly",
    f"""SELECT date_trunc('hour', arrival_time) AS hour, count(*) AS dlq_count, count(*) > 100 AS breached
        FROM {{tx_raw}} WHERE {BAD} GROUP BY 1""",
)
def _(fx):
    return monitoring.dlq_hourly(dead_letters(fx))


VALID = """regexp_full_match(transaction_id, '[A-Za-z0-9_-]*[A-Za-z0-9][A-Za-z0-9_-]*') AND tx_velocity_1m BETWEEN 0 AND 1000
    AND geo_distance_km BETWEEN 0 AND 20000 AND coalesce(device_entropy BETWEEN 0 AND 10, false)"""


@query("validity_rate", f"SELECT round(avg(CASE WHEN {VALID} THEN 1 ELSE 0 END) * 100, 6) AS validity_rate FROM {{feature_rows}}")
def _(fx):
    checked = quality.validate_requests(fx("feature_rows"))
    return rounded(monitoring.validity_rate(checked, F.col("valid")), 6, "validity_rate")


SPEND = "(SELECT sum(cost) FROM {billing} WHERE usage_date BETWEEN DATE '1996-01-01' AND DATE '1996-01-30') / 30"


@query(
    "cost_metrics",
    f"""SELECT round({SPEND}, 4) AS daily_spend, round({SPEND} / (SELECT count(*) FROM {{tx_scores}}), 6) AS cost_per_prediction""",
)
def _(fx):
    costs = monitoring.cost_metrics(fx("billing"), fx("tx_scores"), *BILLING_PERIOD)
    return rounded(rounded(costs, 4, "daily_spend"), 6, "cost_per_prediction")


# largest distance between the score distributions before and after the middle of the period
DRIFT = """(SELECT max(abs(1.0 * a / n1 - 1.0 * b / n2)) FROM (
      SELECT sum(old) OVER o AS a, sum(new) OVER o AS b, sum(old) OVER () AS n1, sum(new) OVER () AS n2 FROM (
        SELECT fraud_score AS v, count(*) FILTER (WHERE event_time < TIMESTAMP '2024-01-15 00:00:00') AS old,
               count(*) FILTER (WHERE event_time >= TIMESTAMP '2024-01-15 00:00:00') AS new FROM {tx_scores} GROUP BY 1) c
      WINDOW o AS (ORDER BY v)) d)"""
SNAPSHOT_SQL = f"""
    SELECT 'streaming_ingestion' AS layer, 'event_latency_p99' AS metric, CAST(max(p99_latency_ms) AS DOUBLE) AS value FROM ({LATENCY}) a
    UNION ALL SELECT 'streaming_ingestion', 'delivery_success_rate', sum(delivered) * 100.0 / count(*) FROM {{arrivals}}
    UNION ALL SELECT 'streaming_ingestion', 'dlq_count', max(n)
      FROM (SELECT count(*) AS n FROM {{tx_raw}} WHERE {BAD} GROUP BY date_trunc('hour', arrival_time)) b
    UNION ALL SELECT 'bronze', 'data_freshness', {FRESH} FROM {{tx_events}}
    UNION ALL SELECT 'bronze', 'schema_drift_count', count(*) FILTER (WHERE customer_id IS NULL OR event_type IS NULL
                       OR try_cast(event_time AS TIMESTAMP) IS NULL) FROM {{crm_text}}
    UNION ALL SELECT 'silver', 'feature_validity_rate', avg(CASE WHEN {VALID} THEN 1 ELSE 0 END) * 100 FROM {{feature_rows}}
    UNION ALL SELECT 'ml', 'model_accuracy', avg(CASE WHEN (fraud_score > 0.5) = (is_fraud = 1) THEN 1 ELSE 0 END) * 100
      FROM {{tx_scores}} JOIN {{fraud_labels}} USING (transaction_id)
    UNION ALL SELECT 'warehouse', 'table_freshness',
      (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(date_trunc('hour', event_time)))) / 60000000.0 FROM {{tx_scores}}
    UNION ALL SELECT 'silver', 'transformation_success_rate', 100.0 * count(*) FILTER (WHERE NOT {BAD}) / count(*) FROM {{tx_raw}}
    UNION ALL SELECT 'ml', 'inference_latency_p99', quantile_cont(latency_ms, 0.99) FROM {{arrivals}} WHERE delivered = 1
    UNION ALL SELECT 'ml', 'drift_score', {DRIFT}
    UNION ALL SELECT 'warehouse', 'etl_success_rate', 100.0 * count(*) FILTER (WHERE fraud_score BETWEEN 0 AND 1) / count(*)
      FROM {{dirty_scores}}
    UNION ALL SELECT 'cost', 'daily_spend', {SPEND}
    UNION ALL SELECT 'cost', 'cost_per_prediction', {SPEND} / (SELECT count(*) FROM {{tx_scores}})"""


def snapshot(fx):
    m = monitoring
    arrivals, scores = fx("arrivals"), fx("tx_scores")
    latency = m.stream_latency(arrivals).agg(
        F.max("p99_latency_ms").alias("p99"), (F.sum(F.col("success_rate") * F.col("records")) / F.sum("records")).alias("ok")
    )
    dlq = m.dlq_hourly(dead_letters(fx)).agg(F.max("dlq_count").alias("n"))
    drift = quality.check_contract(fx("crm_text"), BRONZE_CHURN).agg(F.count_if(F.size("violations") > 0).alias("n"))
    validity = m.validity_rate(quality.validate_requests(fx("feature_rows")), F.col("valid"))
    labelled = scores.join(fx("fraud_labels"), "transaction_id")
    accuracy = evaluation.accuracy(evaluation.eval_binary(labelled, "is_fraud", "fraud_score"))
    hours = gold.gold_fraud_hourly(scores)
    costs = m.cost_metrics(fx("billing"), scores, *BILLING_PERIOD)
    parsed = m.validity_rate(parse_events(raw_stream(fx)), F.col("ok"))
    answered = arrivals.where("delivered = 1").groupBy("latency_ms").count()
    inference = answered.agg(F.percentile("latency_ms", F.lit(0.99), F.col("count")).alias("p99"))
    middle = F.col("event_time") < F.lit("2024-01-15").cast("timestamp")
    drifted = evaluation.drift_predictions(scores.where(middle), scores.where(~middle), "fraud_score")
    loaded = quality.check_contract(relations.derive_defaults(fx("dirty_scores"), NOW, "m"), FACT_FRAUD, values=True)
    return m.metrics_snapshot(
        m.metrics(parsed, "silver", transformation_success_rate="validity_rate"),
        m.metrics(inference, "ml", inference_latency_p99="p99"),
        m.metrics(drifted, "ml", drift_score="statistic"),
        m.metrics(m.validity_rate(loaded, F.size("violations") == 0), "warehouse", etl_success_rate="validity_rate"),
        m.metrics(latency, "streaming_ingestion", event_latency_p99="p99", delivery_success_rate="ok"),
        m.metrics(dlq, "streaming_ingestion", dlq_count="n"),
        m.metrics(m.freshness(fx("tx_events"), "event_time", NOW), "bronze", data_freshness="freshness_minutes"),
        m.metrics(drift, "bronze", schema_drift_count="n"),
        m.metrics(validity, "silver", feature_validity_rate="validity_rate"),
        m.metrics(accuracy, "ml", model_accuracy="model_accuracy"),
        m.metrics(m.freshness(hours, "hour_bucket", NOW), "warehouse", table_freshness="freshness_minutes"),
        m.metrics(costs, "cost", daily_spend="daily_spend", cost_per_prediction="cost_per_prediction"),
    )


@query("metrics_snapshot", f"SELECT layer, metric, round(value, 4) AS value FROM ({SNAPSHOT_SQL}) s")
def _(fx):
    return rounded(snapshot(fx), 4, "value")


@query("join_slo", f"SELECT layer, metric, round(value, 4) AS value, slo FROM ({SNAPSHOT_SQL}) s JOIN {{slo_targets}} USING (layer, metric)")
def _(fx):
    return rounded(relations.join_slo(snapshot(fx), fx("slo_targets")), 4, "value")


LOWER = ", ".join(f"'{m}'" for m in monitoring.LOWER_IS_BETTER)
CRITICAL = ", ".join(f"'{m}'" for m in monitoring.ALWAYS_CRITICAL)


@query(
    "slo_breaches",
    f"""SELECT layer, metric, round(value, 4) AS value, slo,
               CASE WHEN metric IN ({CRITICAL}) THEN 'critical' WHEN slo = 0 THEN 'warning'
                    WHEN abs(value - slo) / slo > 0.5 THEN 'critical' WHEN abs(value - slo) / slo > 0.2 THEN 'warning' ELSE 'info' END AS severity
        FROM ({SNAPSHOT_SQL}) s JOIN {{slo_targets}} USING (layer, metric)
        WHERE CASE WHEN metric IN ({LOWER}) THEN value > slo ELSE value < slo END""",
)
def _(fx):
    return rounded(monitoring.slo_breaches(snapshot(fx), fx("slo_targets")), 4, "value")


@query(
    "windowed_alarms",
    """WITH p AS (
         SELECT r.alarm, r.statistic, r.threshold, r.n, r.period_s,
                CAST(floor(epoch_us(s.ts) / 1000000 / r.period_s) * r.period_s AS BIGINT) AS t,
                avg(value) AS a, max(value) AS m, sum(value) AS s
         FROM {metric_samples} s JOIN {alarm_rules} r USING (metric) GROUP BY ALL),
       g AS (SELECT alarm, statistic, threshold, n, unnest(generate_series(min(t), max(t), CAST(period_s AS BIGINT))) AS t
             FROM p GROUP BY alarm, statistic, threshold, n, period_s),
       f AS (SELECT g.alarm, g.t, g.n, CASE g.statistic WHEN 'Average' THEN a WHEN 'Maximum' THEN m ELSE s END AS v, g.threshold
             FROM g LEFT JOIN p ON p.alarm = g.alarm AND p.t = g.t),
       b AS (SELECT *, coalesce(v > threshold, false) AS breach FROM f)
       SELECT alarm, make_timestamp(t * 1000000) AS period_start, round(v, 6) AS value, breach,
              CASE WHEN n = 1 THEN breach ELSE breach AND coalesce(lag(breach) OVER (PARTITION BY alarm ORDER BY t), false) END AS firing
       FROM b""",
)
def _(fx):
    return rounded(monitoring.windowed_alarms(fx("metric_samples"), fx("alarm_rules")), 6, "value")


@query(
    "metric_rates",
    """WITH s AS (SELECT event_type, ts, value, lag(value) OVER w AS p FROM {counter_samples}
                  WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
            i AS (SELECT event_type, ts, CASE WHEN p IS NULL THEN 0 WHEN value >= p THEN value - p ELSE value END AS inc FROM s)
       SELECT event_type, ts, round(sum(inc) OVER (PARTITION BY event_type ORDER BY ts
              RANGE BETWEEN INTERVAL 299 SECONDS PRECEDING AND CURRENT ROW) / 300, 6) AS rate FROM i""",
)
def _(fx):
    return rounded(monitoring.counter_rate(fx("counter_samples"), "event_type"), 6, "rate")


BOUNDS = [100.0, 250.0, 500.0, 750.0]


@query(
    "metric_quantiles",
    f"""WITH b AS (SELECT {FIVE_MIN} AS window_start, le, count(*) FILTER (WHERE latency_ms <= le) AS c, count(*) AS total
                   FROM {{arrivals}}, (VALUES (100.0::DOUBLE), (250.0), (500.0), (750.0), ('inf'::DOUBLE)) v(le) GROUP BY 1, 2),
             l AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(c) OVER w, 0) AS below, total * 0.95 AS r FROM b
                   WINDOW w AS (PARTITION BY window_start ORDER BY le))
        SELECT window_start, round(CASE WHEN le = 'inf' THEN low ELSE low + (le - low) * (r - below) / (c - below) END, 6) AS quantile
        FROM l WHERE c >= r AND below < r""",
)
def _(fx):
    buckets = monitoring.latency_buckets(fx("arrivals"), BOUNDS)
    return rounded(monitoring.histogram_quantile(buckets, 0.95, ["window_start"]), 6, "quantile")


@query(
    "metric_success_ratio",
    "SELECT date_trunc('hour', event_time) AS window_start, round(sum(delivered) * 100.0 / count(*), 6) AS success_pct FROM {arrivals} GROUP BY 1",
)
def _(fx):
    return rounded(monitoring.success_ratio(fx("arrivals"), "event_time", "delivered"), 6, "success_pct")


# --- request guards ---------------------------------------------------------------------


@query(
    "replay_guard",
    """WITH RECURSIVE ok AS (SELECT client_id, nonce, req_sec AS t, min(seq) AS seq FROM {api_requests} WHERE abs(skew_sec) <= 300 GROUP BY 1, 2, 3),
         chain AS (SELECT client_id, nonce, min(t) AS t FROM ok GROUP BY 1, 2
                   UNION ALL
                   SELECT c.client_id, c.nonce, min(o.t) AS t FROM chain c
                   JOIN ok o ON o.client_id = c.client_id AND o.nonce = c.nonce AND o.t > c.t + 300 GROUP BY 1, 2)
       SELECT r.seq, r.client_id, r.nonce, CASE WHEN abs(r.skew_sec) > 300 THEN 'skewed' WHEN c.t IS NOT NULL THEN 'accepted' ELSE 'replayed' END AS verdict
       FROM {api_requests} r
       LEFT JOIN ok o ON o.client_id = r.client_id AND o.nonce = r.nonce AND o.t = r.req_sec AND o.seq = r.seq
       LEFT JOIN chain c ON c.client_id = o.client_id AND c.nonce = o.nonce AND c.t = o.t""",
)
def _(fx):
    return monitoring.replay_guard(fx("api_requests")).select("seq", "client_id", "nonce", "verdict")


@query(
    "rate_limit",
    """SELECT seq, client_id, minute_bucket,
              row_number() OVER (PARTITION BY client_id, minute_bucket ORDER BY req_sec, seq) <= 30 AS accepted
       FROM {api_requests}""",
)
def _(fx):
    return monitoring.rate_limit(fx("api_requests"), rpm=30).select("seq", "client_id", "minute_bucket", "accepted")


# --- table operations -------------------------------------------------------------------


@query("bronze_replay", "SELECT event_id, min(seq) AS seq FROM {tx_deliveries} GROUP BY 1")
def _(fx):
    """Replayed twice: the second run finds every event emitted already."""
    path = bronze_files(fx, "tx_deliveries", "seq", "event_id", "event_time", "value")
    target = shared_dir(fx.spark, "replayed")
    schema = fx("tx_deliveries").schema
    start = datetime.now() - timedelta(hours=1)
    for _ in range(2):
        operations.bronze_replay(fx.spark, path, schema, start, target=target, order="seq")
    return fx.spark.read.schema(schema).json(target).select("event_id", "seq")


@query("backfill_silver", f"SELECT * FROM ({SILVER_FRAUD}) s WHERE CAST(event_time AS DATE) = DATE '2024-01-17'")
def _(fx):
    path = shared_dir(fx.spark, "bronze")
    fx("tx_events").repartitionByRange(8, "event_time").write.parquet(path)
    rows = operations.backfill_silver(
        fx.spark.read.parquet(path), silver.silver_fraud, "event_time", date(2024, 1, 17),
        timedelta(seconds=features.VELOCITY_SECONDS), features.DEVICE_ROWS - 1, "customer_id", "event_id")
    return rounded(rows, 6, "geo_distance_km", "device_entropy")


@query(
    "archive_rows",
    """SELECT event_id, fraud_score, event_time, event_time < TIMESTAMP '2024-01-15 00:00:00' AS archived,
              CASE WHEN event_time < TIMESTAMP '2024-01-12 00:00:00' THEN 'first'
                   WHEN event_time < TIMESTAMP '2024-01-15 00:00:00' THEN 'second' END AS run
       FROM {tx_scores}""",
)
def _(fx):
    """Two runs with cut-offs in one month: what each has archived, and what is left in the table."""
    path, dst = shared_dir(fx.spark, "active"), shared_dir(fx.spark, "archive")
    fx("tx_scores").withColumn("month", F.to_date(F.date_trunc("month", "event_time"))).write.partitionBy("month").parquet(path)
    for run, cutoff in (("first", "2024-01-12 00:00:00"), ("second", "2024-01-15 00:00:00")):
        operations.archive_table(fx.spark, path, "event_time", cutoff, dst, ["month"], run)
    columns = ["event_id", "fraud_score", "event_time"]
    stored = fx.spark.read.parquet(dst).select(*columns, F.lit(True).alias("archived"), F.col("run").cast("string"))
    left = fx.spark.read.parquet(path).select(*columns, F.lit(False).alias("archived"), F.lit(None).cast("string").alias("run"))
    return stored.unionByName(left)


BOUNDARIES = operations.relative_boundaries(date(2024, 1, 31), "DAILY")


@query(
    "partition_assign",
    """SELECT event_id, CAST(date_trunc('month', event_time) AS DATE) AS month,
              1 + CAST(event_time >= DATE '2024-01-01' AS INT) + CAST(event_time >= DATE '2024-01-24' AS INT)
                + CAST(event_time >= DATE '2024-01-31' AS INT) AS partition_number
       FROM {tx_scores}""",
    dates=("month",),
)
def _(fx):
    return operations.partition_assign(fx("tx_scores"), "event_time", BOUNDARIES).select(
        "event_id", "month", "partition_number"
    )


@query(
    "table_maintenance",
    "SELECT event_id, fraud_score, event_time, (SELECT count(*) FROM {tx_scores}) AS recorded_rows FROM {tx_scores}",
)
def _(fx):
    """Rewrite into sorted files, then record statistics: no row is lost or changed, and the count is right."""
    plain, dense = shared_dir(fx.spark, "plain"), shared_dir(fx.spark, "compact")
    fx("tx_scores").write.parquet(plain)
    operations.compact(fx.spark, plain, dense, ["fraud_score"])
    name = f"maintained_{uuid.uuid4().hex}"
    rows = fx.spark.read.parquet(dense)
    fx.spark.catalog.createTable(name, dense, "parquet")
    recorded = operations.table_maintenance(fx.spark, name).first()["statistics"]
    fx.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    n = int(re.search(r"(\d+) rows", recorded)[1])
    return rows.select("event_id", "fraud_score", "event_time", F.lit(n).cast("bigint").alias("recorded_rows"))


@query(
    "audit_append",
    """SELECT CAST(ts AS DATE) AS date, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp, action, resource, "user" FROM {audit_events}""",
    dates=("date",),
)
def _(fx):
    path = shared_dir(fx.spark, "audit")
    sinks.audit_append(fx("audit_events"), path)
    return readers.read_audit(fx.spark, path).select("date", "timestamp", "action", "resource", "user")


@query(
    "warehouse_refresh",
    """SELECT 'agg_fraud_metrics' AS "table", strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS n,
              count(*) FILTER (WHERE fraud_score >= 0.7) AS hits FROM {tx_scores} GROUP BY 2
       UNION ALL SELECT 'agg_risk_distribution', strftime(event_time, '%Y-%m-%d ') || risk_band, count(DISTINCT account_id), 0
         FROM {risk_scores} GROUP BY 2
       UNION ALL SELECT 'agg_churn_cohorts', strftime(date_trunc('week', event_time), '%Y-%m-%d ')
           || CASE WHEN churn_probability >= 0.7 THEN 'high_risk' WHEN churn_probability >= 0.4 THEN 'medium_risk' ELSE 'low_risk' END,
         count(DISTINCT customer_id), 0 FROM {churn_scores} GROUP BY 2""",
)
def _(fx):
    """Refresh on a part of the facts, then on all of them, some of which come late: every table must equal
    the aggregate of all rows."""
    root, facts = shared_dir(fx.spark, "warehouse"), shared_dir(fx.spark, "facts")
    jobs = [f(f"{facts}/{n}", "ingested_at") for n, f in
            (("fraud", refresh.fraud_job), ("risk", refresh.risk_job), ("churn", refresh.churn_job))]
    runs = ("2024-01-15 12:00:00", "2024-02-01 00:00:00")
    for run, stamp in enumerate(runs):
        for job, view, cut in zip(jobs, ("tx_scores", "risk_scores", "churn_scores"), ("2024-01-15", "1998-01-01", "2024-01-15")):
            rows = fx(view).withColumn("ingested_at", F.lit(stamp).cast("timestamp"))
            first = (F.col("event_time") <= F.lit(f"{cut} 10:30:00").cast("timestamp")) & (F.xxhash64("event_time") % 7 != 0)
            rows.where(first if run == 0 else ~first).write.mode("append").parquet(job.fact)
        refresh.warehouse_refresh(fx.spark, jobs, root, datetime.fromisoformat(stamp))
    read = lambda job: fx.spark.read.parquet(f"{root}/{job.contract.name}")
    fraud, risk, churn = (read(job) for job in jobs)
    row = lambda df, bucket, n, hits: df.select(
        F.lit("").alias("table"), bucket.alias("bucket"), F.col(n).alias("n"), hits.cast("bigint").alias("hits"))
    zero = F.lit(0)
    parts = [
        row(fraud, F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss"), "total_transactions", F.col("flagged_transactions")),
        row(risk, F.concat_ws(" ", F.date_format("date", "yyyy-MM-dd"), "risk_band"), "account_count", zero),
        row(churn, F.concat_ws(" ", F.date_format("week", "yyyy-MM-dd"), "risk_segment"), "customer_count", zero),
    ]
    named = [p.withColumn("table", F.lit(job.contract.name)) for p, job in zip(parts, jobs)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "backfill_churn",
    f"""SELECT seq, customer_id, transaction_decay, login_inactivity, complaint_frequency FROM (
          SELECT seq, customer_id, event_time, {DECAY} AS transaction_decay, {INACTIVITY} AS login_inactivity,
                 {COMPLAINTS} AS complaint_frequency FROM {{crm_events}} WHERE event_time < TIMESTAMP '2024-01-18 00:00:00') s
        WHERE CAST(event_time AS DATE) = DATE '2024-01-17'""",
)
def _(fx):
    """Whole-history features as they stood at the end of that day."""
    rows = operations.backfill_silver(fx("crm_events"), silver.silver_churn, "event_time", date(2024, 1, 17))
    return rounded(rows, 6, "transaction_decay", "complaint_frequency").drop("event_time")
