"""Scans, ingest, contracts and data quality."""

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from ledgerlake.contracts import (
    BRONZE_CHURN, BRONZE_CREDIT, FACT_CREDIT, FACT_FRAUD, FRAUD_LABELS, REQUEST_RANGES,
)
from ledgerlake.operators import ingest, quality
from ledgerlake.plans.catalog import query
from ledgerlake.session import shared_dir
from ledgerlake.sources import readers, sinks

FAILED_AT = "2024-02-01 00:00:00"


def raw_stream(fx):
    """tx_raw as the stream delivers it: base64 payload, sequence number, arrival time."""
    return fx("tx_raw").select(
        "seq",
        F.base64(F.encode("raw", "UTF-8")).alias("data"),
        F.col("seq").cast("string").alias("sequence"),
        F.unix_seconds("arrival_time").cast("double").alias("arrival"),
    )


def bronze_files(fx, view: str, *columns: str) -> str:
    path = shared_dir(fx.spark, "bronze")
    sinks.write_bronze(fx(view).select(*columns), path)
    return path


@query("scan_parquet", "SELECT event_id, user_id, event_type, value FROM {events}")
def _(fx):
    wanted = ["event_id", "user_id", "event_type", "value"]
    return readers.read_table(fx.spark, f"{fx.dir}/events.parquet", wanted).select(*wanted)


@query("scan_jsonl", "SELECT seq, customer_id, event_time, event_type FROM {crm_events}")
def _(fx):
    path = bronze_files(fx, "crm_events", "seq", "customer_id", "event_time", "event_type")
    schema = fx("crm_events").schema
    return readers.read_bronze(fx.spark, path, schema).select("seq", "customer_id", "event_time", "event_type")


@query("scan_csv_labels", "SELECT transaction_id, is_fraud FROM {fraud_labels}")
def _(fx):
    path = shared_dir(fx.spark, "labels")
    fx("fraud_labels").write.option("header", True).csv(path)
    return readers.read_labels(fx.spark, path, FRAUD_LABELS)


@query("scan_by_mtime", "SELECT seq, customer_id, event_type FROM {crm_events} WHERE seq % 3 = 0")
def _(fx):
    """Only the middle one of three batches of files is from the time asked for."""
    path, times = shared_dir(fx.spark, "bronze"), []
    for part in (1, 0, 2):
        rows = fx("crm_events").where(F.col("seq") % 3 == part).select("seq", "customer_id", "event_time", "event_type")
        time.sleep(1.1)  # some storage keeps whole seconds
        times.append(datetime.now(timezone.utc))
        sinks.write_bronze(rows, path)
    second = timedelta(seconds=1)
    df = readers.read_modified(fx.spark, path, fx("crm_events").schema, times[1] - second / 2, times[2] - second / 20)
    return df.select("seq", "customer_id", "event_type")


@query(
    "scan_audit",
    """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp, action, resource, "user", CAST(ts AS DATE) AS date
       FROM {audit_events} WHERE CAST(ts AS DATE) >= DATE '2024-01-15'""",
    dates=("date",),
)
def _(fx):
    path = shared_dir(fx.spark, "audit")
    sinks.audit_append(fx("audit_events"), path)
    return readers.read_audit(fx.spark, path, "2024-01-15").select("timestamp", "action", "resource", "user", "date")


# --- ingest -----------------------------------------------------------------------------

PARSED = """
    WITH parsed AS (
      SELECT seq, raw, arrival_time, json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw END) = 'OBJECT' AS ok,
             CASE WHEN json_valid(raw) THEN raw END AS doc
      FROM {tx_raw})"""


@query(
    "ingest_parse",
    PARSED + """
    SELECT seq, json_extract_string(doc, '$.event_id') AS event_id,
           CASE WHEN json_exists(doc, '$.event_type') THEN json_extract_string(doc, '$.event_type')
                ELSE 'payment_authorised' END AS event_type,
           'cards' AS source_system,
           json_extract_string(doc, '$.payload.customer_id') AS customer_id,
           json_extract_string(doc, '$.payload.device_id') AS device_id,
           CAST(seq AS VARCHAR) AS kinesis_sequence
    FROM parsed WHERE ok""",
)
def _(fx):
    good, _ = ingest.split_valid(ingest.parse_events(raw_stream(fx)))
    return ingest.payload_fields(good).select(
        "seq", "event_id", "event_type", "source_system", "customer_id", "device_id", "kinesis_sequence"
    )


@query(
    "ingest_dlq",
    PARSED + """
    SELECT seq, raw AS record, CASE WHEN doc IS NULL THEN 'invalid json' ELSE 'record is not a json object' END AS error,
           TIMESTAMP '2024-02-01 00:00:00' AS failed_at
    FROM parsed WHERE NOT coalesce(ok, false)""",
)
def _(fx):
    _, dlq = ingest.split_valid(ingest.parse_events(raw_stream(fx)), F.lit(FAILED_AT).cast("timestamp"))
    return dlq.select("seq", "record", "error", "failed_at")


@query(
    "ingest_counts",
    PARSED + """
    SELECT count(*) FILTER (WHERE coalesce(ok, false)) AS processed,
           count(*) FILTER (WHERE NOT coalesce(ok, false)) AS failed, count(*) AS total
    FROM parsed""",
)
def _(fx):
    return ingest.ingest_counts(ingest.parse_events(raw_stream(fx)))


@query("ingest_dedup", "SELECT event_id, min(seq) AS seq, min(event_time) AS event_time FROM {tx_deliveries} GROUP BY 1")
def _(fx):
    return ingest.dedup_events(fx("tx_deliveries"), "event_id", "seq").select("event_id", "seq", "event_time")


@query(
    "ingest_churn_batch",
    """SELECT seq, customer_id, CAST(event_time AS TIMESTAMP) AS event_time, event_type FROM {crm_text}
       WHERE customer_id IS NOT NULL AND event_type IS NOT NULL AND try_cast(event_time AS TIMESTAMP) IS NOT NULL""",
)
def _(fx):
    good, _ = ingest.ingest_batch(fx("crm_text"), BRONZE_CHURN)
    return good.select("seq", "customer_id", "event_time", "event_type")


@query(
    "ingest_credit_batch",
    """SELECT seq, account_id, CAST(snapshot_date AS DATE) AS snapshot_date, CAST(CAST(balance AS DECIMAL(18,2)) AS DOUBLE) AS balance,
              repayment_status
       FROM {account_text}
       WHERE try_cast(snapshot_date AS DATE) IS NOT NULL AND try_cast(balance AS DECIMAL(18,2)) IS NOT NULL""",
    dates=("snapshot_date",),
)
def _(fx):
    good, _ = ingest.ingest_batch(fx("account_text"), BRONZE_CREDIT)
    return good.select("seq", "account_id", "snapshot_date", F.col("balance").cast("double").alias("balance"), "repayment_status")


# --- contracts and quality --------------------------------------------------------------


@query(
    "contract_check",
    """SELECT seq, concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id:required' END,
              CASE WHEN event_time IS NULL THEN 'event_time:required' END,
              CASE WHEN event_time IS NOT NULL AND try_cast(event_time AS TIMESTAMP) IS NULL THEN 'event_time:type' END,
              CASE WHEN event_type IS NULL THEN 'event_type:required' END) AS violations
       FROM {crm_text}""",
)
def _(fx):
    checked = quality.check_contract(fx("crm_text"), BRONZE_CHURN)
    return checked.select("seq", F.concat_ws(",", "violations").alias("violations"))


@query(
    "dq_fraud",
    """SELECT count(*) AS total_records, count(*) FILTER (WHERE fraud_score IS NULL) AS null_scores,
              count(*) FILTER (WHERE fraud_score < 0 OR fraud_score > 1) AS out_of_range,
              round(avg(CASE WHEN fraud_score IS NULL THEN 1 ELSE 0 END) * 100, 2) AS null_pct,
              count(*) FILTER (WHERE fraud_score IS NULL OR fraud_score < 0 OR fraud_score > 1) = 0 AS passed
       FROM {dirty_scores}""",
)
def _(fx):
    return quality.dq_fraud(fx("dirty_scores"))


@query(
    "dq_credit",
    """SELECT count(*) AS total_records, count(*) FILTER (WHERE risk_band NOT IN ('high','medium','low')) AS invalid_bands,
              count(*) FILTER (WHERE score IS NULL) AS null_scores,
              count(*) FILTER (WHERE risk_band NOT IN ('high','medium','low')) = 0 AS passed
       FROM {dirty_risk}""",
)
def _(fx):
    return quality.dq_credit(fx("dirty_risk"))


@query(
    "dq_churn",
    """SELECT count(*) AS total_records,
              count(*) FILTER (WHERE churn_probability < 0 OR churn_probability > 1) AS out_of_range,
              count(*) FILTER (WHERE confidence IS NULL) AS null_confidence,
              count(*) FILTER (WHERE churn_probability < 0 OR churn_probability > 1) = 0 AS passed
       FROM {churn_scores}""",
)
def _(fx):
    return quality.dq_churn(fx("churn_scores"))


FEATURE_RULES = {
    "required_columns": ["transaction_id", "tx_velocity_1m", "geo_distance_km", "device_entropy", "merchant"],
    "non_nullable": ["transaction_id", "device_entropy"],
    "ranges": {c: (float(lo), float(hi)) for c, (lo, hi) in REQUEST_RANGES.items()},
    "types": {"tx_velocity_1m": "double", "seq": "string"},
}


@query(
    "feature_validate",
    """SELECT 'required' AS "check", c AS "column", CAST(c = 'merchant' AS BIGINT) AS violations
       FROM (VALUES ('transaction_id'), ('tx_velocity_1m'), ('geo_distance_km'), ('device_entropy'), ('merchant')) t(c)
       UNION ALL SELECT 'non_null', 'transaction_id', count(*) FILTER (WHERE transaction_id IS NULL) FROM {feature_rows}
       UNION ALL SELECT 'non_null', 'device_entropy', count(*) FILTER (WHERE device_entropy IS NULL) FROM {feature_rows}
       UNION ALL SELECT 'range', 'tx_velocity_1m', count(*) FILTER (WHERE tx_velocity_1m < 0 OR tx_velocity_1m > 1000) FROM {feature_rows}
       UNION ALL SELECT 'range', 'geo_distance_km', count(*) FILTER (WHERE geo_distance_km < 0 OR geo_distance_km > 20000) FROM {feature_rows}
       UNION ALL SELECT 'range', 'device_entropy', count(*) FILTER (WHERE device_entropy < 0 OR device_entropy > 10) FROM {feature_rows}
       UNION ALL SELECT 'type', 'tx_velocity_1m', 0
       UNION ALL SELECT 'type', 'seq', 1""",
)
def _(fx):
    return quality.validate_features(fx("feature_rows"), FEATURE_RULES)


@query(
    "constraint_check",
    """SELECT 'not_null' AS "constraint", c AS "column", CASE c WHEN 'score' THEN n ELSE 0 END AS violations
       FROM (VALUES ('account_id'), ('risk_band'), ('score'), ('event_time')) t(c),
            (SELECT count(*) FILTER (WHERE score IS NULL) AS n FROM {dirty_risk}) s
       UNION ALL SELECT 'range', 'score', count(*) FILTER (WHERE score < 0 OR score > 1) FROM {dirty_risk}
       UNION ALL SELECT 'domain', 'risk_band', count(*) FILTER (WHERE risk_band NOT IN ('high','medium','low')) FROM {dirty_risk}
       UNION ALL SELECT 'max_length', 'account_id', count(*) FILTER (WHERE length(account_id) > 100) FROM {dirty_risk}
       UNION ALL SELECT 'primary_key', 'account_id+event_time', count(*) - count(DISTINCT (account_id, event_time)) FROM {dirty_risk}""",
)
def _(fx):
    return quality.check_constraints(fx("dirty_risk"), FACT_CREDIT)


@query(
    "constraint_check_fraud",
    """SELECT 'not_null' AS "constraint", c AS "column", CASE c WHEN 'fraud_score' THEN n ELSE 0 END AS violations
       FROM (VALUES ('transaction_id'), ('customer_id'), ('fraud_score'), ('confidence'), ('model_version'), ('event_time')) t(c),
            (SELECT count(*) FILTER (WHERE fraud_score IS NULL) AS n FROM {dirty_scores}) s
       UNION ALL SELECT 'range', 'fraud_score', count(*) FILTER (WHERE fraud_score < 0 OR fraud_score > 1) FROM {dirty_scores}
       UNION ALL SELECT 'range', 'confidence', count(*) FILTER (WHERE confidence < 0 OR confidence > 1) FROM {dirty_scores}
       UNION ALL SELECT 'max_length', 'transaction_id', count(*) FILTER (WHERE length(transaction_id) > 100) FROM {dirty_scores}
       UNION ALL SELECT 'max_length', 'customer_id', count(*) FILTER (WHERE length(customer_id) > 100) FROM {dirty_scores}
       UNION ALL SELECT 'max_length', 'model_version', count(*) FILTER (WHERE length(model_version) > 50) FROM {dirty_scores}
       UNION ALL SELECT 'primary_key', 'transaction_id', count(*) - count(DISTINCT transaction_id) FROM {dirty_scores}""",
)
def _(fx):
    return quality.check_constraints(fx("dirty_scores"), FACT_FRAUD)


@query(
    "request_validate",
    """SELECT seq, concat_ws(',',
              CASE WHEN length(transaction_id) < 1 OR length(transaction_id) > 100 THEN 'id_length' END,
              CASE WHEN NOT regexp_full_match(transaction_id, '[A-Za-z0-9_-]*[A-Za-z0-9][A-Za-z0-9_-]*') THEN 'id_format' END,
              CASE WHEN tx_velocity_1m < 0 OR tx_velocity_1m > 1000 THEN 'tx_velocity_1m' END,
              CASE WHEN geo_distance_km < 0 OR geo_distance_km > 20000 THEN 'geo_distance_km' END,
              CASE WHEN device_entropy IS NULL OR device_entropy < 0 OR device_entropy > 10 THEN 'device_entropy' END) AS errors,
              regexp_full_match(transaction_id, '[A-Za-z0-9_-]*[A-Za-z0-9][A-Za-z0-9_-]*')
                AND tx_velocity_1m BETWEEN 0 AND 1000 AND geo_distance_km BETWEEN 0 AND 20000
                AND coalesce(device_entropy BETWEEN 0 AND 10, false) AS valid
       FROM {feature_rows}""",
)
def _(fx):
    checked = quality.validate_requests(fx("feature_rows"))
    return checked.select("seq", F.concat_ws(",", "errors").alias("errors"), "valid")


