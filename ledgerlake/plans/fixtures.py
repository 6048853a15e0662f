"""Domain views over the test tables, shared by the Spark queries and their SQL checks.

``{name}`` refers to another view or to a test table and ``{K}`` to the JSON field ``k`` of
``events.props``, the one expression the two dialects spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import configure

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
K_SPARK = "get_json_object(props, '$.k')"
K_DUCKDB = "json_extract_string(props, '$.k')"

VIEWS = {
    "events_k": """
        SELECT event_id, ts, user_id, event_type, value, CAST({K} AS INT) AS k FROM {events}""",
    # fraud Bronze after parsing; the location is missing now and then
    "tx_events": """
        SELECT event_id, concat('tx-', event_id) AS transaction_id, concat('c', user_id) AS customer_id,
               ts AS event_time, event_type, concat('d', event_id % 4) AS device_id,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id * 37 % 180 - 90 AS DOUBLE) END AS latitude,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id * 53 % 360 - 180 AS DOUBLE) END AS longitude
        FROM {events_k}""",
    # stream payload as JSON text with unreadable rows, absent keys and JSON nulls
    "tx_raw": """
        SELECT event_id AS seq, ts AS arrival_time,
               CASE WHEN event_id % 97 = 0 THEN '{{bad' WHEN event_id % 89 = 0 THEN '[1]' ELSE
                 concat('{{"event_id":"e', event_id, '"',
                   CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN ',"event_type":null'
                        ELSE concat(',"event_type":"', event_type, '"') END,
                   ',"payload":{{"customer_id":"c', user_id, '","device_id":"d', event_id % 4, '"}}}}') END AS raw
        FROM {events_k}""",
    # at-least-once delivery: some events arrive twice
    "tx_deliveries": """
        SELECT event_id AS seq, concat('e', event_id) AS event_id, ts AS event_time, value FROM {events}
        UNION ALL
        SELECT event_id + 1000000000 AS seq, concat('e', event_id) AS event_id, ts AS event_time, value FROM {events_k}
        WHERE k >= 70""",
    "tx_scores": """
        SELECT event_id, concat('tx-', event_id) AS transaction_id, concat('c', user_id) AS customer_id,
               CAST(k AS DOUBLE) / 100 AS fraud_score, CAST(event_id * 37 % 100 AS DOUBLE) / 100 AS confidence,
               'fraud_v1' AS model_version, ts AS event_time
        FROM {events_k}""",
    # some scores missing, some above 1
    "dirty_scores": """
        SELECT event_id, transaction_id, customer_id, confidence, model_version, event_time,
               CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 41 = 0 THEN fraud_score + 1
                    ELSE fraud_score END AS fraud_score
        FROM {tx_scores}""",
    "fraud_labels": """
        SELECT concat('tx-', event_id) AS transaction_id,
               CASE WHEN k >= 70 OR event_id % 10 = 0 THEN 1 ELSE 0 END AS is_fraud
        FROM {events_k}""",
    "account_snapshots": """
        SELECT concat('a', o_custkey) AS account_id, CAST(o_orderdate AS DATE) AS snapshot_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
               CASE o_orderstatus WHEN 'P' THEN 'missed' WHEN 'O' THEN 'late' ELSE 'paid' END AS repayment_status,
               o_orderkey AS seq
        FROM {orders}""",
    "risk_scores": """
        SELECT o_orderkey AS seq, concat('a', o_custkey) AS account_id, o_orderdate AS event_time,
               CAST(o_orderkey * 17 % 100 AS DOUBLE) / 100 AS score,
               CASE WHEN o_orderkey * 17 % 100 >= 50 THEN 'high' WHEN o_orderkey * 17 % 100 >= 20 THEN 'medium'
                    ELSE 'low' END AS risk_band
        FROM {orders}""",
    # a band outside the domain and a missing score now and then
    "dirty_risk": """
        SELECT seq, account_id, event_time, CASE WHEN seq % 43 = 0 THEN 'unknown' ELSE risk_band END AS risk_band,
               CASE WHEN seq % 47 = 0 THEN NULL WHEN seq % 53 = 0 THEN score + 1 ELSE score END AS score
        FROM {risk_scores}""",
    "crm_events": """
        SELECT event_id AS seq, concat('c', user_id) AS customer_id, ts AS event_time,
               CASE WHEN event_type = 'error' THEN 'complaint' ELSE event_type END AS event_type
        FROM {events_k}""",
    # the CRM log as it arrives: text only, some ids missing, some times unreadable
    "crm_text": """
        SELECT seq, CASE WHEN seq % 61 = 0 THEN NULL ELSE customer_id END AS customer_id,
               CASE WHEN seq % 53 = 0 THEN 'soon' ELSE concat(CAST(CAST(event_time AS DATE) AS STRING), ' 12:00:00') END
                 AS event_time,
               CASE WHEN seq % 59 = 0 THEN NULL ELSE event_type END AS event_type
        FROM {crm_events}""",
    # the core-banking export as it arrives
    "account_text": """
        SELECT seq, account_id, CASE WHEN seq % 67 = 0 THEN 'n/a' ELSE CAST(snapshot_date AS STRING) END AS snapshot_date,
               CASE WHEN seq % 71 = 0 THEN 'n/a' WHEN seq % 73 = 0 THEN NULL ELSE CAST(balance AS STRING) END AS balance,
               repayment_status
        FROM {account_snapshots}""",
    "churn_scores": """
        SELECT event_id AS seq, concat('c', user_id) AS customer_id, ts AS event_time,
               CAST(k AS DOUBLE) / 100 AS churn_probability, CAST(event_id * 37 % 100 AS DOUBLE) / 100 AS confidence
        FROM {events_k}""",
    # first load: customers with an order before 1998; the others are new in the second load
    "customer_src_v1": """
        SELECT concat('c', c_custkey) AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment,
               CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_profile
        FROM {customer}
        WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_orderdate < DATE '1998-01-01')""",
    # second load: new ids, changed segments, and names that change alone
    "customer_src_v2": """
        SELECT concat('c', c_custkey) AS customer_id,
               CASE WHEN c_custkey % 11 = 0 THEN concat(c_name, '*') ELSE c_name END AS customer_name,
               CASE WHEN c_custkey % 7 = 0 THEN 'PRIVATE' ELSE c_mktsegment END AS customer_segment,
               CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_profile
        FROM {customer}""",
    "account_src_v1": """
        SELECT concat('a', c_custkey) AS account_id, concat('c', c_custkey) AS customer_id, 'checking' AS account_type,
               CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE 'active' END AS account_status, c_acctbal AS balance
        FROM {customer}""",
    # balance moves above and below the tolerance, missing balances, changed status
    "account_src_v2": """
        SELECT account_id, customer_id, account_type,
               CASE WHEN n % 23 = 0 THEN 'closed' ELSE account_status END AS account_status,
               CASE WHEN n % 19 = 0 THEN NULL WHEN n % 13 = 0 THEN balance + 10 WHEN n % 17 = 0 THEN balance + 0.005
                    ELSE balance END AS balance
        FROM (SELECT *, CAST(substr(account_id, 2) AS BIGINT) AS n FROM {account_src_v1}) t""",
    # requests with clock skew, and nonces used three times at 0, 130 and 260 seconds after event_id * 60
    "api_requests": """
        SELECT event_id AS seq, concat('cl', (event_id - event_id % 3) % 5) AS client_id,
               concat('n', event_id - event_id % 3) AS nonce,
               event_id * 60 + event_id % 3 * 130 AS req_sec, event_id % 40 AS minute_bucket, event_id % 700 AS skew_sec
        FROM {events_k}""",
    "feature_rows": """
        SELECT event_id AS seq,
               CASE WHEN event_id % 31 = 0 THEN '--' WHEN event_id % 37 = 0 THEN 'a b'
                    ELSE concat('tx-', event_id) END AS transaction_id,
               CAST(k * 12 AS DOUBLE) AS tx_velocity_1m, CAST(event_id * 7 % 21000 AS DOUBLE) AS geo_distance_km,
               CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(k AS DOUBLE) / 9 END AS device_entropy
        FROM {events_k}""",
    "arrivals": """
        SELECT event_id AS seq, ts AS event_time, event_id * 31 % 900 AS latency_ms,
               CASE WHEN event_id % 97 = 0 THEN 0 ELSE 1 END AS delivered
        FROM {events_k}""",
    "billing": """
        SELECT CASE l_suppkey % 3 WHEN 0 THEN 'aws' WHEN 1 THEN 'gcp' ELSE 'azure' END AS cloud,
               concat('Svc ', l_partkey % 5) AS service, CAST(l_shipdate AS DATE) AS usage_date, l_extendedprice AS cost
        FROM {lineitem}""",
    "audit_events": """
        SELECT event_id AS seq, ts,
               CASE WHEN k < 20 THEN 'model_deploy' WHEN k < 60 THEN 'fraud_score_request' ELSE 'invalid_input' END AS action,
               concat('res', event_id % 3) AS resource, concat('u', user_id) AS "user"
        FROM {events_k}""",
    # operational samples: one metric per kind of event
    "metric_samples": """
        SELECT event_id AS seq, ts,
               CASE event_type WHEN 'view' THEN 'CPUUtilization' WHEN 'click' THEN 'MemoryUtilization'
                    WHEN 'error' THEN 'HTTPCode_Target_5XX_Count' WHEN 'purchase' THEN 'IteratorAgeMilliseconds'
                    WHEN 'signup' THEN 'Throttles' ELSE 'Errors' END AS metric,
               CAST(CASE event_type WHEN 'purchase' THEN k * 1000 WHEN 'error' THEN k % 7 ELSE k END AS DOUBLE) AS value
        FROM {events_k}""",
    # scrapes of a counter per kind of event, restarting every day
    "counter_samples": """
        SELECT event_type, minute_ts AS ts,
               CAST(sum(n) OVER (PARTITION BY event_type, CAST(minute_ts AS DATE) ORDER BY minute_ts) AS BIGINT) AS value
        FROM (SELECT event_type, date_trunc('minute', ts) AS minute_ts, count(*) AS n FROM {events} GROUP BY 1, 2) t""",
    # The published objectives, table freshness in minutes.
    "slo_targets": """
        SELECT * FROM (VALUES
          ('streaming_ingestion','event_latency_p99',CAST(500 AS DOUBLE)),
          ('streaming_ingestion','delivery_success_rate',CAST(99.9 AS DOUBLE)),
          ('streaming_ingestion','dlq_count',CAST(100 AS DOUBLE)),
          ('bronze','data_freshness',CAST(15 AS DOUBLE)),
          ('bronze','schema_drift_count',CAST(0 AS DOUBLE)),
          ('silver','transformation_success_rate',CAST(99.5 AS DOUBLE)),
          ('silver','feature_validity_rate',CAST(99 AS DOUBLE)),
          ('ml','inference_latency_p99',CAST(100 AS DOUBLE)),
          ('ml','model_accuracy',CAST(90 AS DOUBLE)),
          ('ml','drift_score',CAST(0.05 AS DOUBLE)),
          ('warehouse','etl_success_rate',CAST(99.9 AS DOUBLE)),
          ('warehouse','table_freshness',CAST(60 AS DOUBLE)),
          ('cost','daily_spend',CAST(5000 AS DOUBLE)),
          ('cost','cost_per_prediction',CAST(0.001 AS DOUBLE))) AS t(layer, metric, slo)""",
    # The published alarms.
    "alarm_rules": """
        SELECT * FROM (VALUES
          ('api-high-cpu','CPUUtilization','Average',300,CAST(80 AS DOUBLE),2),
          ('api-high-memory','MemoryUtilization','Average',300,CAST(85 AS DOUBLE),2),
          ('api-5xx-errors','HTTPCode_Target_5XX_Count','Sum',60,CAST(10 AS DOUBLE),1),
          ('processor-errors','Errors','Sum',300,CAST(5 AS DOUBLE),1),
          ('processor-throttles','Throttles','Sum',300,CAST(1 AS DOUBLE),1),
          ('stream-iterator-age','IteratorAgeMilliseconds','Maximum',300,CAST(60000 AS DOUBLE),2))
          AS t(alarm, metric, statistic, period_s, threshold, n)""",
    "credit_labels": """
        SELECT concat('a', c_custkey) AS account_id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_default
        FROM {customer}""",
    "churn_labels": """
        SELECT concat('c', user_id) AS customer_id,
               CASE WHEN max(ts) < TIMESTAMP '2024-01-30 00:00:00' THEN 1 ELSE 0 END AS churned
        FROM {events} GROUP BY user_id""",
    # two tables have been processed up to some point, credit_risk never
    "cdc_control": """
        SELECT 'fraud_scores' AS table_name, max(event_time) AS last_processed_timestamp,
               count(*) AS rows_processed, max(event_time) AS updated_at
        FROM {tx_scores} WHERE event_time < TIMESTAMP '2024-01-15 00:00:00'
        UNION ALL
        SELECT 'churn_scores', max(event_time), count(*), max(event_time)
        FROM {churn_scores} WHERE event_time < TIMESTAMP '2024-01-20 12:00:00'""",
    # reference and current period; the current values are shifted
    "drift_reference": "SELECT value, k FROM {events_k} WHERE ts < TIMESTAMP '2024-01-16 00:00:00'",
    "drift_current": """
        SELECT value + CASE WHEN event_id % 2 = 0 THEN 5 ELSE 0 END AS value, k
        FROM {events_k} WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""",
    "texts": """
        SELECT concat('doc-', doc_id) AS id, text FROM {documents}
        UNION ALL SELECT concat('conv-', conv_id, '-', turn) AS id, text FROM {conversations}""",
}


def references(sql: str) -> list[str]:
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql.replace("{K}", ""))


class Fixtures:
    """Views as DataFrames: ``fx("tx_scores")``. Timestamps arrive without a zone and become UTC instants."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in plain})

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self._table(name)
            else:
                sql = VIEWS[name].replace("{K}", K_SPARK).replace('"user"', "`user`")
                self._made[name] = self.sql(sql)
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: self(n) for n in set(references(text))})


def duckdb_sql(body: str) -> str:
    """The body with every view it needs as a common table expression."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in references(sql):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)

    def plain(sql: str) -> str:
        sql = sql.replace("{K}", K_DUCKDB)
        sql = re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", sql)
        return sql.replace("{{", "{").replace("}}", "}")

    ctes = [f"{n} AS ({plain(VIEWS[n]).strip()})" for n in ordered]
    body = plain(body).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[len("WITH RECURSIVE "):]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
