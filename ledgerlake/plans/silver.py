"""Bronze to Silver for the three use cases."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.operators.features import churn_features, credit_features, fraud_features
from ledgerlake.operators.hotkeys import HOT_ROWS
from ledgerlake.operators.privacy import decrypt_fields, encrypt_fields, pii_fields


def _unseal(df: DataFrame, dataset: str, key: bytes | None) -> DataFrame:
    return decrypt_fields(df, pii_fields("bronze", dataset), key) if key else df


def _seal(df: DataFrame, dataset: str, key: bytes | None) -> DataFrame:
    return encrypt_fields(df, pii_fields("silver", dataset), key) if key else df


def silver_fraud(tx: DataFrame, bronze_key: bytes | None = None, silver_key: bytes | None = None, *, tie: str = "event_id",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    needed = {tie, "transaction_id", "customer_id", "event_time", "device_id", "latitude", "longitude"}
    tx = _unseal(tx.select(*sorted(needed)), "fraud", bronze_key)
    out = fraud_features(tx, tie=tie, hot_rows=hot_rows).select(
        "transaction_id", "customer_id", "event_time", "tx_velocity_1m", "geo_distance_km", "device_entropy"
    )
    return _seal(out, "fraud", silver_key)


def silver_credit(snapshots: DataFrame, bronze_key: bytes | None = None, silver_key: bytes | None = None, *,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    needed = ("account_id", "snapshot_date", "seq", "balance", "repayment_status")
    snapshots = _unseal(snapshots.select(*needed), "credit_risk", bronze_key)
    out = credit_features(snapshots, hot_rows=hot_rows).select(
        "account_id", "snapshot_date", "seq", "repayment_history", "balance_volatility", "delinquency_trends"
    )
    return _seal(out, "credit_risk", silver_key)


def silver_churn(crm: DataFrame, bronze_key: bytes | None = None, silver_key: bytes | None = None, *,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    crm = _unseal(crm.select("customer_id", "event_time", "seq", "event_type"), "churn", bronze_key)
    out = churn_features(crm, hot_rows=hot_rows).select(
        "customer_id", "event_time", "seq", "transaction_decay", "login_inactivity", "complaint_frequency"
    )
    return _seal(out, "churn", silver_key)
