"""Declared contracts: columns, types and rules of every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
_S, _D, _TS, _L, _B, _DATE = (
    T.StringType(), T.DoubleType(), T.TimestampType(), T.LongType(), T.BooleanType(), T.DateType(),
)


@dataclass(frozen=True)
class Contract:
    """A table's columns, in order, and the rules its rows must keep."""

    name: str
    types: dict[str, T.DataType]
    required: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.types.items()])


# Column names, types, domains, ranges and lengths of the published contracts.

BRONZE_FRAUD = Contract(
    "bronze_fraud",
    {"event_id": _S, "event_type": _S, "event_time": _TS, "source_system": _S, "payload": _S,
     "kinesis_sequence": _S, "kinesis_timestamp": _D},
    required=("event_id", "event_type", "event_time", "source_system"),
    defaults={"event_type": "payment_authorised", "source_system": "cards", "payload": "{}"},
)
BRONZE_CREDIT = Contract(
    "bronze_credit",
    {"account_id": _S, "snapshot_date": _DATE, "balance": MONEY, "repayment_status": _S},
    required=("account_id", "snapshot_date", "balance", "repayment_status"),
)
BRONZE_CHURN = Contract(
    "bronze_churn",
    {"customer_id": _S, "event_time": _TS, "event_type": _S, "details": _S},
    required=("customer_id", "event_time", "event_type"),
)
SILVER_FRAUD = Contract(
    "silver_fraud",
    {"transaction_id": _S, "customer_id": _S, "event_time": _TS, "tx_velocity_1m": _L,
     "geo_distance_km": _D, "device_entropy": _D},
    required=("transaction_id", "customer_id", "event_time"),
)
SILVER_CREDIT = Contract(
    "silver_credit",
    {"account_id": _S, "repayment_history": T.ArrayType(_S), "balance_volatility": _D, "delinquency_trends": _D},
    required=("account_id",),
)
SILVER_CHURN = Contract(
    "silver_churn",
    {"customer_id": _S, "transaction_decay": _D, "login_inactivity": _L, "complaint_frequency": _D},
    required=("customer_id",),
)
FACT_FRAUD = Contract(
    "fact_fraud_scores",
    {"transaction_id": _S, "customer_id": _S, "fraud_score": _D, "confidence": _D, "model_version": _S,
     "event_time": _TS, "created_at": _TS, "data_source": _S},
    required=("transaction_id", "customer_id", "fraud_score", "confidence", "model_version", "event_time"),
    primary_key=("transaction_id",),
    ranges={"fraud_score": (0.0, 1.0), "confidence": (0.0, 1.0)},
    max_length={"transaction_id": 100, "customer_id": 100, "model_version": 50, "data_source": 100},
    defaults={"data_source": "fraud_ml_model"},
)
FACT_CREDIT = Contract(
    "fact_credit_risk",
    {"account_id": _S, "risk_band": _S, "score": _D, "model_version": _S, "event_time": _TS,
     "created_at": _TS, "data_source": _S},
    required=("account_id", "risk_band", "score", "event_time"),
    primary_key=("account_id", "event_time"),
    ranges={"score": (0.0, 1.0)},
    domains={"risk_band": ("high", "medium", "low")},
    max_length={"account_id": 100},
    defaults={"data_source": "credit_risk_model"},
)
FACT_CHURN = Contract(
    "fact_churn",
    {"customer_id": _S, "churn_probability": _D, "confidence": _D, "model_version": _S, "event_time": _TS,
     "created_at": _TS, "data_source": _S},
    required=("customer_id", "churn_probability", "confidence", "event_time"),
    primary_key=("customer_id", "event_time"),
    ranges={"churn_probability": (0.0, 1.0), "confidence": (0.0, 1.0)},
    max_length={"customer_id": 100},
    defaults={"data_source": "churn_model"},
)
AGG_FRAUD = Contract(
    "agg_fraud_metrics",
    {"hour_bucket": _TS, "fraud_rate": _D, "total_transactions": _L, "flagged_transactions": _L,
     "avg_fraud_score": _D, "high_risk_count": _L, "created_at": _TS, "updated_at": _TS},
    required=("hour_bucket",), primary_key=("hour_bucket",),
)
AGG_RISK = Contract(
    "agg_risk_distribution",
    {"date": _DATE, "risk_band": _S, "account_count": _L, "avg_score": _D, "total_exposure": _D,
     "created_at": _TS, "updated_at": _TS},
    required=("date", "risk_band"), primary_key=("date", "risk_band"),
    domains={"risk_band": ("high", "medium", "low")},
)
AGG_CHURN = Contract(
    "agg_churn_cohorts",
    {"week": _DATE, "risk_segment": _S, "customer_count": _L, "avg_churn_probability": _D,
     "high_confidence_count": _L, "created_at": _TS, "updated_at": _TS},
    required=("week", "risk_segment"), primary_key=("week", "risk_segment"),
    domains={"risk_segment": ("high_risk", "medium_risk", "low_risk")},
)
CDC_CONTROL = T.StructType([
    T.StructField("table_name", _S), T.StructField("last_processed_timestamp", _TS),
    T.StructField("rows_processed", _L), T.StructField("updated_at", _TS),
])
DIM_CUSTOMER_COLUMNS = ("customer_id", "customer_name", "customer_segment", "risk_profile")
DIM_ACCOUNT_COLUMNS = ("account_id", "customer_id", "account_type", "account_status", "balance")
FRAUD_LABELS = T.StructType([T.StructField("transaction_id", _S), T.StructField("is_fraud", T.IntegerType())])
AUDIT = T.StructType([
    T.StructField("timestamp", _S), T.StructField("action", _S), T.StructField("resource", _S),
    T.StructField("user", _S), T.StructField("metadata", T.MapType(_S, _S)),
])

# Fraud request limits: identifier length and the inclusive ranges of the three features.
REQUEST_ID_MAX = 100
REQUEST_RANGES = {"tx_velocity_1m": (0, 1000), "geo_distance_km": (0, 20000), "device_entropy": (0, 10)}
