"""Silver features."""

from pyspark.sql import functions as F

from ledgerlake.operators import features
from ledgerlake.plans import silver
from ledgerlake.plans.catalog import query

VELOCITY = """count(*) OVER (PARTITION BY customer_id ORDER BY event_time
    RANGE BETWEEN INTERVAL '59.999999 seconds' PRECEDING AND CURRENT ROW)"""
LAGGED = """
    WITH p AS (
      SELECT *, lag(latitude) OVER w AS lat0, lag(longitude) OVER w AS lon0
      FROM {tx_events} WINDOW w AS (PARTITION BY customer_id ORDER BY event_time, event_id))"""
HALF_CHORD = """(pow(sin(radians(latitude - lat0) / 2), 2)
    + cos(radians(lat0)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon0) / 2), 2))"""
GEO = f"""round(coalesce(2 * 6371 * asin(sqrt(CASE WHEN {HALF_CHORD} > 1 THEN 1 ELSE {HALF_CHORD} END)), 0.0), 6)"""
ENTROPY = """round(entropy(coalesce(device_id, '')) OVER (PARTITION BY customer_id ORDER BY event_time, event_id
    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)"""
HISTORY = """array_to_string(list(repayment_status) OVER (PARTITION BY account_id ORDER BY snapshot_date, seq
    ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), ',')"""
VOLATILITY = """round(stddev_samp(CAST(balance AS DOUBLE)) OVER (PARTITION BY account_id ORDER BY snapshot_date
    RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW), 2)"""
DELINQUENCY = """round(avg(CASE WHEN repayment_status = 'missed' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY account_id
    ORDER BY snapshot_date, seq ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6)"""
DECAY = "round((1 - exp(-0.01 * count(*) OVER (PARTITION BY customer_id))) / (1 - exp(-0.01)), 6)"
INACTIVITY = """CAST(floor((epoch_us(max(event_time) OVER (PARTITION BY customer_id)) - epoch_us(event_time))
    / 86400000000.0) AS BIGINT)"""
COMPLAINTS = """round(avg(CASE WHEN event_type = 'complaint' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY customer_id
    ORDER BY event_time, seq ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6)"""


def rounded(df, digits: int, *cols: str):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("feat_tx_velocity", f"SELECT transaction_id, {VELOCITY} AS tx_velocity_1m FROM {{tx_events}}")
def _(fx):
    return features.feat_tx_velocity(fx("tx_events")).select("transaction_id", "tx_velocity_1m")


@query("feat_geo_distance", LAGGED + f" SELECT transaction_id, {GEO} AS geo_distance_km FROM p")
def _(fx):
    df = features.feat_geo_distance(fx("tx_events"))
    return rounded(df, 6, "geo_distance_km").select("transaction_id", "geo_distance_km")


@query("feat_device_entropy", f"SELECT transaction_id, {ENTROPY} AS device_entropy FROM {{tx_events}}")
def _(fx):
    df = features.feat_device_entropy(fx("tx_events"))
    return rounded(df, 6, "device_entropy").select("transaction_id", "device_entropy")


SILVER_FRAUD = LAGGED + f"""
    SELECT transaction_id, customer_id, event_time, {VELOCITY} AS tx_velocity_1m, {GEO} AS geo_distance_km,
           {ENTROPY} AS device_entropy
    FROM p"""


@query("silver_fraud", SILVER_FRAUD)
def _(fx):
    return rounded(silver.silver_fraud(fx("tx_events")), 6, "geo_distance_km", "device_entropy")


@query("feat_repayment_history", f"SELECT seq, {HISTORY} AS repayment_history FROM {{account_snapshots}}")
def _(fx):
    df = features.feat_repayment_history(fx("account_snapshots"))
    return df.select("seq", F.array_join("repayment_history", ",").alias("repayment_history"))


@query("feat_balance_volatility", f"SELECT seq, {VOLATILITY} AS balance_volatility FROM {{account_snapshots}}")
def _(fx):
    df = features.feat_balance_volatility(fx("account_snapshots"))
    return rounded(df, 2, "balance_volatility").select("seq", "balance_volatility")


@query("feat_delinquency", f"SELECT seq, {DELINQUENCY} AS delinquency_trends FROM {{account_snapshots}}")
def _(fx):
    df = features.feat_delinquency(fx("account_snapshots"))
    return rounded(df, 6, "delinquency_trends").select("seq", "delinquency_trends")


@query(
    "silver_credit",
    f"""SELECT seq, account_id, snapshot_date, {HISTORY} AS repayment_history, {VOLATILITY} AS balance_volatility,
               {DELINQUENCY} AS delinquency_trends
        FROM {{account_snapshots}}""",
    dates=("snapshot_date",),
)
def _(fx):
    df = silver.silver_credit(fx("account_snapshots")).withColumn("repayment_history", F.array_join("repayment_history", ","))
    return rounded(rounded(df, 2, "balance_volatility"), 6, "delinquency_trends")


@query("feat_tx_decay", f"SELECT seq, {DECAY} AS transaction_decay FROM {{crm_events}}")
def _(fx):
    return rounded(features.feat_tx_decay(fx("crm_events")), 6, "transaction_decay").select("seq", "transaction_decay")


@query("feat_login_inactivity", f"SELECT seq, {INACTIVITY} AS login_inactivity FROM {{crm_events}}")
def _(fx):
    return features.feat_login_inactivity(fx("crm_events")).select("seq", "login_inactivity")


@query("feat_complaint_freq", f"SELECT seq, {COMPLAINTS} AS complaint_frequency FROM {{crm_events}}")
def _(fx):
    return rounded(features.feat_complaint_freq(fx("crm_events")), 6, "complaint_frequency").select(
        "seq", "complaint_frequency"
    )


@query(
    "silver_churn",
    f"""SELECT seq, customer_id, event_time, {DECAY} AS transaction_decay, {INACTIVITY} AS login_inactivity,
               {COMPLAINTS} AS complaint_frequency
        FROM {{crm_events}}""",
)
def _(fx):
    return rounded(silver.silver_churn(fx("crm_events")), 6, "transaction_decay", "complaint_frequency")


@query(
    "feature_snapshot",
    f"""WITH f AS (SELECT seq, customer_id, event_time, {COMPLAINTS} AS complaint_frequency FROM {{crm_events}})
        SELECT customer_id, seq, event_time, complaint_frequency FROM f
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_time DESC, seq DESC) = 1""",
)
def _(fx):
    df = features.feat_complaint_freq(fx("crm_events"))
    latest = features.feature_snapshot(df, "customer_id", "event_time", "seq")
    return rounded(latest, 6, "complaint_frequency").select("customer_id", "seq", "event_time", "complaint_frequency")
