"""Type-2 dimensions, keys and the calendar."""

from pyspark.sql import functions as F

from ledgerlake.contracts import DIM_ACCOUNT_COLUMNS, DIM_CUSTOMER_COLUMNS
from ledgerlake.operators import dimensions as dims
from ledgerlake.plans.catalog import query

V1, V2 = "2023-01-01 00:00:00", "2024-01-15 00:00:00"


def scd2_sql(old: str, new: str, key: str, columns: tuple[str, ...], changed: str, source: str, surrogate: str) -> str:
    cols = ", ".join(columns)
    plain = lambda a: ", ".join(f"{a}.{c}" for c in columns)
    return f"""
        WITH d AS (SELECT {cols} FROM {{{old}}}), s AS (SELECT {cols} FROM {{{new}}}),
        m AS (SELECT d.{key} AS id, {changed} AS changed FROM d JOIN s ON d.{key} = s.{key})
        SELECT {plain('d')}, TIMESTAMP '{V1}' AS valid_from,
               CASE WHEN m.changed THEN TIMESTAMP '{V2}' END AS valid_to, NOT coalesce(m.changed, false) AS is_current,
               '{source}' AS data_source, TIMESTAMP '{V1}' AS created_at,
               CASE WHEN m.changed THEN TIMESTAMP '{V2}' ELSE TIMESTAMP '{V1}' END AS updated_at,
               row_number() OVER (ORDER BY d.{key}) AS {surrogate}
        FROM d LEFT JOIN m ON m.id = d.{key}
        UNION ALL
        SELECT {plain('s')}, TIMESTAMP '{V2}', NULL, true, '{source}', TIMESTAMP '{V2}', TIMESTAMP '{V2}',
               (SELECT count(*) FROM d) + row_number() OVER (ORDER BY s.{key})
        FROM s LEFT JOIN m ON m.id = s.{key} WHERE m.id IS NULL OR m.changed"""


CUSTOMER_CHANGED = "d.customer_segment IS DISTINCT FROM s.customer_segment OR d.risk_profile IS DISTINCT FROM s.risk_profile"
ACCOUNT_CHANGED = """d.account_status IS DISTINCT FROM s.account_status
    OR abs(coalesce(d.balance, 0) - coalesce(s.balance, 0)) > 0.01"""
CUSTOMER_SQL = scd2_sql("customer_src_v1", "customer_src_v2", "customer_id", DIM_CUSTOMER_COLUMNS, CUSTOMER_CHANGED, "crm_system",
                        "customer_key")


def dim_customer(fx):
    dim = dims.scd2_initial(fx("customer_src_v1"), V1, "crm_system", "customer_key", "customer_id")
    return dims.scd2_apply(
        dim, fx("customer_src_v2"), "customer_id", V2, "crm_system", tracked=["customer_segment", "risk_profile"],
        surrogate="customer_key",
    )


@query("scd2_customer", CUSTOMER_SQL)
def _(fx):
    return dim_customer(fx)


@query(
    "scd2_account",
    scd2_sql("account_src_v1", "account_src_v2", "account_id", DIM_ACCOUNT_COLUMNS, ACCOUNT_CHANGED, "core_banking", "account_key"),
)
def _(fx):
    dim = dims.scd2_initial(fx("account_src_v1"), V1, "core_banking", "account_key", "account_id")
    return dims.scd2_apply(dim, fx("account_src_v2"), "account_id", V2, "core_banking", changed=dims.account_changed(),
                           surrogate="account_key")


@query(
    "scd2_as_of",
    "WITH dim AS (" + CUSTOMER_SQL + """)
    SELECT f.transaction_id, f.customer_id, f.event_time, dim.customer_key, dim.customer_segment, dim.risk_profile, dim.valid_from
    FROM {tx_scores} f JOIN dim ON f.customer_id = dim.customer_id
      AND f.event_time >= dim.valid_from AND (dim.valid_to IS NULL OR f.event_time < dim.valid_to)""",
)
def _(fx):
    return dims.as_of(fx("tx_scores"), dim_customer(fx), "customer_id", "event_time").select(
        "transaction_id",
        "customer_id",
        "event_time",
        F.col("dim_customer_key").alias("customer_key"),
        F.col("dim_customer_segment").alias("customer_segment"),
        F.col("dim_risk_profile").alias("risk_profile"),
        F.col("dim_valid_from").alias("valid_from"),
    )


@query(
    "surrogate_keys",
    """SELECT count(*) AS rows, CAST(101 AS BIGINT) AS first_key, 100 + count(*) AS last_key, count(*) AS distinct_keys
       FROM {customer_src_v2}""",
)
def _(fx):
    keyed = dims.assign_keys(fx("customer_src_v2"), ["customer_id"], start=100)
    k = F.col("surrogate_key")
    return keyed.agg(
        F.count(F.lit(1)).alias("rows"), F.min(k).alias("first_key"), F.max(k).alias("last_key"),
        F.count_distinct(k).alias("distinct_keys"),
    )


@query(
    "dim_date",
    """WITH d AS (
         SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(o_orderdate)) AS TIMESTAMP),
                CAST(max(o_orderdate) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM {orders}),
       n AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM {orders} GROUP BY 1)
       SELECT CAST(strftime(d.date, '%Y%m%d') AS INT) AS date_key, d.date, CAST(year(d.date) AS INT) AS year, CAST(quarter(d.date) AS INT) AS quarter,
              CAST(month(d.date) AS INT) AS month, CAST(weekofyear(d.date) AS INT) AS week, CAST(day(d.date) AS INT) AS day_of_month,
              CAST(isodow(d.date) - 1 AS INT) AS day_of_week, dayname(d.date) AS day_name,
              CASE WHEN isodow(d.date) >= 6 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
              CAST(CASE WHEN month(d.date) >= 7 THEN year(d.date) ELSE year(d.date) - 1 END AS INT) AS fiscal_year,
              CAST(((month(d.date) + 5) % 12) // 3 + 1 AS INT) AS fiscal_quarter, coalesce(n.orders, 0) AS orders
       FROM d LEFT JOIN n ON n.date = d.date""",
    dates=("date",),
)
def _(fx):
    """The calendar over the years of the orders, with the orders of each day."""
    orders = fx("orders")
    span = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    days = span.select(F.explode(F.sequence(F.trunc("lo", "year"), F.to_date("hi"))).alias("date"))
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    return dims.calendar_columns(days).join(per_day, "date", "left").fillna(0, ["orders"])
