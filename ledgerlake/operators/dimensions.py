"""Type-2 dimensions, surrogate keys and the calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.incremental import top1_per_key, union_all
from ledgerlake.session import instant, stored

HISTORY = ("valid_from", "valid_to", "is_current")
STAMPS = ("created_at", "updated_at")


def scd2_initial(src: DataFrame, ts, source: str, surrogate: str | None = None, key: str | None = None) -> DataFrame:
    """The first load of a dimension; with ``surrogate`` every row gets a dense key in order of ``key``."""
    out = src.select(
        "*",
        instant(ts).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(source).alias("data_source"),
        *[instant(ts).alias(c) for c in STAMPS],
    )
    return out if surrogate is None else assign_keys(out, [key], name=surrogate)


def changed_any(tracked: list[str]) -> Column:
    """Null-safe difference of any tracked column between ``d`` (dimension) and ``s`` (source)."""
    return reduce(lambda a, b: a | b, [~F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in tracked])


def account_changed(tolerance: float = 0.01) -> Column:
    """Status differs, or the balances are more than ``tolerance`` apart (null counts as 0)."""
    moved = F.abs(
        F.coalesce(F.col("d.balance").cast("double"), F.lit(0.0))
        - F.coalesce(F.col("s.balance").cast("double"), F.lit(0.0))
    )
    return ~F.col("d.account_status").eqNullSafe(F.col("s.account_status")) | (moved > tolerance)


def scd2_apply(
    dim: DataFrame,
    src: DataFrame,
    key: str,
    ts,
    source: str,
    tracked: list[str] | None = None,
    changed: Column | None = None,
    order: str | None = None,
    surrogate: str | None = None,
) -> DataFrame:
    """The dimension after one source load at ``ts``.

    With ``surrogate``, versions keep their surrogate keys, and new versions get the keys after the largest so far.

    New ids are inserted; where ``changed`` holds, the current row is closed and a new one is
    opened; everything else is kept. Ids missing from the source stay open. Only current rows are
    compared, and the history passes by without a shuffle. With ``order``, the last row per id of
    the source counts.
    """
    changed = changed if changed is not None else changed_any(tracked or [])
    now = instant(ts)
    attributes = [c for c in dim.columns if c not in (*HISTORY, *STAMPS, "data_source", surrogate)]
    named = [surrogate] if surrogate else []
    if order is not None:
        src = top1_per_key(src, [key], [F.desc(order)])
    else:
        repeated = src.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
        if repeated:
            raise ValueError(f"{key} {repeated[0][0]!r} comes {repeated[0][1]} times; name an order to take the last")
    current = dim.where("is_current")
    pairs = current.alias("d").join(src.alias("s"), F.col(f"d.{key}") == F.col(f"s.{key}"), "full_outer")
    is_new = F.col(f"d.{key}").isNull()
    is_changed = ~is_new & F.col(f"s.{key}").isNotNull() & changed

    old = F.struct(
        *[F.col(f"d.{c}").alias(c) for c in attributes],
        F.col("d.valid_from").alias("valid_from"),
        F.when(is_changed, now).otherwise(F.col("d.valid_to")).alias("valid_to"),
        (~is_changed).alias("is_current"),
        F.col("d.data_source").alias("data_source"),
        F.col("d.created_at").alias("created_at"),
        F.when(is_changed, now).otherwise(F.col("d.updated_at")).alias("updated_at"),
        *[F.col(f"d.{c}").alias(c) for c in named],
    )
    opened = F.struct(
        *[F.col(f"s.{c}").cast(dim.schema[c].dataType).alias(c) for c in attributes],
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(source).alias("data_source"),
        *[now.alias(c) for c in STAMPS],
        *[F.lit(None).cast("bigint").alias(c) for c in named],
    )
    versions = F.when(is_new, F.array(opened)).when(is_changed, F.array(old, opened)).otherwise(F.array(old))
    out = pairs.select(F.explode(versions).alias("v")).select("v.*")
    whole = union_all(dim.where("NOT coalesce(is_current, false)").select(*out.columns), out)
    if surrogate is None:
        return whole
    # Stored, so that the largest key, the old versions and the new ones come from one run of the plan.
    whole = stored(whole, "dimension")
    start = whole.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    fresh = whole.where(F.col(surrogate).isNull()).drop(surrogate)
    return union_all(whole.where(F.col(surrogate).isNotNull()), assign_keys(fresh, [key], start, surrogate))


def as_of(fact: DataFrame, dim: DataFrame, key: str, ts: str) -> DataFrame:
    """Fact rows with the dimension version valid at their time (inner).

    The key equality keeps it a hash or merge join; adaptive execution splits a hot fact key.
    """
    d = dim.select(*[F.col(c).alias(f"dim_{c}") for c in dim.columns])
    valid = (F.col(ts) >= F.col("dim_valid_from")) & (
        F.col("dim_valid_to").isNull() | (F.col(ts) < F.col("dim_valid_to"))
    )
    return fact.join(d, (F.col(key) == F.col(f"dim_{key}")) & valid)


ROWS_PER_BUCKET = 1_000_000


def assign_keys(df: DataFrame, order: list[str], start: int = 0, name: str = "surrogate_key") -> DataFrame:
    """Dense keys ``start + 1 ..`` without a global sort.

    Rows are spread over hash buckets of the (unique) order columns, a million rows each however many
    there are; the running sum of the bucket sizes gives each bucket its offset.
    """
    buckets = 1 + df.count() // ROWS_PER_BUCKET
    bucketed = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    # One row per million keys.
    earlier = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy("__b").count().select(
        "__b", (F.coalesce(F.sum("count").over(earlier), F.lit(0)) + start).alias("__offset"))
    position = F.row_number().over(Window.partitionBy("__b").orderBy(*order))
    keyed = bucketed.withColumn("__n", position).join(offsets, "__b")
    return keyed.select(*df.columns, (F.col("__offset") + F.col("__n")).alias(name))


def dim_date(spark, first_year: int = 2020, last_year: int = 2030) -> DataFrame:
    """One row per day. Fiscal years start in July."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
        ).alias("date")
    )
    return calendar_columns(days)


def calendar_columns(days: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    month, year, weekday = F.month(d), F.year(d), F.weekday(d)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("date"),
        year.alias("year"),
        F.quarter(d).alias("quarter"),
        month.alias("month"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 5).cast("int").alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        F.when(month >= 7, year).otherwise(year - 1).alias("fiscal_year"),
        (F.floor(F.pmod(month - 7, F.lit(12)) / 3) + 1).cast("int").alias("fiscal_quarter"),
    )
