"""Gold aggregates. Plain hash aggregates: partial sums before the shuffle, so a bucket that holds
a large share of the rows arrives as one partial row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.stats import clean_double
from ledgerlake.session import instant

FLAG, HIGH = 0.7, 0.85
SEGMENT_HIGH, SEGMENT_MEDIUM, CONFIDENT = 0.7, 0.4, 0.8


def _stamp(df: DataFrame, batch_ts) -> DataFrame:
    if batch_ts is None:
        return df
    ts = instant(batch_ts)
    return df.withColumns({"created_at": ts, "updated_at": ts})


def gold_fraud_hourly(scores: DataFrame, flag: float = FLAG, high: float = HIGH, batch_ts=None) -> DataFrame:
    s = clean_double(F.col("fraud_score"))
    out = (
        scores.groupBy(F.date_trunc("hour", "event_time").alias("hour_bucket"))
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.count_if(s >= flag).alias("flagged_transactions"),
            F.count_if(s >= high).alias("high_risk_count"),
            F.avg(s).alias("avg_fraud_score"),
        )
        .withColumn("fraud_rate", F.try_divide("flagged_transactions", "total_transactions"))
    )
    return _stamp(out, batch_ts)


def gold_risk_daily(scores: DataFrame, batch_ts=None) -> DataFrame:
    """``total_exposure`` is the sum of scores, as the metric is defined upstream."""
    s = clean_double(F.col("score"))
    out = scores.groupBy(F.to_date("event_time").alias("date"), "risk_band").agg(
        F.count_distinct("account_id").alias("account_count"),
        F.avg(s).alias("avg_score"),
        F.sum(s).alias("total_exposure"),
    )
    return _stamp(out, batch_ts)


def churn_segment(p: Column, high: float = SEGMENT_HIGH, medium: float = SEGMENT_MEDIUM) -> Column:
    return F.when(p >= high, "high_risk").when(p >= medium, "medium_risk").otherwise("low_risk")


def _weekly(scores: DataFrame, high: float, medium: float):
    p = clean_double(F.col("churn_probability"))
    return scores.groupBy(
        F.to_date(F.date_trunc("week", "event_time")).alias("week"),
        churn_segment(p, high, medium).alias("risk_segment"),
    )


def _weekly_measures(customers: Column, conf: float) -> list[Column]:
    return [
        customers.alias("customer_count"),
        F.avg(clean_double(F.col("churn_probability"))).alias("avg_churn_probability"),
        F.count_if(clean_double(F.col("confidence")) >= conf).alias("high_confidence_count"),
    ]


def gold_churn_weekly(
    scores: DataFrame, high: float = SEGMENT_HIGH, medium: float = SEGMENT_MEDIUM, conf: float = CONFIDENT, batch_ts=None
) -> DataFrame:
    out = _weekly(scores, high, medium).agg(*_weekly_measures(F.count_distinct("customer_id"), conf))
    return _stamp(out, batch_ts)


def gold_churn_approx(scores: DataFrame, rsd: float = 0.02, batch_ts=None) -> DataFrame:
    """As the weekly cohorts, with a sketch for the distinct count (one shuffle of small rows)."""
    out = _weekly(scores, SEGMENT_HIGH, SEGMENT_MEDIUM).agg(
        *_weekly_measures(F.approx_count_distinct("customer_id", rsd), CONFIDENT)
    )
    return _stamp(out, batch_ts)


def service_name(c: str) -> Column:
    return F.replace(F.lower(F.col(c)), F.lit(" "), F.lit("_"))


def _in_period(billing: DataFrame, start, end) -> DataFrame:
    return billing.where(F.col("usage_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def billing_by_service(billing: DataFrame, start, end) -> DataFrame:
    return (
        _in_period(billing, start, end)
        .groupBy("cloud", service_name("service").alias("service"))
        .agg(F.sum("cost").alias("total_cost"))
    )


def billing_total(billing: DataFrame, start, end) -> DataFrame:
    """Costs per (cloud, service), per cloud (service null) and in total (both null).

    The grouping sets are expanded over the per-service sums, not over the billing rows.
    """
    return (
        billing_by_service(billing, start, end)
        .rollup("cloud", "service")
        .agg(F.sum("total_cost").alias("total_cost"))
    )


def load_rowcount(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))
