"""Joins, splits and projections between layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import Contract
from ledgerlake.session import instant


class NotOneToOne(ValueError):
    """A side of a one-to-one join repeats a key."""


def _repeats(df: DataFrame, key: str) -> bool:
    return not df.groupBy(key).count().where(F.col("count") > 1).isEmpty()


def join_labels(features: DataFrame, labels: DataFrame, key: str, validate: bool = True) -> DataFrame:
    """Inner join that refuses repeated keys on either side."""
    if validate:
        for side, df in (("features", features), ("labels", labels)):
            if _repeats(df, key):
                raise NotOneToOne(f"{key} is not unique in {side}")
    return features.join(labels, key)


def rows_after_watermark(fact: DataFrame, control: DataFrame, table: str, ts: str = "event_time") -> DataFrame:
    """Fact rows after the table's watermark, in one lazy plan: the watermark is a scalar subquery,
    evaluated once and compared as a value."""
    wm = control.where(F.col("table_name") == table).agg(
        F.coalesce(F.max("last_processed_timestamp"), F.lit("1970-01-01").cast("timestamp"))
    )
    return fact.where(F.col(ts) > wm.scalar())


def join_slo(metrics: DataFrame, slo: DataFrame) -> DataFrame:
    """Metrics with their objective."""
    return metrics.join(slo, ["layer", "metric"])


def join_semi(fact: DataFrame, touched: DataFrame, key: str | list[str]) -> DataFrame:
    return fact.join(touched, key, "left_semi")


def bronze_gaps(events: DataFrame, start, end, ts: str = "event_time") -> DataFrame:
    """Hours of [start, end] without any Bronze row."""
    lo = F.date_trunc("hour", instant(start))
    hi = F.date_trunc("hour", instant(end))
    one_hour = F.expr("INTERVAL 1 HOUR")
    hours = events.sparkSession.range(1).select(F.explode(F.sequence(lo, hi, one_hour)).alias("hour"))
    seen = (
        events.where((F.col(ts) >= lo) & (F.col(ts) < hi + one_hour))
        .select(F.date_trunc("hour", ts).alias("hour"))
        .distinct()
    )
    return hours.join(seen, "hour", "left_anti")


def time_split(df: DataFrame, ts: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(rows before the cutoff, rows at or after it)."""
    at = instant(cutoff)
    return df.where(F.col(ts) < at), df.where(F.col(ts) >= at)


def query_audit(events: DataFrame, action=None, resource=None, user=None, start=None) -> DataFrame:
    """Audit events matching every given filter; the start is compared as ISO text, as logged."""
    wanted = [
        (action, F.col("action") == action),
        (resource, F.col("resource") == resource),
        (user, F.col("user") == user),
        (start, F.col("timestamp") >= F.lit(start)),
    ]
    for given, predicate in wanted:
        if given:
            events = events.where(predicate)
    return events


def project_contract(df: DataFrame, contract: Contract) -> DataFrame:
    return df.select(*contract.columns)


def derive_defaults(df: DataFrame, batch_ts, source: str) -> DataFrame:
    """Load stamps, filled where absent. The batch time is a parameter, so a rerun gives the same rows."""
    ts = instant(batch_ts)

    def default(name: str, value: Column) -> Column:
        return F.coalesce(F.col(name), value) if name in df.columns else value

    return df.withColumns(
        {
            "created_at": default("created_at", ts),
            "updated_at": ts,
            "data_source": default("data_source", F.lit(source)),
        }
    )


def sort_entity_time(df: DataFrame, entity: str, ts: str, tie: str) -> DataFrame:
    """Lay rows out by entity and time: range-partitioned, so a hot entity spans several tasks."""
    return df.repartitionByRange(entity, ts, tie).sortWithinPartitions(entity, ts, tie)
