"""Silver features per entity. Inputs are Bronze rows, output is the input plus feature columns.

All windows of one use case share an entity and an order, so they cost one shuffle and one sort.
Growing frames are preferred to sliding ones where a frame can hold many rows: a count over the
last minute is the difference of two growing counts, which is linear even when one customer has
thousands of events within a minute.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlake.functions.geo import haversine_km
from ledgerlake.functions.stats import entropy_bits
from ledgerlake.operators.hotkeys import HOT_ROWS, hot_entities, over_entity, split_hot
from ledgerlake.session import stored

MICROS = 1_000_000
VELOCITY_SECONDS = 60
DEVICE_ROWS = 5
REPAYMENT_ROWS = 12
VOLATILITY_DAYS = 90
COMPLAINT_ROWS = 30
DECAY = 0.01


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts))


def _epoch_day(day: str) -> Column:
    return F.unix_date(F.col(day).cast("date"))


# --- windows and what is derived from them ----------------------------------------------

Columns = dict[str, Column]


@dataclass(frozen=True)
class Feature:
    """One output column: the windows it needs (by temporary name) and its value from them."""

    name: str
    windows: Callable[[WindowSpec], Columns]
    value: Callable[[], Column]


def combined(features: list[Feature]) -> dict[str, Callable]:
    """``build`` and ``derive`` for several features computed in one pass."""
    return {
        "build": lambda w: {name: c for f in features for name, c in f.windows(w).items()},
        "derive": lambda: {f.name: f.value() for f in features},
    }


def velocity(seconds: int = VELOCITY_SECONDS) -> Feature:
    """Events in (t - seconds, t], events at the same instant included."""

    def windows(w: WindowSpec) -> Columns:
        w = w.orderBy("__pos")
        return {
            "__upto": F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, 0)),
            "__expired": F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, -seconds * MICROS)),
        }

    return Feature("tx_velocity_1m", windows, lambda: F.col("__upto") - F.col("__expired"))


def geo_distance(lat: str = "latitude", lon: str = "longitude") -> Feature:
    """Distance to the entity's previous row; 0 where either end is unknown."""
    km = haversine_km(F.col("__lat"), F.col("__lon"), F.col(lat), F.col(lon))
    return Feature(
        "geo_distance_km",
        lambda w: {"__lat": F.lag(lat).over(w), "__lon": F.lag(lon).over(w)},
        lambda: F.coalesce(km, F.lit(0.0)),
    )


def device_entropy(rows: int = DEVICE_ROWS, device: str = "device_id") -> Feature:
    """Entropy of the last few devices; a missing id is a value of its own."""
    used = F.coalesce(F.col(device), F.lit(""))
    earlier = [f"__device{i}" for i in range(1, rows)]
    return Feature(
        "device_entropy",
        lambda w: {name: F.lag(used, i).over(w) for i, name in enumerate(earlier, 1)},
        lambda: entropy_bits([used, *[F.col(name) for name in earlier]]),
    )


def repayment_history(rows: int = REPAYMENT_ROWS, status: str = "repayment_status") -> Feature:
    return Feature(
        "repayment_history",
        lambda w: {"__history": F.collect_list(status).over(w.rowsBetween(1 - rows, 0))},
        lambda: F.col("__history"),
    )


def _share(name: str, column: str, value: str, rows: int) -> Feature:
    """Share of the last ``rows`` rows that have the value."""
    hit = F.when(F.col(column) == value, 1.0).otherwise(0.0)
    return Feature(name, lambda w: {f"__{name}": F.avg(hit).over(w.rowsBetween(1 - rows, 0))}, lambda: F.col(f"__{name}"))


def delinquency(rows: int = REPAYMENT_ROWS) -> Feature:
    return _share("delinquency_trends", "repayment_status", "missed", rows)


def complaint_frequency(rows: int = COMPLAINT_ROWS) -> Feature:
    return _share("complaint_frequency", "event_type", "complaint", rows)


def balance_volatility(balance: str = "balance", days: int = VOLATILITY_DAYS) -> Feature:
    return Feature(
        "balance_volatility",
        lambda w: {"__dev": F.stddev_samp(F.col(balance).cast("double")).over(w.orderBy("__pos").rangeBetween(1 - days, 0))},
        lambda: F.col("__dev"),
    )


def _whole(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def transaction_decay() -> Feature:
    return Feature(
        "transaction_decay", lambda w: {"__n": F.count(F.lit(1)).over(_whole(w))}, lambda: decay_of(F.col("__n"))
    )


def login_inactivity(ts: str) -> Feature:
    return Feature(
        "login_inactivity",
        lambda w: {"__last": F.max(ts).over(_whole(w))},
        lambda: whole_days(F.col("__last"), F.col(ts)),
    )


def decay_of(n: Column, rate: float = DECAY) -> Column:
    """Sum of exp(-rate * i) for i < n, in closed form."""
    return (1.0 - F.exp(-rate * n)) / (1.0 - math.exp(-rate))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two instants."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / (86_400 * MICROS)).cast("bigint")


# --- fraud ------------------------------------------------------------------------------


def feat_tx_velocity(events, *, entity="customer_id", ts="event_time", tie="event_id",
                     seconds=VELOCITY_SECONDS, hot_rows=HOT_ROWS) -> DataFrame:
    return over_entity(
        events, key=entity, pos=_micros(ts), seq=tie, span=seconds * MICROS, cell=seconds * MICROS,
        hot_rows=hot_rows, **combined([velocity(seconds)]),
    )


def feat_geo_distance(events, *, entity="customer_id", ts="event_time", tie="event_id",
                      hot_rows=HOT_ROWS) -> DataFrame:
    return over_entity(
        events, key=entity, pos=_micros(ts), seq=tie, tail=1, hot_rows=hot_rows,
        **combined([geo_distance()]),
    )


def feat_device_entropy(events, *, entity="customer_id", ts="event_time", tie="event_id",
                        rows=DEVICE_ROWS, hot_rows=HOT_ROWS) -> DataFrame:
    return over_entity(
        events, key=entity, pos=_micros(ts), seq=tie, tail=rows - 1, hot_rows=hot_rows,
        **combined([device_entropy(rows)]),
    )


def fraud_features(events, *, entity="customer_id", ts="event_time", tie="event_id",
                   hot_rows=HOT_ROWS) -> DataFrame:
    """All three fraud features in one pass."""
    return over_entity(
        events, key=entity, pos=_micros(ts), seq=tie, tail=DEVICE_ROWS - 1,
        span=VELOCITY_SECONDS * MICROS, cell=VELOCITY_SECONDS * MICROS, hot_rows=hot_rows,
        # the windows with the longer order first: their sort also serves the velocity
        **combined([geo_distance(), device_entropy(), velocity()]),
    )


# --- credit risk ------------------------------------------------------------------------


def feat_repayment_history(snapshots, *, entity="account_id", ts="snapshot_date", tie="seq",
                           rows=REPAYMENT_ROWS, hot_rows=HOT_ROWS) -> DataFrame:
    return over_entity(
        snapshots, key=entity, pos=_epoch_day(ts), seq=tie, tail=rows - 1, cell=1, hot_rows=hot_rows,
        **combined([repayment_history(rows)]),
    )


def feat_delinquency(snapshots, *, entity="account_id", ts="snapshot_date", tie="seq",
                     rows=REPAYMENT_ROWS, hot_rows=HOT_ROWS) -> DataFrame:
    return over_entity(
        snapshots, key=entity, pos=_epoch_day(ts), seq=tie, tail=rows - 1, cell=1, hot_rows=hot_rows,
        **combined([delinquency(rows)]),
    )


def _sample_stddev(n: Column, total: Column, squares: Column) -> Column:
    n = n.cast("double")
    spread = squares.cast("double") - total.cast("double") * total.cast("double") / n
    # exact sums make a negative spread impossible except for the last rounding
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))


def _join_daily_volatility(rows: DataFrame, entity: str, ts: str, balance: str, days: int) -> DataFrame:
    by_day = _daily_volatility(rows, entity, ts, balance, days).withColumnRenamed(entity, "__e")
    same_day = (F.col(entity) == F.col("__e")) & (F.col(ts).cast("date") == F.col("__day"))
    return rows.join(by_day, same_day, "left").drop("__e", "__day")


def _daily_volatility(rows: DataFrame, entity: str, ts: str, balance: str, days: int) -> DataFrame:
    """The 90-day deviation per (entity, day), from exact per-day sums of distances to a centre."""
    centre = stored(rows.groupBy(entity).agg(F.min(balance).alias("__c")), "centres")
    dist = (F.col(balance) - F.col("__c")).cast("decimal(18,2)")
    daily = (
        rows.join(centre, entity)  # one row per hot entity
        .groupBy(entity, F.col(ts).cast("date").alias("__day"))
        .agg(
            F.count(dist).alias("__n"),
            F.sum(dist).alias("__s"),
            F.sum((dist * dist).cast("decimal(36,4)")).alias("__q"),
        )
    )
    w = Window.partitionBy(entity).orderBy(F.unix_date("__day")).rangeBetween(1 - days, 0)
    return daily.select(
        entity,
        "__day",
        _sample_stddev(F.sum("__n").over(w), F.sum("__s").over(w), F.sum("__q").over(w)).alias("balance_volatility"),
    )


def feat_balance_volatility(snapshots, *, entity="account_id", ts="snapshot_date", tie="seq",
                            balance="balance", days=VOLATILITY_DAYS, hot_rows=HOT_ROWS) -> DataFrame:
    """Sample deviation of the balance over the last ``days`` days.

    A hot account is summed up per day first, so that its window holds days, not snapshots; the
    result is joined back by (account, day), where adaptive execution splits a skewed day.
    """
    found, limit = hot_entities(snapshots, entity, hot_rows)
    calm, busy = split_hot(snapshots, entity, found)

    out = over_entity(calm, key=entity, pos=_epoch_day(ts), seq=tie, hot=(None, limit),
                      **combined([balance_volatility(balance, days)]))
    if busy is None:
        return out
    busy_out = _join_daily_volatility(busy, entity, ts, balance, days)
    return out.unionByName(busy_out)


def credit_features(snapshots, *, entity="account_id", ts="snapshot_date", tie="seq",
                    balance="balance", hot_rows=HOT_ROWS) -> DataFrame:
    """All three credit features; one shuffle for ordinary accounts."""
    found, limit = hot_entities(snapshots, entity, hot_rows)
    calm, busy = split_hot(snapshots, entity, found)

    by_rows = [repayment_history(), delinquency()]
    day = _epoch_day(ts)
    out = over_entity(calm, key=entity, pos=day, seq=tie, hot=(None, limit),
                      **combined([*by_rows, balance_volatility(balance)]))
    if busy is None:
        return out
    rows = over_entity(busy, key=entity, pos=day, seq=tie, tail=REPAYMENT_ROWS - 1, cell=1, hot=(found, limit),
                       **combined(by_rows))
    busy_out = _join_daily_volatility(rows, entity, ts, balance, VOLATILITY_DAYS)
    return out.unionByName(busy_out)


# --- churn ------------------------------------------------------------------------------


def _hot_totals(rows: DataFrame, entity: str, ts: str, wanted: list[Feature]) -> DataFrame:
    """Hot entities: a partial aggregate, stored so that the join back can be split."""
    totals = stored(rows.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"), F.max(ts).alias("__last")), "totals")
    columns = {f.name: f.value() for f in wanted}
    return rows.join(totals, entity).withColumns(columns).drop("__n", "__last")


def _whole_entity(events: DataFrame, entity: str, ts: str, hot_rows: int, wanted: Feature) -> DataFrame:
    """A column that needs the entity's count or latest event."""
    found, _ = hot_entities(events, entity, hot_rows)
    calm, busy = split_hot(events, entity, found)
    lone = F.when(F.col(entity).isNull(), F.rand(0))  # spreads the rows without an entity
    windows = wanted.windows(Window.partitionBy(entity, "__lone"))
    value = F.when(F.col(entity).isNotNull(), wanted.value())
    out = calm.withColumn("__lone", lone).withColumns(windows).withColumn(wanted.name, value).drop("__lone", *windows)
    return out if busy is None else out.unionByName(_hot_totals(busy, entity, ts, [wanted]))


def feat_tx_decay(events, *, entity="customer_id", ts="event_time", hot_rows=HOT_ROWS) -> DataFrame:
    """Decayed count over all of the entity's events (the 90 days named in prose are not applied)."""
    return _whole_entity(events, entity, ts, hot_rows, transaction_decay())


def feat_login_inactivity(events, *, entity="customer_id", ts="event_time", hot_rows=HOT_ROWS) -> DataFrame:
    return _whole_entity(events, entity, ts, hot_rows, login_inactivity(ts))


def feat_complaint_freq(events, *, entity="customer_id", ts="event_time", tie="seq",
                        rows=COMPLAINT_ROWS, hot_rows=HOT_ROWS) -> DataFrame:
    return over_entity(
        events, key=entity, pos=_micros(ts), seq=tie, tail=rows - 1, hot_rows=hot_rows,
        **combined([complaint_frequency(rows)]),
    )


def churn_features(events, *, entity="customer_id", ts="event_time", tie="seq", hot_rows=HOT_ROWS) -> DataFrame:
    """All three churn features; one shuffle for ordinary customers."""
    found, limit = hot_entities(events, entity, hot_rows)
    calm, busy = split_hot(events, entity, found)

    totals = [transaction_decay(), login_inactivity(ts)]
    out = over_entity(calm, key=entity, pos=_micros(ts), seq=tie, hot=(None, limit),
                      **combined([complaint_frequency(), *totals]))
    if busy is None:
        return out
    rows = over_entity(busy, key=entity, pos=_micros(ts), seq=tie, tail=COMPLAINT_ROWS - 1, hot=(found, limit),
                       **combined([complaint_frequency()]))
    busy_out = _hot_totals(rows, entity, ts, totals)
    return out.unionByName(busy_out)


# --- latest row per entity --------------------------------------------------------------


def feature_snapshot(df: DataFrame, entity: str, ts: str, tie: str) -> DataFrame:
    """Newest feature row per entity. The rank filter is applied before the shuffle as well."""
    newest = Window.partitionBy(entity).orderBy(F.desc(ts), F.desc(tie))
    return df.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") == 1).drop("__r")
