"""Service-level metrics, objectives and alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.gold import billing_total
from ledgerlake.operators.incremental import union_all
from ledgerlake.operators.relations import join_slo
from ledgerlake.session import instant, stored
from ledgerlake.sources.publish import folder_of, table_files

# Metrics where a lower value is better, metrics whose breach is always critical,
# and the deviations from the objective that count as critical and as a warning.
LOWER_IS_BETTER = (
    "event_latency_p99", "dlq_count", "data_freshness", "schema_drift_count", "inference_latency_p99",
    "drift_score", "table_freshness", "daily_spend", "cost_per_prediction",
)
ALWAYS_CRITICAL = ("delivery_success_rate", "schema_drift_count", "inference_latency_p99")
CRITICAL_DEVIATION, WARNING_DEVIATION = 0.5, 0.2


def freshness(df: DataFrame, ts: str, now) -> DataFrame:
    """Minutes since the newest row; infinity when there is none."""
    age = (F.unix_micros(instant(now)) - F.unix_micros(F.max(ts))) / 60_000_000
    return df.agg(F.coalesce(age, F.lit(float("inf"))).alias("freshness_minutes"))


def file_freshness(spark: SparkSession, path: str, now, by_folder: bool = False) -> DataFrame:
    """Minutes since the newest file of a table was written, of each of its partition folders or of all; infinity for an
    empty table. From the file listing alone: no file is opened."""
    files = table_files(spark, path)
    if by_folder:
        return freshness(files.groupBy(folder_of(F.col("file")).alias("folder")), "modified", now)
    return freshness(files, "modified", now)


def stream_latency(arrivals: DataFrame, period: str = "5 minutes", ts: str = "event_time", latency: str = "latency_ms",
                   delivered: str = "delivered") -> DataFrame:
    """Per period: largest and 99th-percentile latency, and the share delivered in percent.

    Rows are first counted per (period, latency, delivered), so the percentile works on distinct
    latencies with weights however many rows a period holds.
    """
    start = F.window(ts, period)["start"]
    counted = arrivals.groupBy(start.alias("window_start"), latency, delivered).agg(F.count(F.lit(1)).alias("n"))
    per_latency = counted.groupBy("window_start", latency).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col(delivered)).alias("ok")
    )
    return per_latency.groupBy("window_start").agg(
        F.max(latency).alias("max_latency_ms"),
        F.percentile(latency, F.lit(0.99), F.col("n")).alias("p99_latency_ms"),
        (F.sum("ok") * 100.0 / F.sum("n")).alias("success_rate"),
        F.sum("n").alias("records"),
    )


def dlq_hourly(dlq: DataFrame, ts: str = "failed_at", limit: int = 100) -> DataFrame:
    per_hour = dlq.groupBy(F.window(ts, "1 hour")["start"].alias("hour")).agg(F.count(F.lit(1)).alias("dlq_count"))
    return per_hour.withColumn("breached", F.col("dlq_count") > limit)


def validity_rate(df: DataFrame, valid: Column) -> DataFrame:
    """Share of valid rows in percent; a null verdict counts as invalid."""
    return df.agg((F.avg(F.coalesce(valid, F.lit(False)).cast("int")) * 100).alias("validity_rate"))


def metrics(df: DataFrame, layer: str, **columns: str) -> DataFrame:
    """A one-row frame as ``(layer, metric, value)`` rows, one per ``metric=column``."""
    cells = ", ".join(f"'{name}', CAST(`{column}` AS DOUBLE)" for name, column in columns.items())
    return df.select(
        F.lit(layer).alias("layer"), F.expr(f"stack({len(columns)}, {cells}) AS (metric, value)")
    )


def metrics_snapshot(*frames: DataFrame) -> DataFrame:
    return union_all(*frames)


def cost_metrics(billing: DataFrame, fact: DataFrame, start, end, days: int = 30) -> DataFrame:
    """Daily spend of the period and spend per prediction (predictions counted from the fact)."""
    total = billing_total(billing, start, end).where("cloud IS NULL").select("total_cost")
    predictions = fact.agg(F.count(F.lit(1)).alias("n"))
    spend = F.coalesce(total.scalar(), F.lit(0.0)) / days
    return predictions.select(
        spend.alias("daily_spend"), F.try_divide(spend, F.col("n")).alias("cost_per_prediction")
    )


def slo_breaches(metrics: DataFrame, slo: DataFrame) -> DataFrame:
    value, target = F.col("value"), F.col("slo")
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    breached = F.when(lower, value > target).otherwise(value < target)
    deviation = F.try_divide(F.abs(value - target), target)
    severity = (
        F.when(F.col("metric").isin(*ALWAYS_CRITICAL), "critical")
        .when(target == 0, "warning")
        .when(deviation > CRITICAL_DEVIATION, "critical")
        .when(deviation > WARNING_DEVIATION, "warning")
        .otherwise("info")
    )
    return join_slo(metrics, slo).where(breached).withColumn("severity", severity)


def windowed_alarms(samples: DataFrame, alarms: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """Per alarm and period: the statistic, whether it breaches, and whether the alarm fires.

    ``samples`` has ``metric``; ``alarms`` is configuration: ``(alarm, metric, statistic,
    period_s, threshold, n)``. An alarm fires in the n-th consecutive breaching period; a period
    without samples does not breach.
    """
    period = (F.floor(F.unix_seconds(ts) / F.col("period_s")) * F.col("period_s")).cast("bigint")
    v = F.col(value)
    per_period = (
        samples.join(alarms, "metric")
        .groupBy("alarm", period.alias("period_start"))
        .agg(F.avg(v).alias("Average"), F.max(v).alias("Maximum"), F.sum(v).alias("Sum"))
    )
    span = per_period.groupBy("alarm").agg(F.min("period_start").alias("lo"), F.max("period_start").alias("hi"))
    grid = alarms.join(span, "alarm").select(
        "alarm", "statistic", "threshold", "n", F.explode(F.sequence("lo", "hi", F.col("period_s").cast("bigint"))).alias("period_start")
    )
    stat = (
        F.when(F.col("statistic") == "Average", F.col("Average"))
        .when(F.col("statistic") == "Maximum", F.col("Maximum"))
        .when(F.col("statistic") == "Sum", F.col("Sum"))
    )
    filled = grid.join(per_period, ["alarm", "period_start"], "left").withColumn("value", stat)
    filled = filled.withColumn("breach", F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)))
    # Consecutive breaches = position minus the last position that did not breach.
    w = Window.partitionBy("alarm").orderBy("period_start")
    position = filled.withColumn("__i", F.row_number().over(w))
    calm = F.max(F.when(~F.col("breach"), F.col("__i"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    run = F.col("__i") - F.coalesce(calm, F.lit(0))
    return position.withColumn("__run", run).select(
        "alarm",
        F.timestamp_seconds("period_start").alias("period_start"),
        "value",
        "breach",
        (F.col("__run") >= F.col("n")).alias("firing"),
    )


def counter_rate(samples: DataFrame, series: str, ts: str = "ts", value: str = "value", seconds: int = 300) -> DataFrame:
    """Per-second rate of a counter over the last ``seconds``; a drop is a restart from zero.

    ``samples`` are scrapes: per series their number is bounded by time, not by traffic.
    """
    w = Window.partitionBy(series).orderBy(ts)
    previous = F.lag(value).over(w)
    step = F.when(F.col(value) >= previous, F.col(value) - previous).otherwise(F.col(value))
    increase = samples.withColumn("__inc", F.when(previous.isNull(), F.lit(0)).otherwise(step)).withColumn(
        "__s", F.unix_seconds(ts)
    )
    recent = Window.partitionBy(series).orderBy("__s").rangeBetween(1 - seconds, 0)
    return increase.select(series, ts, (F.sum("__inc").over(recent) / seconds).alias("rate"))


def histogram_quantile(buckets: DataFrame, q: float, keys: list[str], le: str = "le", count: str = "cum_count") -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket it falls into.

    The last bucket is open; a quantile in it is reported as the highest finite bound.
    """
    w = Window.partitionBy(*keys).orderBy(le)
    total = F.max(count).over(Window.partitionBy(*keys))
    low = F.coalesce(F.lag(le).over(w), F.lit(0.0))
    below = F.coalesce(F.lag(count).over(w), F.lit(0))
    ranked = buckets.withColumns({"__rank": total * q, "__low": low, "__below": below})
    hit = ranked.where((F.col(count) >= F.col("__rank")) & (F.col("__below") < F.col("__rank")))
    inside = F.col("__low") + (F.col(le) - F.col("__low")) * (F.col("__rank") - F.col("__below")) / (
        F.col(count) - F.col("__below")
    )
    return hit.select(*keys, F.when(F.col(le) == float("inf"), F.col("__low")).otherwise(inside).alias("quantile"))


def latency_buckets(arrivals: DataFrame, bounds: list[float], period: str = "5 minutes", ts: str = "event_time",
                    latency: str = "latency_ms") -> DataFrame:
    """Cumulative latency buckets per period, as an exporter would publish them."""
    edges = [*bounds, float("inf")]
    counts = [F.count_if(F.col(latency) <= b).alias(f"b{i}") for i, b in enumerate(edges)]
    wide = arrivals.groupBy(F.window(ts, period)["start"].alias("window_start")).agg(*counts)
    cells = ", ".join(f"double('{b}'), b{i}" for i, b in enumerate(edges))
    return wide.select("window_start", F.expr(f"stack({len(edges)}, {cells}) AS (le, cum_count)"))


def success_ratio(runs: DataFrame, ts: str, ok: str, period: str = "1 hour") -> DataFrame:
    start = F.window(ts, period)["start"].alias("window_start")
    return runs.groupBy(start).agg((F.sum(ok) * 100.0 / F.count(F.lit(1))).alias("success_pct"))


# --- request guards ---------------------------------------------------------------------


def rate_limit(requests: DataFrame, rpm: int = 100, client: str = "client_id", minute: str = "minute_bucket",
               order: tuple[str, str] = ("req_sec", "seq")) -> DataFrame:
    """Add ``accepted``: the first ``rpm`` requests of a client in a minute.

    Only those first requests are ranked (pruned before the shuffle); the last of them is the
    cut-off the other requests of the client and minute are compared with, so a client with most
    of the traffic is never sorted in one task.
    """
    keys, by = [client, minute], F.struct(*order)
    first = Window.partitionBy(*keys).orderBy(*order)
    head = requests.select(*keys, *order).withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= rpm)
    cutoff = head.where(F.col("__r") == rpm).select(
        F.col(client).alias("__client"), F.col(minute).alias("__minute"), by.alias("__cut"))
    # Requests without a client are limited together, as one: the join is null-safe.
    same = F.col(client).eqNullSafe(F.col("__client")) & F.col(minute).eqNullSafe(F.col("__minute"))
    out = requests.join(cutoff, same, "left")
    return out.withColumn("accepted", F.col("__cut").isNull() | (by <= F.col("__cut"))).drop("__cut", "__client", "__minute")


BLOCK = 1024  # of a key's seconds, in spans of the time to live, that one task sorts


def _successors(seconds: DataFrame, keys: list[str], at: str, ttl: int, block: int) -> DataFrame:
    """``seconds`` with ``__next``, the first second of the key more than ``ttl`` later, and ``__start``, whether none is at
    most ``ttl`` earlier. ``__next`` is null after a pause too: what follows one is a start.

    Time is cut into blocks; a block also gets the seconds around it that its own can look at, so however many
    a key has, a task sorts the different seconds of one block.
    """
    width = block * ttl
    home = F.floor(F.col(at) / width)
    first, last = F.floor((F.col(at) - 2 * ttl) / width), F.floor((F.col(at) + ttl) / width)
    copies = seconds.select("*", F.explode(F.sequence(first, last)).alias("__block")).withColumn("__own", F.col("__block") == home)
    w = Window.partitionBy(*keys, "__block").orderBy(at)
    return copies.select(
        "*",
        F.min(at).over(w.rangeBetween(ttl + 1, 2 * ttl)).alias("__next"),
        F.max(at).over(w.rangeBetween(-ttl, -1)).isNull().alias("__start"),
    ).where("__own").drop("__own", "__block")


def _reached(linked: DataFrame, keys: list[str], at: str) -> DataFrame:
    """``(keys, at)`` of all that is reached from the starts over ``__next``, by doubling: jumps of 1, 2, 4, ... links are
    joined from each other while there are any, then taken from the longest to the shortest."""
    jumps = [stored(linked.where("__next IS NOT NULL").select(*keys, at, "__next"), "jumps")]
    while not jumps[-1].isEmpty():
        further = jumps[-1].select(*keys, F.col(at).alias("__next"), F.col("__next").alias("__far"))
        jumps.append(stored(jumps[-1].join(further, [*keys, "__next"]).select(*keys, at, F.col("__far").alias("__next")), "jumps"))
    found = linked.where("__start").select(*keys, at)
    for jump in reversed(jumps[:-1]):
        more = found.join(jump, [*keys, at]).select(*keys, F.col("__next").alias(at))
        found = stored(found.unionByName(more), "reached")  # each is reached by one way only
    return found


def replay_guard(requests: DataFrame, skew: int = 300, ttl: int = 300, client: str = "client_id", nonce: str = "nonce",
                 at: str = "req_sec", skew_col: str = "skew_sec", tie: str = "seq", block: int = BLOCK) -> DataFrame:
    """Add ``verdict``: skewed, replayed or accepted.

    A nonce is refused within ``ttl`` seconds of its last *accepted* use. Of all requests of one nonce only the different
    seconds matter. The second after an accepted one is the first more than ``ttl`` later, so accepted are those that these
    links reach from the first second of each run without a pause: no key and no run is ever held in one row
    or sorted in one task. Requests without a client or nonce are never accepted.
    """
    checked = requests.withColumn("__ok", F.abs(F.col(skew_col)) <= skew)
    keys = [client, nonce]
    usable = checked.where(F.col("__ok") & F.col(client).isNotNull() & F.col(nonce).isNotNull())
    seconds = stored(usable.groupBy(*keys, F.col(at).cast("bigint").alias(at)).agg(F.min(tie).alias("__first")), "seconds")
    reached = _reached(stored(_successors(seconds.drop("__first"), keys, at, ttl, block), "successors"), keys, at)
    winners = reached.join(seconds, [*keys, at]).select(
        *keys, F.col(at).cast(requests.schema[at].dataType).alias(at), F.col("__first").alias(tie), F.lit(True).alias("__win"))
    verdict = (
        F.when(~F.col("__ok"), "skewed").when(F.col("__win"), "accepted").otherwise("replayed")
    )
    out = checked.join(winners, [*keys, at, tie], "left")
    return out.withColumn("verdict", verdict).drop("__ok", "__win")
