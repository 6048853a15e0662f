"""Running totals in value order without a single-task sort.

Rows are dealt into ranges of (group, value) by Spark's range partitioner, as many as keep a range at a size
one task can sort, and stored. The total of a range and group is added up over the ranges before it, of which
there is one row each, and the running total inside a range is added to that. The result is exact for
any choice of ranges, and stored ranges are the same when a task runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import stored

RANGE_ROWS = 1_000_000  # distinct values that one task sorts


def running_totals(
    df: DataFrame, value: str, sums: list[str], group: str | None = None, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add ``cum_<s>`` = sum of s over the group's rows with a value up to and including this one,
    and ``total_<s>`` = sum of s over the group.

    ``df`` must hold one row per (group, value): aggregate first, which also folds a value that
    holds a large share of the rows into a single row. The groups, if any, are few (columns of a
    table).
    """
    keys = [group] if group else []
    values = stored(df, "values")
    ranges = 1 + values.count() // range_rows
    ranged = stored(values.repartitionByRange(ranges, *keys, value).withColumn("__range", F.spark_partition_id()), "ranges")
    same = [F.col(k) for k in keys] or [F.lit(0)]
    earlier = Window.partitionBy(*same).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*same)
    offsets = (
        ranged.groupBy(*keys, "__range")
        .agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
        .select(
            *[F.col(k).alias(f"__k_{k}") for k in keys],
            F.col("__range").alias("__r"),
            *[F.coalesce(F.sum(f"__t_{s}").over(earlier), F.lit(0)).alias(f"__o_{s}") for s in sums],
            *[F.sum(f"__t_{s}").over(whole).cast("bigint").alias(f"total_{s}") for s in sums],
        )
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    on = F.col("__range") == F.col("__r")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return (
        ranged.withColumns({f"cum_{s}": F.sum(s).over(inside) for s in sums})
        .join(offsets, on)
        .withColumns({f"cum_{s}": F.col(f"cum_{s}") + F.col(f"__o_{s}") for s in sums})
        .drop("__range", "__r", *[f"__k_{k}" for k in keys], *[f"__o_{s}" for s in sums])
    )
