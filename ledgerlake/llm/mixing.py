"""Mixing sources to target weights by capped water-filling.

A source's target is its weight's share of all words, but never more than ``max_epochs`` times the
words it has; what the clamped sources leave is shared by the others by weight until none is above
its cap. A source then takes every document ``whole`` times and, in a seeded order, further
documents until its target is met; the last of them is taken in part. Reruns agree, as the order
is a hash of seed and doc_id.

Edge cases: a null text has no words and is never taken; the null source is a source of its own and
comes last; an empty table gives an empty mix; sources of no words get target 0; rows that repeat a
doc_id are separate rows with adjoining places in the order; texts of any length are counted whole. Helper columns begin with ``__mx_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import BLANK_RUN, WORD, partitions, store

MAX_EPOCHS = 3
SEED = 20240817
BUCKETS = 4096  # three hex digits of the order key; bounds the rows of a source in its histogram


def words_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def numbered(df: DataFrame, order: Column) -> DataFrame:
    """``df`` with ``__mx_rank`` from 0, ranked over sorted partitions rather than in one task."""
    spark = df.sparkSession
    parts = store(
        df.repartitionByRange(partitions(spark), order).sortWithinPartitions(order)
        .withColumns({"__mx_part": F.spark_partition_id(),
                      "__mx_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}),
        "ranked",
    )
    # One row per partition, so the running count is over as many rows as there are partitions.
    before = Window.orderBy("__mx_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("__mx_part").count().select(
        "__mx_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__mx_before"))
    return (parts.join(offsets, "__mx_part")
            .withColumn("__mx_rank", F.col("__mx_row") + F.col("__mx_before"))
            .drop("__mx_part", "__mx_row", "__mx_before"))


def water_level(sources: DataFrame) -> float:
    """The level whose product with the weights, cut at the caps, sums to all sizes.

    ``sources`` has ``weight``, ``cap`` and ``source_size``. Each round clamps the sources above
    their cap at the level so far and shares the rest again; the level only rises.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        over = F.col("cap") < F.col("weight") * F.lit(level)
        clamped, weight = sources.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        if not weight:
            break
        higher = float(total - (clamped or 0)) / float(weight)
        if higher <= level:
            break
        level = higher
    return level


def targets(sizes: DataFrame, weights: Column, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source of ``sizes (source, size)``: source_size and target. ``weights`` is an expression
    over ``__mx_rank``, the source's place by code point, null last."""
    # Spark compares strings by their UTF-8 bytes, which is code point order.
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = store(
        numbered(sums, F.col("source").asc_nulls_last())
        .withColumns({"weight": weights, "cap": F.col("source_size") * max_epochs}).drop("__mx_rank"), "sources")
    level = water_level(ranked)
    return ranked.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)))


def cycle_weights(n: int = 3) -> Column:
    """1, 2, ... n, repeating."""
    return F.col("__mx_rank") % n + 1


def allot(sizes: DataFrame, weights: Column | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``sizes (doc_id, source, size, ...)`` with source_size, target, whole and ``taken``."""
    plan = targets(sizes, cycle_weights() if weights is None else weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("__mx_whole", whole.cast("long")).withColumn(
        "__mx_part", F.round(F.col("target") - F.col("__mx_whole") * F.col("source_size")).cast("long"))
    keyed = sizes.withColumn("__mx_key", order_key(seed)).withColumn(
        "__mx_bucket", F.conv(F.substring("__mx_key", 1, 3), 16, 10).cast("int"))
    before = Window.partitionBy("source").orderBy("__mx_bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = keyed.groupBy("source", "__mx_bucket").agg(F.sum("size").alias("n")).select(
        "source", "__mx_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__mx_before"))
    histogram = histogram.join(plan, histogram["source"].eqNullSafe(plan["source"])).select(
        histogram["source"].alias("__mx_source"), histogram["__mx_bucket"].alias("__mx_b"), "__mx_before",
        "source_size", "target", "__mx_whole", "__mx_part")
    within = (Window.partitionBy("source", "__mx_bucket").orderBy("__mx_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = keyed.withColumn("__mx_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(histogram, rows["source"].eqNullSafe(F.col("__mx_source"))
                     & (F.col("__mx_bucket") == F.col("__mx_b")))
    left = F.col("__mx_part") - F.col("__mx_before") - F.col("__mx_within")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return rows.withColumns({"whole": F.col("__mx_whole"), "taken": F.col("__mx_whole") * F.col("size") + extra}).drop(
        "__mx_key", "__mx_bucket", "__mx_b", "__mx_source", "__mx_before", "__mx_whole", "__mx_part", "__mx_within")


def mix(docs: DataFrame, text: str = "text", max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, one row per repetition.

    A document taken in part is cut after its last word taken, its words joined by single spaces.
    """
    columns = docs.columns
    base = docs.withColumns({"size": words_of(text), "__mx_id": F.monotonically_increasing_id()})
    base = store(base, "mixing")
    taken = allot(base.select("doc_id", "source", "size", "__mx_id"), None, max_epochs, seed).select("__mx_id", "taken")
    rows = base.join(taken, "__mx_id").where(F.col("taken") > 0)
    copies = F.transform(
        F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size"))),
        lambda i: F.least(F.col("size"), F.col("taken") - (i - 1) * F.col("size")))
    rows = rows.select(*columns, "size", F.explode(copies).alias("__mx_words"))
    words = F.filter(F.split(F.col(text), BLANK_RUN), lambda w: w != "")
    cut = F.when(F.col("__mx_words") == F.col("size"), F.col(text)).otherwise(
        F.array_join(F.slice(words, F.lit(1), F.col("__mx_words").cast("int")), " "))
    return rows.withColumn(text, cut).select(*columns)
