"""Binary classification metrics and distribution drift, exact and without a global sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.stats import EXACT_SIZE, clean_double, ks_test_p
from ledgerlake.operators.cumulative import RANGE_ROWS, running_totals
from ledgerlake.operators.incremental import union_all

ALPHA = 0.05


def eval_binary(scored: DataFrame, label: str, score: str, threshold: float = 0.5, range_rows: int = RANGE_ROWS
                ) -> DataFrame:
    """One row: AUC, precision, recall, F1 and the confusion matrix (predicted = score > threshold).

    Everything derives from positives and negatives per distinct score, so equal scores meet in
    partial aggregation. AUC counts, for each positive, the negatives below it and half of those
    level with it.
    """
    s, positive = clean_double(F.col(score)), F.col(label).cast("int") == 1
    per_score = (
        scored.where(s.isNotNull() & F.col(label).isNotNull())
        .groupBy(s.alias("s"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    ranked = running_totals(per_score, "s", ["neg"], range_rows=range_rows)
    hit = F.col("s") > threshold

    def total(c: str, when=None):
        v = F.col(c) if when is None else F.when(when, F.col(c)).otherwise(0)
        return F.coalesce(F.sum(v), F.lit(0)).cast("bigint")

    sums = ranked.agg(
        total("pos", hit).alias("tp"),
        total("neg", hit).alias("fp"),
        total("neg", ~hit).alias("tn"),
        total("pos", ~hit).alias("fn"),
        F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2)).alias("u"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    return sums.select(
        (tp + fp + tn + fn).alias("test_size"),
        F.try_divide(F.col("u"), (tp + fn).cast("double") * (fp + tn).cast("double")).alias("auc"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "tp", "fp", "tn", "fn",
    )


def ref_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows ``(column, mean, std, min, max)`` from one aggregate."""
    exprs, cells = [], []
    for i, c in enumerate(cols):
        v = clean_double(F.col(c))
        exprs += [F.avg(v).alias(f"a{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
        cells.append(f"'{c}', a{i}, s{i}, l{i}, h{i}")
    return df.agg(*exprs).select(
        F.expr(f"stack({len(cols)}, {', '.join(cells)}) AS (`column`, `mean`, `std`, `min`, `max`)")
    )


def _value_counts(df: DataFrame, cols: list[str], side: str) -> DataFrame:
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), clean_double(F.col(c)).alias("v")) for c in cols])).alias("x")
    ).select("x.*")
    counts = long.where("v IS NOT NULL").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    return counts.select(
        "column", "v",
        (n if side == "ref" else zero).alias("n_ref"),
        (n if side == "cur" else zero).alias("n_cur"),
    )


def drift_ks(reference: DataFrame, current: DataFrame, cols: list[str] | None = None, alpha: float = ALPHA,
             range_rows: int = RANGE_ROWS, exact_size: int = EXACT_SIZE) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov per shared column: ``(column, statistic, p_value, drift_detected)``; the p-value is
    exact for samples of up to ``exact_size`` values."""
    cols = cols or [c for c in reference.columns if c in current.columns]
    both = union_all(_value_counts(reference, cols, "ref"), _value_counts(current, cols, "cur"))
    per_value = both.groupBy("column", "v").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    ranked = running_totals(per_value, "v", ["n_ref", "n_cur"], "column", range_rows)
    gap = F.abs(F.try_divide("cum_n_ref", "total_n_ref") - F.try_divide("cum_n_cur", "total_n_cur"))
    worst = ranked.groupBy("column").agg(
        F.max(gap).alias("statistic"), F.max("total_n_ref").alias("t_ref"), F.max("total_n_cur").alias("t_cur")
    )
    p = ks_test_p(F.col("statistic"), F.col("t_ref").cast("double"), F.col("t_cur").cast("double"), exact_size)
    return worst.withColumn("p_value", p).select(
        "column", "statistic", "p_value", (F.col("p_value") < alpha).alias("drift_detected")
    )


def any_drift(report: DataFrame) -> bool:
    return not report.where("drift_detected").isEmpty()


def drift_predictions(reference: DataFrame, current: DataFrame, score: str, alpha: float = ALPHA) -> DataFrame:
    """The same test on a prediction column."""
    return drift_ks(reference.select(score), current.select(score), [score], alpha)


def accuracy(report: DataFrame) -> DataFrame:
    """Share of right predictions in percent, from an ``eval_binary`` row."""
    right = reduce(lambda a, b: a + b, [F.col("tp"), F.col("tn")])
    return report.select((F.try_divide(right, F.col("test_size")) * 100).alias("model_accuracy"))
