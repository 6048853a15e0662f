"""Training data, random forests, and scoring for the three use cases."""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.contracts import Contract
from ledgerlake.functions.stats import clean_double
from ledgerlake.operators.gold import churn_segment
from ledgerlake.session import instant, stored


@dataclass(frozen=True)
class ForestSpec:
    features: tuple[str, ...]
    label: str
    trees: int
    min_leaf: int
    max_depth: int
    threshold: float
    balanced: bool = False
    seed: int = 42


# Features, tree counts, leaf sizes and thresholds of the three models. Depth is
# given upstream only for the credit model; the other two grow without a limit there, here to MLlib's own
# limit.
DEEPEST = 30
FRAUD = ForestSpec(("tx_velocity_1m", "geo_distance_km", "device_entropy"), "is_fraud", 100, 1, DEEPEST, 0.5)
CREDIT = ForestSpec(("missed_ratio", "last_missed", "balance_volatility", "delinquency_trends"), "is_default",
                    50, 50, 10, 0.5)
CHURN = ForestSpec(("transaction_decay", "login_inactivity", "complaint_frequency"), "churned", 100, 10, DEEPEST, 0.3,
                   balanced=True)


def encode_repayment(df: DataFrame, history: str = "repayment_history") -> DataFrame:
    """A forest needs numbers: share of missed payments in the history, and whether the last was missed."""
    missed = F.size(F.filter(history, lambda s: s == "missed"))
    return df.withColumns(
        {
            "missed_ratio": F.coalesce(F.try_divide(missed, F.size(history)), F.lit(0.0)),
            "last_missed": F.coalesce((F.try_element_at(F.col(history), F.lit(-1)) == "missed").cast("double"), F.lit(0.0)),
        }
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``n / (classes * n_class)`` per class; one row per class."""
    per_class = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # over the classes, not over the rows
    total, classes = F.sum("n").over(every), F.count(F.lit(1)).over(every)
    return per_class.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def _complete(features: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for c in features:
        ok = ok & clean_double(F.col(c)).isNotNull()
    return ok


BINS = 32  # of a feature: what MLlib's own trees look at
FITS = 16  # trees grown at the same time
CELLS_AT_ONCE = 1 << 16  # in a task of a fit: a tree is many short jobs, and different trees run beside each other


def _edges(rows: DataFrame, features: tuple[str, ...]) -> list[list[float]]:
    """Where each feature is cut: between its values if they are few, else at quantiles of all rows."""
    every = rows.approxQuantile(list(features), [i / BINS for i in range(1, BINS)], 1 / (BINS * BINS))
    out = []
    for c, quantiles in zip(features, every):
        values = sorted(r[0] for r in rows.select(F.col(c).cast("double")).distinct().limit(BINS + 1).collect())
        if len(values) <= BINS:
            cuts = {(x + y) / 2 for x, y in zip(values, values[1:])}
        else:
            cuts = {math.nextafter(q, math.inf) for q in quantiles}  # a value is below its own cut
        out.append([-math.inf, *(sorted(cuts) or [0.0]), math.inf])
    return out


def _buckets(features: tuple[str, ...]) -> list[str]:
    return [f"__bucket_{c}" for c in features]


def _bagged(cells: DataFrame, columns: list[str], trees: int, seed: int) -> DataFrame:
    """``cells`` with how often each tree's bootstrap draws their rows: ``n`` rows together are drawn a Poisson number of
    times with mean ``n``. Draws depend on the seed and the cell alone."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch[columns].to_numpy(np.int64).tolist()
            bags = [np.random.default_rng([seed, *k]).poisson(n, trees) for k, n in zip(keys, batch["n"])]
            yield batch.drop(columns="n").assign(bags=bags)

    return cells.mapInPandas(draw, ", ".join(f"`{c}` double" for c in columns) + ", bags array<bigint>")


def _forest(trees: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of forests with one tree each; MLlib joins no models, so its constructor is called."""
    context = SparkContext.getOrCreate()
    classes = context._jvm.org.apache.spark.ml.classification
    each = context._gateway.new_array(classes.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        each[i] = t._java_obj.trees()[0]
    joined = classes.RandomForestClassificationModel(trees[0].uid, each, trees[0].numFeatures, trees[0].numClasses)
    joined.set(joined.getParam("numTrees"), len(trees))
    return RandomForestClassificationModel(joined).setFeaturesCol("features_vector")


def train_counted(rows: DataFrame, spec: ForestSpec) -> PipelineModel:
    """The forest of complete rows with a ``__label``, grown on counts. Trees see features by ``BINS`` bins only, so rows
    alike in bins and label are one cell with a count, and each tree's bootstrap draws counts of cells. The number of cells does
    not grow with the rows; these are read to find the bins and to count."""
    rows = stored(rows, "training-rows")  # read for the bins of each feature and for the counts
    buckets = _buckets(spec.features)
    bucketizer = Bucketizer(inputCols=list(spec.features), outputCols=buckets, splitsArray=_edges(rows, spec.features), handleInvalid="keep")
    # "keep" lets scoring see incomplete rows, which it must answer rather than drop
    assembler = VectorAssembler(inputCols=buckets, outputCol="features_vector", handleInvalid="keep")
    columns, weights = [*buckets, "__label"], [f"__weight_{i}" for i in range(spec.trees)]
    cells = bucketizer.transform(rows).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    # A column for each tree, so that a fit reads its own alone.
    drawn = [F.col("bags")[i].cast("double").alias(w) for i, w in enumerate(weights)]
    bagged = stored(_bagged(cells, columns, spec.trees, spec.seed).select(*columns, *drawn), "cells")
    n_cells, *draws = bagged.select(F.count(F.lit(1)), *[F.coalesce(F.sum(w), F.lit(0.0)) for w in weights]).first()
    parts = -(-n_cells // CELLS_AT_ONCE) or 1

    def grow(i: int) -> RandomForestClassificationModel:
        # MLlib counts a cell as one row, so the least number of rows in a leaf is asked of their weight.
        enough = draws[i] >= 2 * spec.min_leaf
        tree = RandomForestClassifier(
            featuresCol="features_vector", labelCol="__label", weightCol="__weight", numTrees=1, bootstrap=False,
            maxBins=256,  # every bin is found among up to 256 ** 2 cells
            maxDepth=spec.max_depth if enough else 0, minInstancesPerNode=1,
            minWeightFractionPerNode=(spec.min_leaf - 0.5) / draws[i] if enough else 0.0,
            featureSubsetStrategy="sqrt", seed=spec.seed + i)
        own = bagged.select(*columns, F.col(weights[i]).alias("__weight"))
        return tree.fit(assembler.transform(own).select("features_vector", "__label", "__weight").coalesce(parts))

    with ThreadPoolExecutor(FITS) as pool:
        trees = list(pool.map(grow, range(spec.trees)))
    return PipelineModel(stages=[bucketizer, assembler, _forest(trees)])


def train(df: DataFrame, spec: ForestSpec) -> PipelineModel:
    """Fit on the complete rows. All passes are distributed; only the trees come to the driver."""
    rows = df.where(_complete(spec.features) & F.col(spec.label).isNotNull())
    rows = rows.withColumn("__label", F.col(spec.label).cast("double"))
    if not spec.balanced:
        return train_counted(rows.select(*spec.features, "__label"), spec)
    # Weights of classes are no counts of rows, of which a leaf must hold so many: these forests are grown on rows.
    forest = RandomForestClassifier(
        featuresCol="features_vector", labelCol="__label", numTrees=spec.trees, maxDepth=spec.max_depth,
        minInstancesPerNode=spec.min_leaf, featureSubsetStrategy="sqrt", seed=spec.seed,
    )
    weights = class_weights(rows, "__label").select("__label", F.col("weight").alias("__weight"))
    rows = rows.join(F.broadcast(weights), "__label")  # one row per class
    forest = forest.setWeightCol("__weight")
    # "keep" lets scoring see incomplete rows, which it must answer rather than drop
    assembler = VectorAssembler(inputCols=list(spec.features), outputCol="features_vector", handleInvalid="keep")
    return Pipeline(stages=[assembler, forest]).fit(rows.select(*spec.features, "__label", "__weight"))


def save_model(model: PipelineModel, root: str, version: str) -> str:
    path = f"{root.rstrip('/')}/{version}"
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


SCORED_AT_ONCE = 1 << 12  # cells that a task scores; it reads the whole forest


def cell_scores(model: PipelineModel, spec: ForestSpec) -> DataFrame | None:
    """What a forest on bins gives each of its cells, as a stored table: ``BINS`` to the power of the features are the most
    there are, however many rows will be scored. None for a forest on rows."""
    if not isinstance(model.stages[0], Bucketizer):
        return None
    spark, buckets = SparkSession.active(), _buckets(spec.features)
    sizes = [len(edges) - 1 for edges in model.stages[0].getSplitsArray()]
    total = math.prod(sizes)
    cells, step = spark.range(0, total, 1, -(-total // SCORED_AT_ONCE)), 1
    for bucket, size in zip(buckets, sizes):
        cells = cells.withColumn(bucket, F.expr(f"CAST((id DIV {step}) % {size} AS DOUBLE)"))
        step *= size
    scored = PipelineModel(stages=model.stages[1:]).transform(cells)
    return stored(scored.select(*buckets, F.get(vector_to_array(F.col("probability")), F.lit(1)).alias("__p")), "cell-scores")


def probability(model: PipelineModel, df: DataFrame, spec: ForestSpec, out: str, cells: DataFrame | None = None) -> DataFrame:
    """Add the probability of the positive class; null where a feature is missing. Forests on bins score their cells once
    and rows look their cell up, so no task over rows holds a forest; ``cells`` are those scores, where they are at hand."""
    if cells is None:
        cells = cell_scores(model, spec)
    if cells is not None:
        # A row for each cell at most. Incomplete rows have none.
        scored = model.stages[0].transform(df).join(F.broadcast(cells), _buckets(spec.features), "left")
        return scored.withColumn(out, F.when(_complete(spec.features), F.col("__p"))).drop("__p", *_buckets(spec.features))
    p = vector_to_array(F.col("probability"))
    scored = model.transform(df)
    return scored.withColumn(out, F.when(_complete(spec.features), F.get(p, F.lit(1)))).drop(
        "features_vector", "rawPrediction", "probability", "prediction"
    )


def fraud_decision(score: Column) -> Column:
    """Unrounded score to a decision; no score means allow (fail open)."""
    return F.when(score >= 0.85, "block").when(score >= 0.5, "challenge").otherwise("allow")


def risk_band(score: Column) -> Column:
    return F.when(score >= 0.5, "high").when(score >= 0.2, "medium").otherwise("low")


def decide(scores: DataFrame, score: str = "fraud_score") -> DataFrame:
    s = clean_double(F.col(score))
    return scores.withColumns(
        {
            "decision": fraud_decision(s),
            "error": F.when(s.isNull(), F.lit("incomplete features")),
            score: F.round(s, 4),
        }
    )


def _stamped(df: DataFrame, version: str, scored_at) -> DataFrame:
    return df.withColumns({"model_version": F.lit(version), "scored_at": instant(scored_at)})


def score_fraud(features: DataFrame, model: PipelineModel, version: str, scored_at, cells: DataFrame | None = None) -> DataFrame:
    scored = decide(probability(model, features, FRAUD, "fraud_score", cells))
    return _stamped(scored, version, scored_at).select(
        "transaction_id", "fraud_score", "decision", "error", "model_version", "scored_at"
    )


def band_scores(scores: DataFrame, score: str = "pd_score") -> DataFrame:
    """A missing score has no band: it is not a low risk."""
    s = clean_double(F.col(score))
    return scores.withColumn("risk_band", F.when(s.isNotNull(), risk_band(s)))


def segment_scores(scores: DataFrame, score: str = "churn_probability") -> DataFrame:
    s = clean_double(F.col(score))
    return scores.withColumn("segment", F.when(s.isNotNull(), churn_segment(s)))


def score_credit(features: DataFrame, model: PipelineModel, version: str, scored_at) -> DataFrame:
    """Every account row is answered; one without a volatility yet has no score."""
    scored = band_scores(probability(model, encode_repayment(features), CREDIT, "pd_score"))
    return _stamped(scored, version, scored_at).select(
        "account_id", "pd_score", "risk_band", "model_version", "scored_at"
    )


def score_churn(features: DataFrame, model: PipelineModel, version: str, scored_at) -> DataFrame:
    scored = segment_scores(probability(model, features, CHURN, "churn_probability"))
    return _stamped(scored, version, scored_at).select(
        "customer_id", "churn_probability", "segment", "model_version", "scored_at"
    )


def score_to_fact(scored: DataFrame, contract: Contract, renames: dict[str, str], score: str) -> DataFrame:
    """Scorer output to a fact contract. Confidence is the distance from a coin toss, max(p, 1-p)."""
    p = F.col(score)
    df = scored.withColumn("confidence", F.greatest(p, 1 - p))
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    df = df.withColumn("created_at", F.col("event_time"))
    df = df.withColumn("data_source", F.lit(contract.defaults["data_source"]))
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in contract.types.items()])


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and content hash, independent of row order and partitioning: the sum of 60 bits of each row's MD5
    over its columns by name. Equal rows count as often as they occur."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns)]
    h = F.conv(F.substring(F.md5(F.concat_ws("\x01", *cells)), 1, 15), 16, 10)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(20,0)")).cast("string").alias("content_hash"))
