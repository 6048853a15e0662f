"""Near-duplicate embeddings by random-hyperplane signs in several tables.

Two unit vectors at angle a fall on one side of a random hyperplane with probability 1 - a / pi. A
table's key is ``bits`` such signs; bits grow with the logarithm of the number of vectors, so buckets
keep their size, and the number of tables follows from the recall asked for at the threshold.
Vectors of a bucket are compared exactly, in double precision and in blocks of bounded size. A pair
met in several tables is counted in the first one whose keys agree, which both signatures tell, so
links are counted without listing or de-duplicating pairs, and each task returns counts and a
spanning forest: a cluster of n vectors gives n rows and not n^2. Buckets with very many vectors are
dealt over pairs of parts.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows with a null
label or vec_id, link with nothing and are a component of their own; vectors of different lengths are
never compared; equal vectors meet once, as a class with a count; rows that repeat a vec_id are rows of
their own; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, partitions, store

THRESHOLD = 0.93
RECALL = 0.995  # of pairs right at the threshold; closer pairs are found more surely
BUCKET = 64  # vectors a bucket holds if all directions are alike
PART = 1024  # vectors of a hot bucket that one side of a comparison holds
SEED = 11


def plan_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = max(4, math.ceil(math.log2(max(n, 1) / BUCKET))) if n > BUCKET else 4
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _planes(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def _unit(rows: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def vectors(df: DataFrame) -> DataFrame:
    """(vec_id, label, dim, k1, k2, vector as bytes of doubles) of the vectors that may link."""
    usable, x = df.where(_usable()), F.transform("embedding", lambda c: c.cast("double"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [np.asarray(v, "<f8") for v in batch["embedding"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "dim": [len(v) for v in raw],
                                "vector": [v.tobytes() for v in raw]})

    kind = dict(df.dtypes)["label"]
    flat = usable.select("vec_id", "label", x.alias("embedding")).mapInPandas(
        run, f"vec_id bigint, label {kind}, dim int, vector binary")
    return flat.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), "vector")})


def signed(classes: DataFrame, bits: int, tables: int, seed: int = SEED) -> DataFrame:
    """``classes`` with ``signs``: the key of every table."""
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            signs = np.empty(len(batch), object)
            for dim, at in batch.groupby("dim").indices.items():
                side = _unit([batch["vector"].iat[i] for i in at]) @ _planes(dim, bits * tables, seed) > 0
                keys = (side.reshape(len(at), tables, bits) @ weights).astype(np.int64)
                for i, row in zip(at, keys):
                    signs[i] = row
            yield batch.assign(signs=signs)

    schema = ", ".join(f"{c} {t}" for c, t in classes.dtypes) + ", signs array<bigint>"
    return classes.mapInPandas(run, schema)


class _Forest:
    """Spanning forest of the links of one task."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = self.find(x), self.find(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                self.links.append((x, y))


def _compare(group: pd.DataFrame, threshold: float, forest: _Forest, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """All pairs of one bucket, or of the two parts of it that meet in one cell."""
    if len(group) < 2:
        return
    ids, copies = group["id"].to_numpy(), group["copies"].to_numpy()
    part, table = group["part"].to_numpy(), int(group["at"].iat[0])
    v, signs = _unit(group["vector"].tolist()), np.stack(group["signs"].tolist())[:, :table]
    mixed = part.min() != part.max()  # then only pairs across; each part alone has its own cell
    seen = np.zeros(len(ids), np.int64)
    step = max(1, (1 << 21) // len(ids))
    for at in range(0, len(ids), step):
        close = v[at: at + step] @ v.T >= threshold
        i, j = np.nonzero(close)
        i += at
        keep = i < j
        if mixed:
            keep &= part[i] != part[j]
        i, j = i[keep], j[keep]
        fresh = np.ones(len(i), bool)
        for t in range(table):  # met in an earlier table already
            fresh &= signs[i, t] != signs[j, t]
        i, j = i[fresh], j[fresh]
        np.add.at(seen, i, copies[j])
        np.add.at(seen, j, copies[i])
        # One link per vector and block at least, all that differ in component: enough to connect.
        forest.add(ids[i], ids[j])
    counts.append((ids[seen > 0], seen[seen > 0]))


def links(classes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED,
          part: int = PART) -> DataFrame:
    """Rows (a, b, null): links that connect what is connected, and (a, null, n): other vectors
    linked with class ``a`` directly, to be summed. ``classes`` has id, label, dim, copies, vector."""
    spark = classes.sparkSession
    bits, tables = plan_tables(classes.count(), threshold, recall)
    coded = store(signed(classes, bits, tables, seed), "signs")
    bucket = ["label", "dim", "at", "sign"]
    rows = coded.select("id", "label", "dim", "copies", "vector", "signs", F.posexplode("signs").alias("at", "sign"))
    hot = store(rows.groupBy(*bucket).count().where(F.col("count") > part)
                .select(*bucket, F.ceil(F.col("count") / part).cast("int").alias("parts")), "hot-buckets")
    rows = rows.join(hot, bucket, "left")
    own = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    cells = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.least(j, F.col("part")) * F.col("parts") + F.greatest(j, F.col("part"))))
    rows = rows.withColumn("part", own).select(*bucket, "id", "copies", "vector", "signs", "part",
                                               F.explode(cells).alias("cell"))
    rows = rows.repartition(partitions(spark), *bucket, "cell").sortWithinPartitions(*bucket, "cell")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, counts, held = _Forest(), [], None

        def rest(frames: pd.DataFrame) -> None:
            for _, group in frames.groupby([*bucket, "cell"], sort=False):
                _compare(group, threshold, forest, counts)

        for batch in batches:
            if not len(batch):
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = held[[*bucket, "cell"]]
            last = (keys == keys.iloc[-1]).all(axis=1).to_numpy()
            cut = int(np.argmax(last))  # the last group may go on in the next batch
            rest(held.iloc[:cut])
            held = held.iloc[cut:]
        if held is not None:
            rest(held)
        if forest.links:
            a, b = zip(*forest.links)
            yield pd.DataFrame({"a": a, "b": pd.array(b, "Int64"), "n": pd.array([None] * len(a), "Int64")})
        if counts:
            a, n = (np.concatenate(x) for x in zip(*counts))
            total = pd.Series(n).groupby(a).sum()
            yield pd.DataFrame({"a": total.index, "b": pd.array([None] * len(total), "Int64"), "n": total.to_numpy()})

    return rows.mapInPandas(run, "a bigint, b bigint, n bigint")


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    flat = store(vectors(df), "vectors")
    key = ["label", "dim", "k1", "k2"]
    classes = store(
        flat.groupBy(*key).agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
                               F.first("vector").alias("vector"))
        .withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    found = store(links(classes.select("id", "label", "dim", "copies", "vector"), threshold, recall, seed), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    joined = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    named = classes.select(*key, "id", "least", "copies").join(counts, "id", "left").join(joined, "id", "left")
    named = store(named.select(*key, "least", F.coalesce("component", "id").alias("root"),
                               (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(named.join(least, "root").drop("root", "least"), "named-components")
    linked = flat.select("vec_id", *key).join(named, key).select("vec_id", "n_links", "component_id")
    alone = df.where(~_usable()).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").cast("bigint").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _usable():
    """Never null: true for vectors that may link."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & ~F.exists(x, bad) & F.exists(x, lambda c: F.coalesce(c != 0.0, F.lit(False))), F.lit(False))
