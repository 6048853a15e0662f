"""Hard negatives of anchor vectors by exact integer scores.

Vectors become integers, ``floor(scale * x)``, and a score is the integer inner product with the
anchor. Anchors and candidates are dealt over a grid of cells; a cell multiplies its tile of anchors with
tiles of candidates by Strassen's recursion: odd sides are padded with zeros, sums and differences
of the quarters are int64, and a leaf is multiplied in doubles only where all its partial sums are proven below 2^53
(else in int64), so every score is exact.

Two passes over the grid. The first keeps a heap of the best ``positives`` rows of the anchor's label,
which fixes a window of scores for each of them; the second keeps a heap of the best ``negatives`` rows of other
labels in every window. A task keeps one heap for an anchor (and window) over all its tiles; heaps of
different cells are merged ``FAN_IN`` at a time, so no group holds more than ``FAN_IN`` heaps however many rows there
are, and nothing but heaps leaves a cell.

Edge cases: rows with a null vec_id, label or vector, or with a null or non-finite component, take no part, nor do rows
whose scores could overflow a long (dimension times the largest squared component of 2^63 or more); vectors of
different lengths are never compared, and empty ones score 0 with each other. Ties go to the smaller
vec_id. Rows that repeat a vec_id are rows of their own: each is an anchor if one is, and each can be a positive or negative.
An anchor without another row of its label, or without rows in a window, gives no row; an empty table gives none.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import partitions, store

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
WINDOW = (0.3, 0.9)
TENTHS = 10  # window ends are counted in tenths of the positive's score
ANCHOR_PART = CANDIDATE_PART = 4096  # rows of a cell's sides, about
TILE = 1024  # candidates multiplied at a time
LEAF = 32  # a side this short ends the recursion
FAN_IN = 64
EXACT = 1 << 53


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.size and b.size:
        # In Python's integers, which can't overflow.
        bound = a.shape[1] * max(abs(int(a.min())), int(a.max())) * max(abs(int(b.min())), int(b.max()))
        if bound < EXACT:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _even(x: np.ndarray) -> np.ndarray:
    m, n = x.shape
    return np.pad(x, ((0, m % 2), (0, n % 2))) if m % 2 or n % 2 else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices; exact wherever it fits in int64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= max(leaf, 1):
        return _leaf(a, b)
    a, b = _even(a), _even(b)
    (i, j), l = (s // 2 for s in a.shape), b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best ``size`` entries (score, id) of each of ``n`` owners, kept sorted; merged with new entries in bulk."""

    def __init__(self, n: int, size: int):
        self.n, self.size = n, size
        self.owner, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.worst = np.full(n, np.iinfo(np.int64).min)  # below this score nothing enters

    def push(self, owner: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, id_ = (np.concatenate(x) for x in
                             ((self.owner, owner), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, owner))
        owner, score, id_ = owner[order], score[order], id_[order]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.append(first, len(owner)))
        place = np.arange(len(owner)) - np.repeat(first, counts)
        keep = place < self.size
        full = counts >= self.size
        self.worst[owner[first[full]]] = score[first[full] + self.size - 1]
        self.owner, self.score, self.id = owner[keep], score[keep], id_[keep]


def scaled(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, dim, vector as bytes of int64) of the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    # As a double this is right to 1 in 2^50, so one less bit than a long has is asked for.
    most = F.aggregate(x, F.lit(0.0), lambda m, c: F.greatest(m, F.abs(F.floor(F.lit(float(scale)) * c).cast("double"))))
    usable = df.where("vec_id is not null and label is not null and embedding is not null").where(~F.exists(x, bad))
    usable = usable.where(most * most * F.size("embedding") < float(1 << 62))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [np.floor(scale * np.asarray(v, np.float64)).astype("<i8") for v in batch["embedding"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"],
                                "dim": np.array([len(v) for v in raw], np.int32), "vector": [v.tobytes() for v in raw]})

    flat = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                         x.alias("embedding"))
    return flat.mapInPandas(run, "vec_id bigint, label bigint, dim int, vector binary").withColumn(
        "row", F.monotonically_increasing_id())


def _matrix(rows: pd.DataFrame, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows["vector"]), "<i8").reshape(len(rows), dim)


def _grid(anchors: DataFrame, candidates: DataFrame, anchor_parts: int, candidate_parts: int) -> DataFrame:
    """Both sides dealt over the cells (dim, ap, cp), anchors first in each."""
    spark = anchors.sparkSession
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"side": F.lit(0), "ap": part(anchor_parts)}).withColumn("cp", every(candidate_parts))
    right = candidates.withColumns({"side": F.lit(1), "cp": part(candidate_parts)}).withColumn("ap", every(anchor_parts))
    cells = left.unionByName(right, allowMissingColumns=True)
    return cells.repartition(partitions(spark), "dim", "ap", "cp").sortWithinPartitions("dim", "ap", "cp", "side", "row")


def _window(found: np.ndarray, ends: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole score from ``ends[0]`` to ``ends[1]`` tenths of ``found``; by quotient and rest, so that
    nothing overflows."""
    whole, rest = found // TENTHS, found % TENTHS
    return ends[0] * whole - (-ends[0] * rest) // TENTHS, ends[1] * whole + ends[1] * rest // TENTHS


def _heaps_of(cells: DataFrame, size: int, ends: tuple[int, int] | None, tile: int, leaf: int) -> DataFrame:
    """(row, slot, part, heap) of the anchors of every cell. Without ``ends``: one heap of rows of the anchor's
    label. With them: for each score in ``found`` a heap of rows of other labels in its window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, anchors, held, heaps, a, lo, hi = None, [], None, None, None, None, None

        def out() -> Iterator[pd.DataFrame]:
            if heaps is None:
                return
            for slot, h in enumerate(heaps):
                owners, first = np.unique(h.owner, return_index=True)
                if len(owners):
                    ends = np.append(first[1:], len(h.owner))
                    entries = [[{"neg": -s, "id": i} for s, i in zip(h.score[b:e].tolist(), h.id[b:e].tolist())]
                               for b, e in zip(first.tolist(), ends.tolist())]
                    yield pd.DataFrame({"row": held["row"].to_numpy()[owners], "slot": np.int32(slot), "part": np.int64(key[2]),
                                        "heap": entries})

        def begin() -> None:
            nonlocal held, heaps, a, lo, hi
            held = pd.concat(anchors, ignore_index=True)
            a, slots = _matrix(held, key[0]), 1
            if ends:
                slots = max(map(len, held["found"]))
                # Anchors with fewer positives than others get windows that hold no score.
                lo, hi = np.ones((slots, len(held)), np.int64), np.zeros((slots, len(held)), np.int64)
                for i, found in enumerate(held["found"]):
                    lo[: len(found), i], hi[: len(found), i] = _window(np.asarray(found, np.int64), ends)
            heaps = [Heaps(len(held), size) for _ in range(slots)]

        def meet(rows: pd.DataFrame) -> None:
            label, own = held["label"].to_numpy(), held["row"].to_numpy()
            for at in range(0, len(rows), tile):
                some = rows.iloc[at: at + tile]
                ids, their = some["vec_id"].to_numpy(), some["label"].to_numpy()
                score = strassen(a, _matrix(some, key[0]).T, leaf)
                same = label[:, None] == their
                for slot, h in enumerate(heaps):
                    if ends:
                        open_ = ~same & (score >= np.maximum(lo[slot], h.worst)[:, None]) & (score <= hi[slot][:, None])
                    else:
                        open_ = same & (score >= h.worst[:, None]) & (own[:, None] != some["row"].to_numpy())
                    i, j = np.nonzero(open_)
                    h.push(i, score[i, j], ids[j])

        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["dim", "ap", "cp"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for piece in np.split(np.arange(len(batch)), cuts):
                now = tuple(keys[piece[0]].tolist())
                if now != key:
                    yield from out()
                    key, anchors, held, heaps = now, [], None, None
                rows = batch.iloc[piece]
                side = rows["side"].to_numpy()
                if (side == 0).any():
                    anchors.append(rows[side == 0])
                rows = rows[side == 1]
                if len(rows) and anchors:
                    if heaps is None:
                        begin()
                    meet(rows)
        yield from out()

    return cells.mapInPandas(run, "row bigint, slot int, part bigint, heap array<struct<neg: bigint, id: bigint>>")


def merged(heaps: DataFrame, size: int, parts: int, fan_in: int = FAN_IN) -> DataFrame:
    """(row, slot, heap): heaps of all parts merged ``fan_in`` at a time."""
    while parts > 1:
        parts = -(-parts // fan_in)
        best = F.slice(F.array_sort(F.flatten(F.collect_list("heap"))), 1, size)
        heaps = heaps.withColumn("part", F.floor(F.col("part") / fan_in)).groupBy("row", "slot", "part").agg(best.alias("heap"))
    return heaps.select("row", "slot", "heap")


def mine(df: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[float, float] = WINDOW, scale: int = SCALE, anchor_part: int = ANCHOR_PART,
         candidate_part: int = CANDIDATE_PART, tile: int = TILE, leaf: int = LEAF) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``df (vec_id, label, embedding)``;
    ``is_anchor`` is an expression over vec_id and label. The window is from ``window[0]`` to ``window[1]`` times the
    positive's score, both in whole tenths."""
    base = store(scaled(df, scale), "scaled-vectors")
    anchors = base.where(is_anchor)
    anchor_parts = max(1, -(-anchors.count() // anchor_part))
    candidate_parts = max(1, -(-base.count() // candidate_part))

    cells = _grid(anchors, base, anchor_parts, candidate_parts)
    best = store(merged(_heaps_of(cells, positives, None, tile, leaf), positives, candidate_parts).select("row", "heap"),
                 "positives")
    sought = anchors.join(best.select("row", F.transform("heap", lambda h: -h["neg"]).alias("found")), "row")
    ends = (round(window[0] * TENTHS), round(window[1] * TENTHS))
    cells = _grid(sought, base, anchor_parts, candidate_parts)
    worst = merged(_heaps_of(cells, negatives, ends, tile, leaf), negatives, candidate_parts)

    named = anchors.select("row", F.col("vec_id").alias("anchor_id")).join(best, "row").select(
        "row", "anchor_id", F.posexplode("heap").alias("slot", "p"))
    return named.join(worst, ["row", "slot"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), (-F.col("p.neg")).alias("positive_score"),
        F.posexplode("heap").alias("at", "n"),
    ).select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("negative_id"),
             "positive_score", (-F.col("n.neg")).alias("negative_score"))
