"""Near copies by exact Jaccard similarity of word shingles.

Two texts link if the sets of their shingles have a Jaccard similarity of ``least`` or more. If they do, the
first ``n - ceil(least * n) + 1`` shingles of both sets, in one order for all texts, have one in common (prefix
filtering), so texts that share such a shingle are the candidates, and none is missed. The order is that of hashes, with
frequent shingles last, the more frequent the later, so that passages which many texts share make no candidates. How frequent
a shingle is, is told by a table of ``BUCKETS`` counts over hashes of all shingles, of the same size for any
corpus: a rare shingle that shares a bucket goes later than it need, which changes how many candidates there are, not which texts link.

* Texts are shingled twice: once to count shingles, once to store each text's first shingles in the final order.
  Copies of a text within a task are recognised at once and store none; equal texts of different tasks are linked by two hashes.
* Fingerprints of the same shingles, the operator of ``simhash``, come first: those within its bits, found by its pigeonring chains, are
  compared as whole sets, and what is similar is connected. That finds the closest copies, not all: at the least similarity
  fingerprints differ in about 10 bits, which is no selective key.
* What follows finds all others. First shingles that no other, unconnected text has are dropped after one pass over all.
* Of the texts with one shingle, in windows of sizes that could be similar, the one of the least seeded hash is the *hub* of those
  not connected with it. Each text is compared with the hub it shares most first shingles with, which connects large groups
  by one comparison a text. This is done again with other hubs, for the texts that still meet unconnected ones,
  as long as it connects any, ``TURNS`` times at most.
* All pairs with a common first shingle that are not connected then and were not compared follow, if the sizes of their
  sets, the places of their common shingles and two bitmaps leave room for the similarity. A bitmap has the parity of how many shingles
  fall on each bit, so that two differ in no more bits than the sets have shingles apart: no pair is lost by it.
* A comparison takes whole sets. Texts travel once to their hub's task, not once a pair.

Shingles of more than ``PART`` texts are dealt over several tasks: first with a hub in each and then among these hubs, later
over a square of cells; so are hubs with many texts. No list of texts, links or shingles grows on the driver.

``docs`` is read several times and must hold the same texts each time, as a table does. Texts are found again by their two
hashes, so it does not matter how their rows are dealt; a text that is missing is an error.

Edge cases: equal texts are one text from the start; fewer words than a shingle make one shingle of them all; null,
empty and blank texts are copies of each other; texts of any length are shingled whole. Rows without a doc_id are linked like others
and never name a component, unless no row of it has an id (then null). Rows that repeat a doc_id are rows of their own; of each
component one row is ``kept``: that of the least doc_id, the first of them where it is repeated. An empty table gives
no row; extra columns are ignored.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, discard, partitions, store
from ledgerlake.llm.simhash import majority, near_links

SHINGLE = 5
LEAST = 0.8
HOT = 8  # texts of a shingle beyond what its bucket holds anyway; with more it goes later in the order
BITS = 21
BUCKETS = 1 << BITS
PART = 2048  # texts of one shingle, or of one hub, that a task gets
HELD = 1 << 18  # pairs a task holds before it hands them on
PAIRS = 1 << 18  # pairs tried at a time
TURNS = 2  # of hubs, after the fingerprints and before all pairs that are left
BITMAP = 512  # bits, a multiple of 64


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(body, 42)], np.uint64)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(body[i:j], 42) for i, j in zip(starts, ends[shingle - 1:].tolist())], np.uint64))


def first_length(n: int, least: float) -> int:
    # Rounded down by a hair: a fraction like 0.8 * 5 must not come out as 4.0000001.
    return n - math.ceil(least * n - 1e-9) + 1


def parities(found: np.ndarray) -> bytes:
    """Of how many hashes fall on each bit of a bitmap."""
    counts = np.bincount((found % np.uint64(BITMAP)).astype(np.int64), minlength=BITMAP)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _numbered(docs: DataFrame, text: str) -> DataFrame:
    """(rid, doc_id, text, k1, k2): rows with a number and two hashes of the text."""
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid"))
    return rows.withColumns(text_keys())


class Frequencies:
    """Counts of hashed shingles, and what follows from them: the order of shingles and how many tasks share one."""

    def __init__(self, counts: np.ndarray, hot: int):
        self.counts, self.part = counts, PART
        self.usual = float(counts.mean())
        # What a bucket of rare shingles only will hardly have.
        self.bound = self.usual + 4.0 * math.sqrt(self.usual) + hot

    def _own(self, token: np.ndarray) -> np.ndarray:
        return self.counts[(token >> np.uint64(64 - BITS)).astype(np.int64)]

    def ordered(self, found: np.ndarray) -> np.ndarray:
        """Sorted hashes in the common order: the rare ones, then by level of frequency."""
        count = self._own(found)
        level = np.where(count > self.bound, 1 + np.floor(2.0 * np.log2(np.maximum(count / self.bound, 1.0))), 0)
        return found[np.argsort(level, kind="stable")] if level.any() else found

    def ways(self, token: np.ndarray) -> np.ndarray:
        """How many tasks the texts of each shingle are dealt over."""
        count = self._own(token)
        return np.where(count > self.bound, np.maximum(1, np.ceil((count - self.usual) / self.part)), 1).astype(np.int64)


def frequencies(rows: DataFrame, shingle: int, hot: int) -> Frequencies:
    """Every different text of a task counts its different shingles."""
    pieces = 32

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = set(), np.zeros(BUCKETS, np.uint32)
        for batch in batches:
            for key, text in zip(zip(batch["k1"], batch["k2"]), batch["text"]):
                if key not in seen:
                    seen.add(key)
                    bucket = (shingles(text, shingle) >> np.uint64(64 - BITS)).astype(np.int64)
                    np.add.at(total, bucket, 1)
        # Byte planes compress better than numbers.
        parts = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in np.split(total, pieces)]
        yield pd.DataFrame({"piece": np.arange(pieces), "counts": parts})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch["piece"].tolist(), batch["counts"]):
                x = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)
                sums[piece] = sums[piece] + x if piece in sums else x
        yield pd.DataFrame({"piece": list(sums), "counts": [x.tobytes() for x in sums.values()]})

    schema = "piece int, counts binary"
    summed = rows.select("text", "k1", "k2").mapInPandas(count, schema).repartition(pieces, "piece").mapInPandas(add, schema)
    found = {r.piece: np.frombuffer(r.counts, np.int64) for r in summed.collect()}  # BUCKETS numbers, whatever the input
    empty = np.zeros(BUCKETS // pieces, np.int64)
    return Frequencies(np.concatenate([found.get(i, empty) for i in range(pieces)]), hot)


def signatures(rows: DataFrame, shingle: int, least: float, order: Broadcast) -> DataFrame:
    """(rid, doc_id, k1, k2, n, tokens, fp, bitmap): the size of each text's set, its first shingles in the common order, its
    fingerprint and parities; none for a copy of an earlier text of the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            sizes, tokens, fps, bitmaps = [], [], [], []
            for key, text in zip(zip(batch["k1"], batch["k2"]), batch["text"]):
                if key in seen:
                    sizes.append(0)
                    tokens.append(None)
                    fps.append(0)
                    bitmaps.append(None)
                    continue
                seen.add(key)
                found = shingles(text, shingle)
                fps.append(majority(found))
                bitmaps.append(parities(found))
                found = order.value.ordered(found)
                sizes.append(len(found))
                tokens.append(found[: first_length(len(found), least)].tobytes())
            yield batch.drop(columns="text").assign(doc_id=batch["doc_id"].astype("Int64"), n=np.array(sizes, np.int32), tokens=tokens,
                                                    fp=np.array(fps, np.uint64).view(np.int64), bitmap=bitmaps)

    rows = rows.select("rid", F.col("doc_id").cast("bigint").alias("doc_id"), "k1", "k2", "text")
    return rows.mapInPandas(run, "rid bigint, doc_id bigint, k1 bigint, k2 bigint, n int, tokens binary, fp bigint, bitmap binary")


def _whole(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``keys``, cut so that none ends inside a group of equal keys."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        k = held[keys].to_numpy()
        cut = int(np.argmax((k == k[-1]).all(axis=1)))
        if cut:
            yield held.iloc[:cut]
            held = held.iloc[cut:]
    if held is not None:
        yield held


def _groups(rows: pd.DataFrame, keys: list[str], least: int = 2) -> list[tuple[int, int]]:
    """(first, end) of the groups of so many rows or more."""
    k = rows[keys].to_numpy()
    edges = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]).any(axis=1), [True]]))
    many = np.flatnonzero(np.diff(edges) >= least)
    return list(zip(edges[many].tolist(), edges[many + 1].tolist()))


def _shared(sigs: DataFrame, order: Broadcast) -> DataFrame:
    """(token, rid, n, at): the first shingles that texts of different roots have in common, and all those of many texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            counts = np.array([len(t) // 8 for t in batch["tokens"]])
            token = np.frombuffer(b"".join(batch["tokens"]), np.uint64)
            of = np.repeat(np.arange(len(batch)), counts)
            rid = batch["rid"].to_numpy()[of]
            yield pd.DataFrame({
                "token": token.view(np.int64), "rid": rid, "n": batch["n"].to_numpy()[of],
                "at": (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32),
                "root": batch["root"].to_numpy()[of], "way": _way(rid, order.value.ways(token)).astype(np.int32)})

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole(batches, ["token", "way"]):
            token, way, root = (rows[c].to_numpy() for c in ("token", "way", "root"))
            first = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (way[1:] != way[:-1])]))
            use = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
            use |= order.value.ways(token[first].view(np.uint64)) > 1  # their other roots may be in another task
            yield rows.loc[np.repeat(use, np.diff(np.append(first, len(rows)))), ["token", "rid", "n", "at"]]

    schema = "token bigint, rid bigint, n int, at int"
    found = sigs.select("rid", "n", "tokens", "root").mapInPandas(run, schema + ", root bigint, way int")
    found = found.repartition(partitions(sigs.sparkSession), "token", "way").sortWithinPartitions("token", "way")
    return found.mapInPandas(keep, schema)


def _dealt(shared: DataFrame, order: Broadcast, square: bool) -> DataFrame:
    """``shared`` with (way, cell), dealt and sorted. A shingle of many texts has as many ways as it takes; with
    ``square`` its rows go to the cells of a triangle of pairs of ways instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = order.value.ways(batch["token"].to_numpy().view(np.uint64))
            way = _way(batch["rid"].to_numpy(), total)
            out = batch.assign(way=way.astype(np.int32))
            if square:
                repeat = np.repeat(np.arange(len(out)), total)
                other = np.arange(len(repeat)) - np.repeat(np.cumsum(total) - total, total)
                own = way[repeat]
                yield out.iloc[repeat].assign(cell=np.minimum(own, other) * total[repeat] + np.maximum(own, other))
            else:
                yield out.assign(cell=way)

    kinds = ", ".join(f"{c} {t}" for c, t in shared.dtypes)
    found = shared.mapInPandas(run, f"{kinds}, way int, cell bigint")
    return found.repartition(partitions(shared.sparkSession), "token", "cell").sortWithinPartitions("token", "cell", "n", "rid")


def _way(rid: np.ndarray, total: np.ndarray) -> np.ndarray:
    return (_mixed(rid, 0) % total.astype(np.uint64)).astype(np.int64)


def _mixed(rid: np.ndarray, turn: int) -> np.ndarray:
    x = (rid.view(np.uint64) + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of (first, second, ...) sorted by these two, and how often each occurs."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    first = np.flatnonzero(np.concatenate([[True], (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)]))
    return pairs[first], np.diff(np.append(first, len(pairs)))


def _stars(rows: DataFrame, least: float, order: Broadcast | None, turn: int) -> DataFrame:
    """From sorted (token, cell, rid, n, root): (hub, rid, common) pairs of different roots; for shingles of several ways rows
    (null, rid, n, token, root) of the hubs."""
    columns = ("hub", "rid", "common", "token", "root")

    def frame(hub, rid, common, token=0, root=0) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(columns, (pd.array(hub, "Int64"), rid, common, token, root))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, held = [], 0

        def out() -> pd.DataFrame:
            pairs, common = _counted(np.concatenate(found))
            return frame(pairs[:, 0], pairs[:, 1], common)

        for rows in _whole(batches, ["token", "cell"]):
            token, rid, n, root = (rows[c].to_numpy() for c in ("token", "rid", "n", "root"))
            rank = _mixed(rid, turn)
            wide = order.value.ways(token.view(np.uint64)) > 1 if order is not None else np.zeros(len(token), bool)
            inner = []
            for i, j in _groups(rows, ["token", "cell"], 1 if wide.any() else 2):
                if j - i == 1 and not wide[i]:
                    continue
                if not wide[i] and (root[i:j] == root[i]).all():
                    continue
                while i < j:
                    to = i + int(np.searchsorted(n[i:j], math.floor(n[i] / least + 1e-9), "right"))
                    hub = i + int(np.argmin(rank[i:to]))
                    other = np.flatnonzero(root[i:to] != root[hub]) + i
                    if len(other):
                        found.append(np.stack([np.full(len(other), rid[hub]), rid[other]], axis=1))
                        held += len(other)
                    if wide[i]:
                        inner.append(hub)
                    i = to
            if inner:
                yield frame([None] * len(inner), rid[inner], n[inner].astype(np.int64), token[inner], root[inner])
            if held > HELD:
                yield out()
                found, held = [], 0
        if held:
            yield out()

    return rows.mapInPandas(run, "hub bigint, rid bigint, common bigint, token bigint, root bigint")


def _pairs(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, common, m, n) of the pairs of different roots with a common first shingle and room for the similarity, from
    sorted (token, cell, way, rid, n, at, root, bitmap)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pd.DataFrame:
            pair, common = _counted(np.concatenate(held))
            return pd.DataFrame({"a": pair[:, 0], "b": pair[:, 1], "common": common, "m": pair[:, 2], "n": pair[:, 3]})

        for rows in _whole(batches, ["token", "cell"]):
            rid, root, n, at, way = (rows[c].to_numpy(np.int64) for c in ("rid", "root", "n", "at", "way"))
            bits = np.frombuffer(b"".join(rows["bitmap"]), np.uint64).reshape(-1, BITMAP // 64)
            for i, j in _groups(rows, ["token", "cell"]):
                r = root[i:j]
                if (r == r[0]).all():
                    continue
                mixed = way[i:j].min() != way[i:j].max()  # pairs of one way have a cell of their own
                # Sorted by size: partners are the rows after it up to the greatest size allowed.
                to = np.searchsorted(n[i:j], np.floor(n[i:j] / least + 1e-9), "right")
                count = to - np.arange(1, j - i + 1)
                total, begin = np.concatenate([[0], np.cumsum(count)]), 0
                while begin < j - i:
                    end = max(begin + 1, int(np.searchsorted(total, total[begin] + PAIRS, "right")) - 1)
                    c = count[begin:end]
                    x = np.repeat(np.arange(begin, end), c)
                    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(c) - c, c)
                    x, y = x + i, y + i
                    ok = root[x] != root[y]
                    if mixed:
                        ok &= way[x] != way[y]
                    # They share no more than the shingles up to this one and all later ones of the shorter rest.
                    most = np.minimum(at[x], at[y]) + np.minimum(n[x] - at[x], n[y] - at[y])
                    ok &= most * (1 + least) >= least * (n[x] + n[y]) - 1e-6
                    x, y = x[ok], y[ok]
                    # The sets are at least as many shingles apart as their bitmaps are bits.
                    apart = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
                    ok = apart * (1 + least) <= (1 - least) * (n[x] + n[y]) + 1e-6
                    x, y = x[ok], y[ok]
                    low, high = np.minimum(rid[x], rid[y]), np.maximum(rid[x], rid[y])
                    held.append(np.stack([low, high, np.minimum(n[x], n[y]), np.maximum(n[x], n[y])], axis=1))
                    size += len(x)
                    begin = end
                    if size > HELD:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()

    found = rows.mapInPandas(run, "a bigint, b bigint, common bigint, m bigint, n bigint")
    after = lambda n: F.ceil(least * F.col(n) - 1e-9) - 1  # noqa: E731 - shingles that come after the first ones
    return (
        found.groupBy("a", "b").agg(F.sum("common").alias("common"), F.first("m").alias("m"), F.first("n").alias("n"))
        .where((F.col("common") + F.greatest(after("m"), after("n"))) * (1 + least) >= least * (F.col("m") + F.col("n")) - 1e-6)
        .select("a", "b")
    )


def _texts(rows: DataFrame) -> DataFrame:
    """(k1, k2, text), each text once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            new = []
            for key in zip(batch["k1"], batch["k2"]):
                new.append(key not in seen)
                seen.add(key)
            yield batch[np.array(new, bool)]

    return rows.select("k1", "k2", "text").mapInPandas(run, "k1 bigint, k2 bigint, text string")


def _similar(pairs: DataFrame, sigs: DataFrame, rows: DataFrame, shingle: int, least: float) -> DataFrame:
    """The rows of ``pairs (hub, rid)`` whose whole sets are similar, as (a, b)."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("ways"))
    heads = sizes.select("hub", F.col("hub").alias("rid"), F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("way"))
    tails = pairs.join(sizes, "hub").select("hub", "rid", F.lit(1).alias("side"), F.pmod(F.xxhash64("rid"), F.col("ways")).cast("int").alias("way"))
    wanted = store(heads.unionByName(tails).join(sigs.select("rid", "k1", "k2"), "rid"), "wanted-texts")
    found = _texts(rows).join(wanted, ["k1", "k2"]).select("hub", "way", "side", "rid", "text")
    found = found.repartition(partitions(pairs.sparkSession), "hub", "way").sortWithinPartitions("hub", "way", "side", "rid")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held, met = None, None, 0
        for batch in batches:
            a, b = [], []
            for r in batch.itertuples(index=False):
                now = (r.hub, r.way, r.rid)
                if now == last:  # the text comes from several tasks
                    continue
                last, found = now, shingles(r.text, shingle)
                met += 1
                if r.side == 0:
                    held = r.hub, r.way, found
                elif held is not None and held[:2] == now[:2]:
                    common = len(np.intersect1d(held[2], found, assume_unique=True))
                    if common >= least * (len(held[2]) + len(found) - common) - 1e-9:
                        a.append(r.hub)
                        b.append(r.rid)
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64), "met": np.int64(0)})
        yield pd.DataFrame({"a": [0], "b": [0], "met": [met]})

    out = store(found.mapInPandas(run, "a bigint, b bigint, met bigint"), "similar")
    if (out.agg(F.sum("met")).first()[0] or 0) != wanted.count():
        raise RuntimeError("documents have changed while they were compared")
    discard(wanted)
    return out.where("a != b").select("a", "b")


def _release(df: DataFrame) -> None:
    """Let go of plans that have ended: Spark removes their shuffle files once the driver's objects are collected."""
    gc.collect()
    df.sparkSession._jvm.java.lang.System.gc()


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rooted(sigs: DataFrame, links: DataFrame) -> DataFrame:
    """(rid, root) of every row."""
    found = components(links)
    return sigs.select("rid").join(found, F.col("rid") == F.col("node"), "left").select("rid", F.coalesce("component", "rid").alias("root"))


def _close(active: DataFrame) -> DataFrame:
    """(hub, rid) of texts whose fingerprints are equal or connected by the links of ``simhash``: one text stands for each
    fingerprint."""
    heads = store(active.groupBy("fp").agg(F.min("rid").alias("hub")), "fingerprints")
    equal = active.join(heads, "fp").where("rid != hub").select("hub", "rid")
    a, b = heads.select(F.col("fp").alias("a"), "hub"), heads.select(F.col("fp").alias("b"), F.col("hub").alias("rid"))
    linked = near_links(heads.select("fp")).distinct().join(a, "a").join(b, "b").select("hub", "rid")
    return equal.unionByName(linked)


def near_copies(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, least: float = LEAST, hot: int = HOT) -> DataFrame:
    """(doc_id, k1, k2, component_id, kept) of every row of ``docs``; k1 and k2 are ``text_keys`` of its text."""
    rows = _numbered(docs, text)
    order = docs.sparkSession.sparkContext.broadcast(frequencies(rows, shingle, hot))
    sigs = store(signatures(rows, shingle, least, order), "first-shingles")
    _release(docs)

    equal = sigs.groupBy("k1", "k2").agg(F.min("rid").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1")
    copies = store(sigs.select("rid", "k1", "k2").join(equal, ["k1", "k2"]).where("rid != a").select("a", F.col("rid").alias("b")), "copies")
    copied = copies.select(F.col("b").alias("rid"))

    active = sigs.where("tokens is not null").join(copied, "rid", "left_anti")  # copies need no comparison
    tried, close = [], store(_close(active), "near-fingerprints")
    links = copies
    if not close.isEmpty():
        tried.append(close.select(F.least("hub", "rid").alias("a"), F.greatest("hub", "rid").alias("b")))
        links = links.unionByName(_similar(close, sigs, rows, shingle, least))
    roots = store(_rooted(sigs, links), "roots")
    _release(docs)
    shared = store(_shared(active.join(roots, "rid"), order), "shared-shingles")
    _release(docs)
    for turn in range(TURNS):
        stars = store(_stars(_dealt(shared.join(roots, "rid"), order, False), least, order, turn), "stars")
        near = stars.where("hub is not null")
        # The hubs of the ways of one shingle, among themselves.
        hubs = stars.where("hub is null").select(
            "token", "rid", F.col("common").cast("int").alias("n"), "root", F.lit(0).cast("long").alias("cell"))
        if not hubs.isEmpty():
            hubs = hubs.repartition(partitions(docs.sparkSession), "token").sortWithinPartitions("token", "cell", "n", "rid")
            near = near.unionByName(_stars(hubs, least, None, turn).where("hub is not null"))
        common = near.groupBy("rid", "hub").agg(F.sum("common").alias("common"))
        best = common.groupBy("rid").agg(F.max(F.struct("common", "hub"))["hub"].alias("hub")).select("hub", "rid")
        if tried:
            best = best.join(union(tried), (F.least("hub", "rid") == F.col("a")) & (F.greatest("hub", "rid") == F.col("b")), "left_anti")
        best = store(best, "best-hubs")
        discard(stars)
        _release(docs)
        if best.isEmpty():
            break
        tried.append(best.select(F.least("hub", "rid").alias("a"), F.greatest("hub", "rid").alias("b")))
        new = _similar(best, sigs, rows, shingle, least)
        if new.isEmpty():
            break
        links = links.unionByName(new)
        roots = store(_rooted(sigs, links), "roots")
        _release(docs)
    left = shared.join(roots, "rid").join(sigs.select("rid", "bitmap"), "rid")
    others = _pairs(_dealt(left, order, True), least)
    others = others.join(union(tried), ["a", "b"], "left_anti") if tried else others
    others = store(others.select(F.col("a").alias("hub"), F.col("b").alias("rid")), "candidates")
    discard(shared)
    _release(docs)
    if not others.isEmpty():
        links = links.unionByName(_similar(others, sigs, rows, shingle, least))
        roots = store(_rooted(sigs, links), "roots")
        _release(docs)
    named = sigs.select("rid", "doc_id", "k1", "k2").join(roots, "rid")
    # The least doc_id names a component, and of its rows the first stays; rows without an id come last.
    least_row = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("m"))
    return named.join(least_row, "root").select("doc_id", "k1", "k2", F.col("m.doc_id").alias("component_id"),
                                                (F.col("rid") == F.col("m.rid")).alias("kept"))


def text_keys(text: str = "text") -> dict[str, Column]:
    """Two hashes that stand for a text; a null one counts as empty."""
    full = F.coalesce(F.col(text), F.lit(""))
    return {"k1": F.xxhash64(full), "k2": F.xxhash64(F.lit(1), full)}


def drop_copies(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id. Of rows alike in id and text the one of the
    least hash over all columns stays."""
    kept = near_copies(docs, text, **how).where("kept").select(F.col("doc_id").alias("__id"), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    keyed = docs.withColumns({"__a": text_keys(text)["k1"], "__b": text_keys(text)["k2"]})
    same = (F.col("__a") == F.col("__k1")) & (F.col("__b") == F.col("__k2")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    alike = Window.partitionBy("__a", "__b", "doc_id").orderBy(F.xxhash64(*docs.columns))
    found = keyed.join(store(kept, "kept-rows"), same, "left_semi").withColumn("__r", F.row_number().over(alike))
    return found.where("__r = 1").select(*docs.columns)
