"""SimHash near-duplicates with a pigeonring filter.

A text's fingerprint has a bit set where over half of its shingle hashes have it set. Two
fingerprints link at ``max_bits`` or fewer differing bits. The 64 bits are cut into
``max_bits + 1`` segments on a ring. If two fingerprints differ in at most t bits over m segments,
some start has *every* chain of l consecutive segments differing in at most ``l * t // m`` bits (the
pigeonring principle), so

* the first segment of that chain is equal and the first two differ in one bit at most: these are
  the join keys, an exact one per fingerprint and start on one side, and on the other side also those
  with one bit of the second segment turned;
* longer chains are checked in growing order before the full Hamming distance.

Texts with equal fingerprints meet before any comparison, by a partial aggregate. Comparison runs
in numpy over sorted key groups, in blocks of bounded size; pairs already connected inside a task are
skipped and a task returns a spanning forest of its links, so a group of n near copies gives n links
and not n^2. A key with very many fingerprints is dealt over a square of cells.

Edge cases: a null, empty or blank text has fingerprint 0 and is linked like any other; fewer words
than a shingle make one shingle of them all; rows that repeat a doc_id are rows of their own;
rows without a doc_id are kept and never name a component, unless no row of it has an id (then null); an empty
table gives no row; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, partitions, store

SHINGLE = 4
MAX_BITS = 4
HOT_KEY = 4096  # fingerprints of one key that a cell holds
SHINGLE_BLOCK = 1 << 16
PAIR_BLOCK = 1 << 18
CHUNK = 60_000  # rows that a task compares at a time, unless one group has more


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have bit j set, for j from 0. Eight byte-wide counters share a
    word, so 255 hashes are added before any can overflow."""
    counts = np.zeros(64, np.int64)
    ones = np.uint64(0x0101010101010101)
    pad = -len(hashes) % 255
    rows = np.concatenate([hashes, np.zeros(pad, np.uint64)]).reshape(-1, 255) if pad else hashes.reshape(-1, 255)
    for bit in range(8):
        lanes = ((rows >> np.uint64(bit)) & ones).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1:]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLE_BLOCK):
        a, b = starts[at: at + SHINGLE_BLOCK].tolist(), ends[at: at + SHINGLE_BLOCK].tolist()
        counts += _bit_counts(np.array([digest(body[i:j], 42) for i, j in zip(a, b)], np.uint64))
    return sum(1 << j for j in np.flatnonzero(2 * counts > len(starts)).tolist())


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of given hashes."""
    return sum(1 << j for j in np.flatnonzero(2 * _bit_counts(hashes) > len(hashes)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long of the same bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(x, shingle) for x in batch[text]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": fps.view(np.int64)})

    return docs.select("doc_id", text).mapInPandas(run, "doc_id bigint, fp bigint")


def _segments(m: int) -> list[tuple[int, int]]:
    """(first bit, width) of m segments that differ by one bit at most, the wider first."""
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _mask(segment: tuple[int, int]) -> int:
    return ((1 << segment[1]) - 1) << segment[0]


def chain_keys(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, start, side, fp): the two segments from ``start`` on, side 0 with exact keys, side 1 with them and those
    one bit off."""
    m = max_bits + 1
    segments = _segments(m)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            out = []
            for i in range(m):
                first, second = segments[i], segments[(i + 1) % m]
                base = fp & np.uint64(_mask(first) | _mask(second))
                turned = [base] + [base ^ np.uint64(1 << (second[0] + j)) for j in range(second[1])]
                part = {"start": np.int8(i), "fp": batch["fp"]}
                out.append(pd.DataFrame({"key": base.view(np.int64), "side": np.int8(0), **part}))
                out += [pd.DataFrame({"key": k.view(np.int64), "side": np.int8(1), **part}) for k in turned]
            yield pd.concat(out, ignore_index=True)[["key", "start", "side", "fp"]]

    return fps.select("fp").mapInPandas(run, "key bigint, start tinyint, side tinyint, fp bigint")


class _Forest:
    """Links between fingerprints met in one task, kept as a spanning forest."""

    def __init__(self, nodes: np.ndarray):
        self.nodes = nodes
        self.label = np.arange(len(nodes))
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            apart = np.flatnonzero(self.label[a] != self.label[b])
            if not len(apart):
                return
            a, b = a[apart], b[apart]
            # One link for each label and pass: every label of the larger side joins a smaller one.
            la, lb = self.label[a], self.label[b]
            low, high = np.minimum(la, lb), np.maximum(la, lb)
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
            self.links += zip(a[first].tolist(), b[first].tolist())
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            while True:
                further = parent[parent]
                if (further == parent).all():
                    break
                parent = further
            self.label = parent[self.label]


def _compare(keys: np.ndarray, side: np.ndarray, fp: np.ndarray, m: int, max_bits: int, forest: _Forest, node: np.ndarray,
             starts: np.ndarray) -> None:
    """Compare side 0 with side 1 inside every group of equal ``keys`` (sorted by key and side)."""
    segments = _segments(m)
    masks = np.array([_mask(s) for s in segments], np.uint64)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n_exact = np.add.reduceat((side == 0).astype(np.int64), edges)
    query = np.flatnonzero(side == 1)
    group = np.searchsorted(edges, query, "right") - 1
    width = n_exact[group]
    query, group, width = query[width > 0], group[width > 0], width[width > 0]
    at = 0
    total = np.concatenate([[0], np.cumsum(width)])
    while at < len(query):
        # Queries whose pairs fill a block; a query of more pairs than that is a block of its own.
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIR_BLOCK, "right")) - 1)
        w = width[at:to]
        left = np.repeat(query[at:to], w)
        inside = np.arange(len(left)) - np.repeat(np.cumsum(w) - w, w)
        right = np.repeat(edges[group[at:to]], w) + inside
        a, b = node[left], node[right]
        open_ = np.flatnonzero(forest.label[a] != forest.label[b])
        left, right = left[open_], right[open_]
        for length in range(3, m + 1):  # chains of one and two hold by the key
            diff = fp[left] ^ fp[right]
            mask = np.zeros(len(left), np.uint64)
            for k in range(length):
                mask |= masks[(starts[left] + k) % m]
            ok = np.bitwise_count(diff & mask) <= length * max_bits // m
            left, right = left[ok], right[ok]
        ok = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        forest.add(node[left[ok]], node[right[ok]])
        at = to


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints of ``fps (fp)`` connected by pairs
    of ``max_bits`` or fewer differing bits."""
    spark = fps.sparkSession
    m = max_bits + 1
    rows = chain_keys(fps, max_bits)
    # Keys with more exact rows than a cell takes. There are at most m / hot_key of them per
    # fingerprint; as a stored table the planner knows its size, and broadcasts only a small one.
    hot = store(rows.where("side = 0").groupBy("key", "start").count().where(F.col("count") > hot_key)
                .select("key", "start", F.ceil(F.col("count") / hot_key).cast("int").alias("parts")), "hot-keys")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    cells = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(
        F.col("side") == 0, F.transform(other, lambda j: part * F.col("parts") + j)
    ).otherwise(F.transform(other, lambda i: i * F.col("parts") + part))
    group = ["key", "start", "cell"]
    rows = rows.join(hot, ["key", "start"], "left").select("key", "start", "side", "fp", F.explode(cells).alias("cell"))
    rows = rows.repartition(partitions(spark), *group).sortWithinPartitions(*group, "side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole groups at a time: the last group of a batch may go on in the next."""
        held: list[pd.DataFrame] = []

        def done(chunk: pd.DataFrame) -> pd.DataFrame:
            fp = chunk["fp"].to_numpy().view(np.uint64)
            # Rows are sorted, so a running number tells groups apart.
            k, starts, c = (chunk[x].to_numpy() for x in group)
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (starts[1:] != starts[:-1]) | (c[1:] != c[:-1])])
            starts = starts.astype(np.int64)
            nodes, node = np.unique(fp, return_inverse=True)
            forest = _Forest(nodes)
            _compare(np.cumsum(new), chunk["side"].to_numpy(), fp, m, max_bits, forest, node, starts)
            links = np.array(forest.links, np.int64).reshape(-1, 2)
            pairs = nodes.view(np.int64)[links]
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

        for batch in batches:
            if held and len(batch):
                last = held[-1].iloc[-1]
                same = np.logical_and.reduce([batch[x].to_numpy() == last[x] for x in group])
                cut = len(batch) if same.all() else int(np.argmin(same))
                held.append(batch.iloc[:cut])
                batch = batch.iloc[cut:]
                if len(batch) and sum(map(len, held)) >= CHUNK:
                    yield done(pd.concat(held, ignore_index=True))
                    held = []
            if len(batch):
                held.append(batch)
        if held:
            yield done(pd.concat(held, ignore_index=True))

    return rows.mapInPandas(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    base = store(fingerprints(docs, text, shingle), "fingerprints")
    classes = store(base.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = components(near_links(classes, max_bits))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store(rooted.join(least, "root").select("fp", "component_id"), "named")
    return base.join(named, "fp")


def as_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
