"""Removal of long byte strings that occur more than once, by a sparse suffix array built as a distributed merge sort.

A byte goes if some string of ``length`` bytes over it starts anywhere else too. Sorting the suffix of every byte would move
hundreds of bytes per byte of text, so suffixes are sampled where their content says so: of the ``length - GRAM + 1`` grams in
a string of ``length`` bytes the one of least hash (the leftmost if equal) is its anchor. Equal strings have equal
anchors, so only suffixes at anchors are needed, about one in 75 bytes. Then

1. anchors whose gram occurs once are dropped, by counts with partial aggregates;
2. an anchor's *context* is the union of the strings it stands for. Contexts that occur twice as a whole are settled by
   their count; for groups of copies that is nearly all;
3. of the other contexts, one each, the suffixes at anchors are sorted: every task sorts its own into a run, front-codes it (length
   of the prefix shared with the suffix before, and the rest) and sends it in ranges of the gram's hash; the
   receiver combines the runs by a loser tree that keeps, for each run's head, the prefix it is known to share with the
   last suffix put out. Heads are compared from there on, and not at all if those lengths differ.
   The sorted order and its common prefixes give, for every number r of bytes before the anchor, the blocks of suffixes that agree
   on the ``length - r`` bytes from it; in a block, equal bytes before the anchor make equal strings.

A gram with very many different contexts (the edges of a passage that stands in a third of all texts) is not sent as one
group: its strings are dealt over the cluster by their own hash, after equal ones in a task have met.

Edge cases: a null or empty text has no bytes; texts shorter than ``length`` keep all; rows that are equal, doc_id
included, are occurrences of their own; a null doc_id is kept; extra columns are ignored. Grams, contexts and the
strings of dealt groups are told apart by 64 or 128 bits of hash, suffixes by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, partitions, store

LENGTH = 200
GRAM = 50
HOT_CONTEXTS = 1024  # different contexts of one gram that are merged as one group
RUN_ITEMS = 20_000  # suffixes of one sorted run
CHUNK = 1 << 20  # windows hashed at a time
POSITION_BITS = 21

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, min(2 * len(self.up), CHUNK + 1024))
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.uint64(2**64 - 1))
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1: width - 1 + n])


def anchors(body: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, lo, hi): anchors and the first and last start of the strings they stand for."""
    n, width = len(body) - length + 1, length - gram + 1
    raw, pieces = np.frombuffer(body, np.uint8), []
    for begin in range(0, max(n, 0), CHUNK):
        data = raw[begin: begin + CHUNK + length - 1]
        up, down = _POWERS.get(len(data) + 1)
        pre = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=pre[1:])
        h = _mix((pre[gram:] - pre[:-gram]) * down[: len(data) - gram + 1])
        # The low bits give way to the position: the least value is the leftmost of least hash.
        low = np.uint64((1 << POSITION_BITS) - 1)
        placed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(placed, width) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], len(at)) - 1
        pieces.append((at[first] + begin, first + begin, last + begin))
    if not pieces:
        return (np.zeros(0, np.int64),) * 3
    at, lo, hi = (np.concatenate(x) for x in zip(*pieces))
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))  # join what a chunk's end has cut
    return at[first], lo[first], hi[np.append(first[1:], len(at)) - 1]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, h, kh, bh, at, lo, hi) of ``docs (doc_id, h, text)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out = []
            for doc, h, text in batch.itertuples(index=False):
                body = _bytes(text)
                at, lo, hi = anchors(body, length, gram)
                if len(at):
                    kh = [digest(body[i: i + gram], 1) for i in at.tolist()]
                    bh = [digest(body[i: j + length], 2) for i, j in zip(lo.tolist(), hi.tolist())]
                    out.append(pd.DataFrame({
                        "doc_id": pd.array([doc] * len(at), "Int64"), "h": h, "kh": np.array(kh, np.uint64).view(np.int64),
                        "bh": np.array(bh, np.uint64).view(np.int64), "at": at, "lo": lo, "hi": hi}))
            if out:
                yield pd.concat(out, ignore_index=True)

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "h", "text")
    return docs.mapInPandas(run, "doc_id bigint, h bigint, kh bigint, bh bigint, at bigint, lo bigint, hi bigint")


# ---- sorted runs and their merge ----

def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known already."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(run: list[bytes]) -> tuple[list[int], list[bytes]]:
    """(prefixes shared with the string before, the rests) of a sorted run."""
    shared = [0] + [common_prefix(a, b, 0) for a, b in zip(run, run[1:])]
    return shared[: len(run)], [s[k:] for s, k in zip(run, shared)]


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, place in it, string, prefix shared with the string put out before) in sorted order.

    A loser tree over front-coded runs. Every head carries the length it shares with the last string put out; of two heads the
    one that shares more is the smaller, without looking at them, and equal lengths are compared from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    place = [0] * k
    head: list[bytes | None] = [r[1][0] if i < len(runs) and r[1] else None for i, r in enumerate(runs)] + [None] * (k - len(runs))
    known = [0] * k

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix is then that with the winner."""
        a, b = head[x], head[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        shared = common_prefix(a, b, known[x])
        if a[shared:] <= b[shared:]:
            known[y] = shared
            return x, y
        known[x] = shared
        return y, x

    tree = [0] * k
    winners = list(range(k))
    level = k
    while level > 1:
        level //= 2
        nxt = []
        for i in range(level):
            won, tree[level + i] = play(winners[2 * i], winners[2 * i + 1])
            nxt.append(won)
        winners = nxt
    best = winners[0]
    while head[best] is not None:
        string = head[best]
        yield best, place[best], string, known[best]
        shared, rests = runs[best]
        place[best] += 1
        if place[best] < len(rests):
            known[best] = shared[place[best]]
            head[best] = string[: known[best]] + rests[place[best]]
        else:
            head[best] = None
        node = (best + k) // 2
        while node:
            best, tree[node] = play(best, tree[node])
            node //= 2


def pack_run(items: list[tuple]) -> bytes:
    """A front-coded run of items (right, left, doc_id, h, at, lo, hi, settled), sorted by right."""
    items = sorted(items, key=lambda x: x[0])
    shared, rests = front_code([x[0] for x in items])
    table = np.array([[k, len(r), len(x[1]), *x[2:]] for k, r, x in zip(shared, rests, items)], "<i8")
    return len(items).to_bytes(8, "little") + table.tobytes() + b"".join(rests) + b"".join(x[1] for x in items)


def unpack_run(data: bytes) -> tuple[list[int], list[bytes], list[bytes], np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    table = np.frombuffer(data, "<i8", n * 9, 8).reshape(n, 9)

    def cut(lengths: np.ndarray, begin: int) -> tuple[list[bytes], int]:
        ends = begin + np.cumsum(lengths)
        return [data[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())], int(ends[-1]) if n else begin

    rests, at = cut(table[:, 1], 8 + table.nbytes)
    lefts, _ = cut(table[:, 2], at)
    return table[:, 0].tolist(), rests, lefts, table[:, 3:]


def repeated_starts(runs: list[bytes], length: int, gram: int) -> pd.DataFrame:
    """(doc_id, h, p): starts of repeated strings among the unsettled items of the runs."""
    opened = [unpack_run(r) for r in runs]
    order = [(r, i, len(s), k) for r, i, s, k in merge_runs([x[:2] for x in opened])]
    n, most = len(order), length - gram
    shared = np.array([x[3] for x in order])
    right = np.array([x[2] for x in order])
    lefts = [opened[r][2][i] for r, i, _, _ in order]
    info = np.array([opened[r][3][i] for r, i, _, _ in order]).reshape(n, 6)
    doc, h, at, lo, hi, settled = info.T
    left_len = np.fromiter(map(len, lefts), np.int64, n)
    before = np.zeros((most, n), np.uint64)  # bytes before the anchor, nearest first
    for i, text in enumerate(lefts):
        before[: len(text), i] = np.frombuffer(text, np.uint8)[::-1]
    found, code = [], np.zeros(n, np.uint64)
    for r in range(most + 1):
        if r:
            code = code * np.uint64(_BASE) + _BYTE[before[r - 1].astype(np.uint8)]
        able = np.flatnonzero((left_len >= r) & (right >= length - r))
        if len(able) < 2:
            continue
        block = np.cumsum(shared < length - r)[able].astype(np.uint64)
        key = _mix(code[able] + _mix(block))
        order_ = np.argsort(key, kind="stable")
        same = key[order_][1:] == key[order_][:-1]
        twice = np.zeros(len(able), bool)
        twice[order_[1:][same]] = True
        twice[order_[:-1][same]] = True
        hit = able[twice]
        hit = hit[(settled[hit] == 0) & (at[hit] - hi[hit] <= r) & (r <= at[hit] - lo[hit])]
        if len(hit):
            found.append(pd.DataFrame({"doc_id": doc[hit], "h": h[hit], "p": at[hit] - r}))
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"doc_id": [], "h": [], "p": []}, dtype="int64")


def _spans(starts: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, h, lo, hi): maximal runs of starts of one text."""
    s = starts.drop_duplicates().sort_values(["doc_id", "h", "p"])
    d, h, p = (s[c].to_numpy(np.int64) for c in ("doc_id", "h", "p"))
    if not len(p):
        return pd.DataFrame({"doc_id": d, "h": h, "lo": p, "hi": p})
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (p[1:] != p[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return pd.DataFrame({"doc_id": d[first], "h": h[first], "lo": p[first], "hi": p[last]})


NO_ID = -(1 << 63)  # stands for a null doc_id inside the runs


def sorted_runs(touched: DataFrame, length: int, gram: int, hot: int, parts: int) -> DataFrame:
    """(part, kind, data): kind 0 front-coded runs by gram; of hot grams, kind 1 strings by hash and kind 2 those
    that a task has met twice already."""
    kinds = "part int, kind int, data binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs: dict[int, list[tuple]] = {}
        strings: list[np.ndarray] = []
        held = 0

        def flush() -> pd.DataFrame:
            rows = [(part, 0, pack_run(items)) for part, items in runs.items()]
            if strings:
                # Equal strings of this task meet here: they are settled, and one of them speaks for all.
                table = np.concatenate(strings)
                _, first, back, count = np.unique(table[:, 0], return_index=True, return_inverse=True, return_counts=True)
                known = table[count[back] > 1]
                for kind, some, by in ((1, table[first], 0), (2, known, 2)):
                    part_of = (some[:, by].view(np.uint64) % np.uint64(parts)).astype(np.int64)
                    rows += [(part, kind, some[part_of == part].tobytes()) for part in np.unique(part_of).tolist()]
            return pd.DataFrame(rows, columns=["part", "kind", "data"])

        for batch in batches:
            for doc, h, text, items in batch.itertuples(index=False):
                body = _bytes(text)
                doc = NO_ID if pd.isna(doc) else int(doc)
                for x in items:
                    kh, at, lo, hi = x["kh"], x["at"], x["lo"], x["hi"]
                    if x["contexts"] > hot:
                        data = body[lo: hi + length]
                        codes = [xxhash.xxh64_intdigest(data[i: i + length], 3) for i in range(hi - lo + 1)]
                        table = np.empty((hi - lo + 1, 4), np.int64)
                        table[:, 0] = np.array(codes, np.uint64).view(np.int64)
                        table[:, 1], table[:, 2], table[:, 3] = doc, h, np.arange(lo, hi + 1)
                        strings.append(table)
                        held += (hi - lo) // 8
                    else:
                        part = (kh & 0xFFFFFFFF) % parts
                        runs.setdefault(part, []).append(
                            (body[at: at + length], body[max(0, at - length + gram): at], doc, h, at, lo, hi, int(x["n"] > 1)))
                        held += 1
                if held >= RUN_ITEMS:
                    yield flush()
                    runs, strings, held = {}, [], 0
        if held:
            yield flush()

    return touched.select("doc_id", "h", "text", "items").where(F.size("items") > 0).mapInPandas(run, kinds)


def _repeated_strings(data: list[bytes], known: bool) -> pd.DataFrame:
    hit = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in data])
    if not known:
        _, back, count = np.unique(hit[:, 0], return_inverse=True, return_counts=True)
        hit = hit[count[back] > 1]
    return pd.DataFrame({"doc_id": hit[:, 1], "h": hit[:, 2], "p": hit[:, 3]})


def merged_spans(runs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, h, lo, hi): first and last start of repeated strings, from all runs of a part."""
    parts = runs.repartition(partitions(runs.sparkSession), "part").sortWithinPartitions("part", "kind")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []

        def done() -> pd.DataFrame:
            found = repeated_starts(held, length, gram) if at[1] == 0 else _repeated_strings(held, at[1] == 2)
            spans = _spans(found)
            ids = pd.array([None if x == NO_ID else x for x in spans["doc_id"].tolist()], "Int64")
            return spans.assign(doc_id=ids)

        for batch in batches:
            for part, kind, data in batch.itertuples(index=False):
                if at is not None and at != (part, kind):
                    yield done()
                    held = []
                at = (part, kind)
                held.append(data)
        if held:
            yield done()

    return parts.mapInPandas(run, "doc_id bigint, h bigint, lo bigint, hi bigint")


# ---- the whole ----

def _cut(body: bytes, spans: list[tuple[int, int]], length: int) -> tuple[bytes, int, int]:
    """(kept, bytes removed, removed runs) for first and last starts of repeated strings."""
    kept, end, n_spans, removed = [], 0, 0, 0
    run_end = -1
    for lo, hi in sorted(spans):
        stop = hi + length
        if lo > run_end:
            kept.append(body[end:lo])
            n_spans += 1
            removed += stop - lo
            run_end = end = stop
        elif stop > run_end:
            removed += stop - run_end
            run_end = end = stop
    kept.append(body[end:])
    return b"".join(kept), removed, n_spans


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CONTEXTS,
                   with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes of every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    all_anchors = store(anchor_rows(docs, length, gram), "anchors")
    grams = store(all_anchors.groupBy("kh").count().where("count > 1").select("kh"), "grams")
    candidates = store(all_anchors.join(grams, "kh"), "candidates")
    discard(all_anchors)
    place = F.struct("doc_id", "h", "at", "lo", "hi")
    classes = candidates.groupBy("kh", "bh").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    classes = store(classes, "contexts")
    mixed = classes.groupBy("kh").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
    items = classes.join(store(mixed, "mixed-grams"), "kh").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h"), "kh", "contexts", "n",
        F.col("first.at").alias("at"), F.col("first.lo").alias("lo"), F.col("first.hi").alias("hi"))
    settled = candidates.join(store(classes.where("n > 1").select("kh", "bh"), "settled"), ["kh", "bh"]).select(
        "doc_id", "h", "lo", "hi")
    # A document's anchors are no more than its text is long.
    span = F.struct("lo", "hi")
    clear = settled.groupBy("doc_id", "h").agg(F.collect_set(span).alias("clear"))
    item = F.struct("kh", "contexts", "n", "at", "lo", "hi")
    open_ = items.groupBy("doc_id", "h").agg(F.collect_list(item).alias("items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])
    marks = clear.join(open_, same(clear, open_), "full").select(
        F.coalesce(clear["doc_id"], open_["doc_id"]).alias("mark_id"), F.coalesce(clear["h"], open_["h"]).alias("mark_h"),
        F.coalesce("clear", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("clear"),
        F.coalesce("items", F.array().cast(
            "array<struct<kh:bigint,contexts:bigint,n:bigint,at:bigint,lo:bigint,hi:bigint>>")).alias("items"))
    marks = store(marks, "marks")
    joined = docs.join(marks, docs["doc_id"].eqNullSafe(marks["mark_id"]) & (docs["h"] == marks["mark_h"]), "left")
    touched = F.col("mark_h").isNotNull()
    body = F.coalesce(F.col("text"), F.lit(""))
    keep = touched | F.lit(with_kept)
    phase = store(joined.select(
        "doc_id", "h", touched.alias("touched"), F.octet_length(body).cast("long").alias("n_bytes"),
        F.when(~touched, F.sha2(body, 256)).alias("sha"), F.when(keep, body).alias("text"), "clear", "items"), "marked")
    discard(candidates)
    runs = sorted_runs(phase.where("touched"), length, gram, hot, 4 * partitions(spark))
    found = store(merged_spans(runs, length, gram), "spans")
    spans = found.groupBy("doc_id", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")).select(
        F.col("doc_id").alias("span_id"), F.col("h").alias("span_h"), "spans")
    open_docs = phase.where("touched").select("doc_id", "h", "text", "clear")
    left = open_docs.join(spans, open_docs["doc_id"].eqNullSafe(F.col("span_id")) & (open_docs["h"] == F.col("span_h")),
                          "left").select("doc_id", "text", "clear", "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, content, clear_, spans_ in batch.itertuples(index=False):
                content = _bytes(content)
                pairs = {(x["lo"], x["hi"]) for xs in (clear_, spans_) if xs is not None for x in xs}
                kept, removed, n_spans = _cut(content, list(pairs), length)
                out.append((doc, len(content), removed, n_spans, hashlib.sha256(kept).hexdigest(), *[kept] * with_kept))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept])
            yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    schema = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
              + ", kept binary" * with_kept)
    zero = F.lit(0).cast("long")
    rest = phase.where("not touched").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"),
        F.col("sha").alias("kept_sha256"), *[F.col("text").cast("binary").alias("kept")] * with_kept)
    return left.mapInPandas(run, schema).unionByName(rest)
