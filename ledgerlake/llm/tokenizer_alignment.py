"""Alignment of the tokens of two tokenizers by an associative monoid of fragments.

A fragment describes the tokens that end in one byte range of a text: an *open prefix* (tokens up to the first byte
offset where tokens of both tokenizers end), *closed groups* (the tokens between two such offsets) and an *open suffix*.
A range in which no tokens end together is one open stretch. Two neighbouring fragments compose: the left suffix and the
right prefix become one closed group, and composition is associative, so the fragments of a very long text are
composed in Spark as a tree, ``FAN_IN`` neighbours at a time, wherever they were tokenized.

Texts of up to ``CHUNK`` bytes are one range and close in the task that reads them. Longer ones are cut into ranges of
``CHUNK`` bytes that are tokenized by different tasks. A range gets the text around it from one safe cut
to another: a single space between two characters that are not white space, where both vocabularies
always begin a new token (the first by its word pattern, the second as none of its pieces holds a
space after another character, which is checked). A border without a safe cut within a quarter of a range
on both sides is left out, so its two ranges are one.

Two tokens link where their byte ranges overlap: inside a group every end of a token begins a new link, so all links
are found by two searches in sorted offsets. Documents are stored with their different links and how often
each occurs. A link's count, in how many documents it is, is summed in Spark; the ``FREQUENT`` links of the
highest counts are looked up in the tasks, as a sorted table of that bounded size, all others by a join, so
no frequent link is a hot key and few rows are shuffled.

Edge cases: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no
tokens: zeros and an empty digest. Texts of any length are taken whole. Rows that repeat a doc_id, or have none, are documents of
their own, and equal texts count as often as they occur; counts that tie are all the highest. An empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import most_frequent, partitions, store
from ledgerlake.llm.packing import WordCache, crowded, id_width

CHUNK = 1 << 15
FAN_IN = 8
FREQUENT = 1 << 18
TOKENIZED_AT_ONCE = 1 << 18  # bytes of text
ALIGNED_AT_ONCE, READ_AT_ONCE = 128, 8  # whole texts, and ranges of long ones
CACHED_WORDS = 300_000  # by each tokenizer
PAIRS_AT_ONCE = 1 << 21  # different links a task holds before it hands on their counts


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, all others as characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PlainWords(WordCache):
    """Ids of texts that begin with a space, word by word from a bounded cache; strings of special tokens are plain text.
    White space that stands at an end or in a run goes to the tokenizer with its whole text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.fast = None  # it would know special tokens

    def ids(self, texts: list[str], cut: list[list[str] | None]) -> list[np.ndarray]:
        """Of texts and their words; None where a text is encoded whole."""
        if len(self.words) > CACHED_WORDS:  # words met early are the frequent ones
            self.words = dict(islice(self.words.items(), CACHED_WORDS // 4))
        self._learn(_unknown(cut, self.words))
        whole = iter(self._encode([t for t, words in zip(texts, cut) if words is None]))
        of, kind = self.words.__getitem__, f"<u{self.width}"
        coded = (next(whole) if words is None else b"".join(map(of, words)) for words in cut)
        return [np.frombuffer(x, kind).astype(np.int64) for x in coded]


class PieceWords(PlainWords):
    """The same for pieces. Merges never cross to the space before the next word, as no piece holds a space after another
    character, so a word has the same pieces alone as in its text."""

    def __init__(self, processor):
        self.processor, self.words = processor, {}
        self.width = id_width(processor.get_piece_size())

    def _encode(self, texts: list[str]) -> list[bytes]:
        kind = f"<u{self.width}"
        return [np.array(x, kind).tobytes() for x in self.processor.encode([t[1:] for t in texts], num_threads=1)]

    def _learn(self, new: list[str]) -> None:
        self.words.update(zip(new, self._encode(new)))


def _unknown(cut: list[list[str] | None], known: dict[str, bytes]) -> list[str]:
    new: dict[str, None] = {}
    for words in cut:
        if words is not None:
            new.update(dict.fromkeys(set(words).difference(known)))
    return list(new)


class Vocabularies:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, first: str, second: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor

        self.words = PlainWords(first)
        self.a = self.words.tokenizer
        self.b = SentencePieceProcessor(model_file=second)
        byte_of = _bytes_of_characters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(byte_of.get(c, 0x3F) for c in self.a.id_to_token(i) or "") for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.base = len(pieces)  # a link is its first id times this plus its second id
        self.cuttable = not any(re.search("[^▁]▁", p) for p in pieces)
        self.pieces = PieceWords(self.b)
        # How ids are written in groups: before another id, before the other tokenizer's or the next group, at the end.
        self.written = [f"{i}{c}" for i in range(size) for c in ",|"] + [f"{i}{c}" for i in range(self.base) for c in (",", ";", "")]
        self.b_written = 2 * size

    def encode(self, bodies: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers of texts that begin with a space; None where either does not give the text back."""
        out, at = [], 0
        while at < len(bodies):
            to, size = at, 0
            while to < len(bodies) and (to == at or size + len(bodies[to]) <= TOKENIZED_AT_ONCE):
                size += len(bodies[to])
                to += 1
            texts = [b.decode() for b in bodies[at:to]]
            cut = [None if "\0" in t or crowded(t[1:]) else t.replace(" ", "\0 ").split("\0")[1:] for t in texts]
            # A text's own "▁" could be merged with the space after it.
            b_cut = [words if self.cuttable and words and "▁" not in t else None for t, words in zip(texts, cut)]
            for body, i, j in zip(bodies[at:to], self.words.ids(texts, cut), self.pieces.ids(texts, b_cut)):
                same = b"".join(map(self.a_bytes.__getitem__, i.tolist())) == body == b"".join(map(self.b_bytes.__getitem__, j.tolist()))
                out.append((i, j) if same else None)
            at = to
        return out


@lru_cache(maxsize=2)
def vocabularies(first: str, second: str) -> Vocabularies:
    return Vocabularies(first, second)


NO_IDS = np.zeros(0, np.int64)


@dataclass
class Fragment:
    """``met`` tells whether tokens of both end together somewhere; if not, all tokens are in the prefix."""

    ok: bool = True
    met: bool = False
    prefix: tuple[np.ndarray, np.ndarray] = (NO_IDS, NO_IDS)
    suffix: tuple[np.ndarray, np.ndarray] = (NO_IDS, NO_IDS)
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups: list[str] = field(default_factory=list)
    links: np.ndarray = field(default_factory=lambda: NO_IDS)  # different ones, sorted
    times: np.ndarray = field(default_factory=lambda: NO_IDS)


def _summed(links: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(links, kind="stable")
    links, times = links[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]])) if len(links) else NO_IDS
    return links[first], np.add.reduceat(times, first) if len(first) else times


def align(v: Vocabularies, stretches: list[tuple[np.ndarray, np.ndarray]]) -> list[Fragment]:
    """Closed groups and links of stretches of tokens, each of which begins and ends where tokens of both do."""
    if not stretches:
        return []
    n_a, n_b = (np.array([len(s[k]) for s in stretches]) for k in (0, 1))
    a, b = (np.concatenate([s[k] for s in stretches]) for k in (0, 1))
    end_a, end_b = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
    b_at = np.searchsorted(end_b, end_a)  # the token of the other side over the last byte of each
    a_at = np.searchsorted(end_a, end_b)
    both_a, both_b = end_b[b_at] == end_a, end_a[a_at] == end_b
    inner = np.flatnonzero(~both_b)
    of_a, of_b = np.repeat(np.arange(len(stretches)), n_a), np.repeat(np.arange(len(stretches)), n_b)

    links = np.concatenate([a * v.base + b[b_at], a[a_at[inner]] * v.base + b[inner]])
    owner = np.concatenate([of_a, of_b[inner]])
    span = len(v.a_bytes) * v.base
    unique, times = np.unique(owner * span + links, return_counts=True)
    cut = np.searchsorted(unique, np.arange(len(stretches) + 1) * span)

    # A group's tokens of the first stand before its tokens of the second.
    group_a = np.cumsum(both_a) - both_a
    group_b = np.cumsum(both_b) - both_b
    last_a = np.flatnonzero(both_a) + 1
    last_b = np.flatnonzero(both_b) + 1
    before_b = np.concatenate([[0], last_b[:-1]])
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + before_b[group_a]] = 2 * a + both_a
    kind = both_b.astype(np.int64)
    kind[np.cumsum(n_b) - 1] = 2
    codes[np.arange(len(b)) + last_a[group_b]] = v.b_written + 3 * b + kind

    ends = np.cumsum(n_a + n_b)
    n_groups, n_inner = np.bincount(of_b[both_b], minlength=len(stretches)), np.bincount(of_b[inner], minlength=len(stretches))
    return [
        Fragment(True, True, n_a=int(n_a[i]), n_b=int(n_b[i]), n_groups=int(n_groups[i]), n_links=int(n_a[i] + n_inner[i]),
                 groups=["".join(map(v.written.__getitem__, codes[ends[i] - n_a[i] - n_b[i]: ends[i]].tolist()))],
                 links=unique[cut[i]: cut[i + 1]] - i * span, times=times[cut[i]: cut[i + 1]])
        for i in range(len(stretches))
    ]


def compose(v: Vocabularies, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative."""
    join = lambda s, t: (np.concatenate([s[0], t[0]]), np.concatenate([s[1], t[1]]))
    out = Fragment(x.ok and y.ok, x.met or y.met, n_a=x.n_a + y.n_a, n_b=x.n_b + y.n_b)
    if not out.ok:  # no tokens, whatever else there is
        return Fragment(ok=False)
    closed = [x, y]
    out.prefix, out.suffix = x.prefix, y.suffix
    if not x.met:
        out.prefix = join(x.prefix, y.prefix)
    elif not y.met:
        out.suffix = join(x.suffix, y.prefix)
    else:
        closed = [x, *align(v, [join(x.suffix, y.prefix)]), y]
    out.n_groups, out.n_links = sum(f.n_groups for f in closed), sum(f.n_links for f in closed)
    out.groups = [g for f in closed for g in f.groups]
    out.links, out.times = _summed(np.concatenate([f.links for f in closed]), np.concatenate([f.times for f in closed]))
    return out


def closed_document(v: Vocabularies, x: Fragment) -> Fragment:
    """The fragment of a whole text: its prefix begins where tokens of both do, so it is a group."""
    if not x.ok or not x.met:
        return Fragment(ok=False)
    left = Fragment(met=True)
    return compose(v, left, x)


def ranges(body: bytes, chunk: int) -> list[tuple[int, int, int, int]]:
    """(start, end, from, to) of every byte range and of the text that it is tokenized with."""

    def safe(at: int) -> bool:
        before = body[max(0, at - 4): at].decode("utf-8", "ignore")[-1:]
        after = body[at + 1: at + 5].decode("utf-8", "ignore")[:1]
        return bool(before and after) and not before.isspace() and not after.isspace()

    def near(border: int) -> tuple[int, int] | None:
        """The safe cuts next to a border on both sides, within a quarter of a range."""
        low, high = border + 1, border - 1
        while (low := body.rfind(b" ", max(1, border - chunk // 4), low)) > 0 and not safe(low):
            pass
        while (high := body.find(b" ", high + 1, border + chunk // 4)) > 0 and not safe(high):
            pass
        return (low, high) if low > 0 and high > 0 else None

    borders = [(0, (0, 0))]
    for border in range(chunk, len(body), chunk):
        if (cuts := near(border)) is not None:
            borders.append((border, cuts))
    borders.append((len(body), (len(body), len(body))))
    return [(s, e, low, high) for (s, (low, _)), (e, (_, high)) in zip(borders, borders[1:])]


def fragments(v: Vocabularies, pieces: Iterable[tuple[bytes, int, int, int]]) -> list[Fragment]:
    """Fragments of byte ranges: (text around the range, where that begins, start, end) each."""
    pieces = list(pieces)
    out, middles = [], []
    for (_, at, start, end), ids in zip(pieces, v.encode([p[0] for p in pieces])):
        if ids is None:
            out.append(Fragment(ok=False))
            continue
        a, b = ids
        end_a, end_b = at + np.cumsum(v.a_length[a]), at + np.cumsum(v.b_length[b])
        in_a, in_b = (end_a > start) & (end_a <= end), (end_b > start) & (end_b <= end)
        a, b, end_a, end_b = a[in_a], b[in_b], end_a[in_a], end_b[in_b]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        f = Fragment(True, bool(len(common)), (a, b), n_a=len(a), n_b=len(b))
        if f.met:
            i, j = (np.searchsorted(e, common[[0, -1]]) + 1 for e in (end_a, end_b))
            f.prefix, f.suffix = (a[: i[0]], b[: j[0]]), (a[i[1]:], b[j[1]:])
            if i[1] > i[0]:
                middles.append((f, (a[i[0]: i[1]], b[j[0]: j[1]])))
        out.append(f)
    for (f, _), closed in zip(middles, align(v, [m for _, m in middles])):
        f.n_groups, f.n_links, f.groups, f.links, f.times = closed.n_groups, closed.n_links, closed.groups, closed.links, closed.times
    return out


DONE = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary, "
        "times binary")
OPEN = ("row bigint, doc_id bigint, at bigint, ok boolean, met boolean, prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary, "
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups binary, links binary, times binary")


def _done(rows: pd.DataFrame, found: list[Fragment]) -> pd.DataFrame:
    digest = [hashlib.sha256(";".join(f.groups).encode()).hexdigest() if f.n_a else "" for f in found]
    return pd.DataFrame({
        "row": rows["row"].to_numpy(), "doc_id": rows["doc_id"].astype("Int64").to_numpy(),
        **{c: np.array([getattr(f, c) for f in found], np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")},
        "groups_sha256": digest, "links": [f.links.tobytes() for f in found],
        "times": [f.times.astype("<u4").tobytes() for f in found]})


def _packed(rows: pd.DataFrame, found: list[Fragment]) -> pd.DataFrame:
    ids = lambda part, k: [getattr(f, part)[k].tobytes() for f in found]
    return pd.DataFrame({
        "row": rows["row"].to_numpy(), "doc_id": rows["doc_id"].astype("Int64").to_numpy(), "at": rows["at"].to_numpy(),
        "ok": [f.ok for f in found], "met": [f.met for f in found],
        "prefix_a": ids("prefix", 0), "prefix_b": ids("prefix", 1), "suffix_a": ids("suffix", 0), "suffix_b": ids("suffix", 1),
        **{c: np.array([getattr(f, c) for f in found], np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")},
        "groups": [";".join(f.groups).encode() for f in found], "links": [f.links.tobytes() for f in found],
        "times": [f.times.astype("<i8").tobytes() for f in found]})


def _unpacked(r) -> Fragment:
    ids = lambda x: np.frombuffer(x, np.int64)
    groups = bytes(r.groups).decode()
    return Fragment(r.ok, r.met, (ids(r.prefix_a), ids(r.prefix_b)), (ids(r.suffix_a), ids(r.suffix_b)), r.n_a, r.n_b, r.n_groups, r.n_links,
                    [groups] if groups else [], ids(r.links), ids(r.times))


def _short(docs: DataFrame, first: str, second: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabularies(first, second)
        for batch in batches:
            for at in range(0, len(batch), ALIGNED_AT_ONCE):
                rows = batch.iloc[at: at + ALIGNED_AT_ONCE]
                usable = [i for i, t in enumerate(rows["text"]) if t]
                coded = v.encode([b" " + rows["text"].iat[i].encode() for i in usable])
                kept = [(i, ids) for i, ids in zip(usable, coded) if ids is not None]
                found = [Fragment(ok=False)] * len(rows)
                for (i, _), f in zip(kept, align(v, [ids for _, ids in kept])):
                    found[i] = f
                yield _done(rows, found)

    return docs.mapInPandas(run, DONE)


def _long(docs: DataFrame, first: str, second: str, chunk: int, most_bytes: int, fan_in: int) -> DataFrame:
    n = partitions(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = chunk if vocabularies(first, second).cuttable else 1 << 62
        for batch in batches:
            for r in batch.itertuples(index=False):
                body = b" " + r.text.encode()
                out = [(r.row, r.doc_id, i, s, e, low, body[low:high]) for i, (s, e, low, high) in enumerate(ranges(body, size))]
                frame = pd.DataFrame(out, columns=["row", "doc_id", "at", "start", "end", "begin", "body"])
                yield frame.astype({"doc_id": "Int64"})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabularies(first, second)
        for batch in batches:
            for at in range(0, len(batch), READ_AT_ONCE):
                rows = batch.iloc[at: at + READ_AT_ONCE]
                pieces = zip(map(bytes, rows["body"]), rows["begin"].tolist(), rows["start"].tolist(), rows["end"].tolist())
                yield _packed(rows, fragments(v, pieces))

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Neighbours that stand together, as the rows are sorted: one fragment of each (row, at // fan_in)."""
        v, key, so_far, last = vocabularies(first, second), None, None, None
        for batch in batches:
            for i, r in enumerate(batch.itertuples(index=False)):
                if (r.row, r.at // fan_in) == key:
                    so_far = compose(v, so_far, _unpacked(r))
                    continue
                if key is not None:
                    yield _packed(last, [so_far])
                key, so_far = (r.row, r.at // fan_in), _unpacked(r)
                last = batch.iloc[[i]].assign(at=key[1])
        if key is not None:
            yield _packed(last, [so_far])

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabularies(first, second)
        for batch in batches:
            for i, r in enumerate(batch.itertuples(index=False)):
                yield _done(batch.iloc[[i]], [closed_document(v, _unpacked(r))])

    cuts = docs.mapInPandas(cut, "row bigint, doc_id bigint, at bigint, start bigint, end bigint, begin bigint, body binary")
    level = cuts.repartition(n, "row", "at").mapInPandas(read, OPEN)
    most = -(-(most_bytes + 1) // chunk)
    while most > 1:
        most = -(-most // fan_in)
        up = F.floor(F.col("at") / fan_in)
        level = level.repartition(n, F.col("row"), up).sortWithinPartitions("row", "at").mapInPandas(reduce, OPEN)
    return level.mapInPandas(close, DONE)


def aligned(docs: DataFrame, first: str, second: str, text: str = "text", chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links, times): one stored row per document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    # The two branches number their rows apart, so that they need not agree on what they read.
    short = rows.where(size < chunk).withColumn("row", 2 * F.col("row"))
    parts = _short(short, first, second)
    most = docs.agg(F.max(F.octet_length(text))).first()[0] or 0
    if most >= chunk:
        parts = parts.unionByName(_long(rows.where(size >= chunk).withColumn("row", 2 * F.col("row") + 1), first, second, chunk,
                                        most, fan_in))
    return store(parts, "aligned")


def link_counts(found: DataFrame, base: int) -> DataFrame:
    """(link, count, best): in how many documents each link is, and whether no link of its first id is in more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links, counts = NO_IDS, NO_IDS
        for batch in batches:
            new, n = np.unique(np.frombuffer(b"".join(batch["links"]), np.int64), return_counts=True)
            links, counts = _summed(np.concatenate([links, new]), np.concatenate([counts, n]))
            if len(links) > PAIRS_AT_ONCE:
                yield pd.DataFrame({"link": links, "n": counts})
                links, counts = NO_IDS, NO_IDS
        if len(links):
            yield pd.DataFrame({"link": links, "n": counts})

    counts = found.select("links").mapInPandas(run, "link bigint, n bigint").groupBy("link").agg(F.sum("n").alias("count"))
    counts = store(counts.withColumn("first", F.expr(f"link div {base}")), "link-counts")
    highest = counts.groupBy("first").agg(F.max("count").alias("highest"))
    # One row for each id of the first vocabulary at most.
    return counts.join(F.broadcast(highest), "first").select("link", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, first: str, second: str, text: str = "text", chunk: int = CHUNK, fan_in: int = FAN_IN,
                    frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    found = aligned(docs, first, second, text, chunk, fan_in)
    counts = store(link_counts(found, vocabularies(first, second).base), "counted-links")
    top = most_frequent(counts, "count", frequent).toPandas().sort_values("link")
    table = spark.sparkContext.broadcast((top["link"].to_numpy(np.int64), top["count"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What the frequent links give a document, under a number that is no link, and its other links."""
        known, count, best = table.value
        for batch in batches:
            sizes = np.array([len(x) // 8 for x in batch["links"]], np.int64)
            links = np.frombuffer(b"".join(batch["links"]), np.int64)
            times = np.frombuffer(b"".join(batch["times"]), "<u4").astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), sizes)
            at = np.minimum(np.searchsorted(known, links), max(0, len(known) - 1))
            hit = known[at] == links if len(known) else np.zeros(len(links), bool)
            at, on = at[hit], owner[hit]
            sums, bests = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(sums, on, count[at] * times[hit])
            np.add.at(bests, on, best[at] * times[hit])
            row = batch["row"].to_numpy()
            yield pd.DataFrame({"row": row, "link": -1 - row, "times": np.int64(0), "sum": sums, "bests": bests})
            yield pd.DataFrame({"row": row[owner[~hit]], "link": links[~hit], "times": times[~hit], "sum": np.int64(0),
                                "bests": np.int64(0)})

    parts = found.select("row", "links", "times").mapInPandas(run, "row bigint, link bigint, times bigint, sum bigint, bests bigint")
    parts = parts.join(counts, "link", "left")
    totals = parts.groupBy("row").agg(
        F.sum(F.col("sum") + F.coalesce(F.col("count"), F.lit(0)) * F.col("times")).alias("count_sum"),
        F.sum(F.col("bests") + F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    return found.drop("links", "times").join(totals, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
