"""Packing documents into fixed-length sequences along a space-filling curve.

A document's token ids are hashed into a small vector, projected to a few dimensions by a seeded
matrix and placed on a Hilbert curve, so documents of like content are neighbours. Documents are
range-sorted by that key and laid end to end; sequences are cut from this one line, so only the last
can be short. Places on the line are running sums over sorted partitions plus the totals of the
partitions before, never a sort in one task.

Ids are stored once, with a row number, and meet their places in one join on it; texts are tokenized
once. Words repeat, so each worker keeps the ids of words it has met (a bounded cache) and asks the
tokenizer for new ones only.

Edge cases: a null or empty text has the end id only; equal texts share a key and follow each other by
row number; rows that repeat a doc_id are packed one by one; an empty table gives no piece; texts of any length are encoded whole; extra
columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import partitions, store

LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS, BUCKETS = 3, 10, 256
SEED = 7
CACHE_WORDS = 600_000
LINE_WORDS = 2_000

def crowded(text: str) -> bool:
    """Whether white space stands at an end or in a run. Elsewhere a space always begins a new word of the
    tokenizer, so the text may be cut there."""
    words = text.split()
    return len(text) - sum(map(len, words)) != len(words) - 1


# Fixed value: how byte-level vocabularies of this kind cut text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PROBE = " It's 12 o'clock; naïve café, straße ñandú 日本語 🙂 a,b  c\td\n\ne <|endoftext|> f<|endoftext|>g"


def _byte_of() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: themselves where printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _same_ranks(tokenizer):
    """tiktoken's encoding of the same vocabulary, several times as fast on new words; None where the vocabulary's ids
    are not in the order of its merges, as then both would not agree."""
    import tiktoken

    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    byte_of = _byte_of()
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    try:
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        fast = tiktoken.Encoding("same", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens=special)
        agree = fast.encode(PROBE, allowed_special="all") == tokenizer.encode(PROBE, add_special_tokens=False).ids
    except (KeyError, ValueError):  # a vocabulary that is not byte-level
        return None
    return fast if agree else None


class WordCache:
    """Token ids of texts as little-endian bytes of two (small vocabularies) or four per id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = id_width(size)
        self.words: dict[str, bytes] = {}
        # "\u0120" is how byte-level vocabularies write a space.
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.fast = _same_ranks(self.tokenizer)
        self.checked = False

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, f"<u{self.width}").tobytes() for x in found]

    def _lines(self, lines: list[str]) -> list[np.ndarray]:
        kind = f"<u{self.width}"
        if self.fast is not None:
            ids = [self.fast.encode_to_numpy(x, allowed_special="all").astype(kind) for x in lines]
            if self.checked or [x.tobytes() for x in ids[:4]] == self._encode(lines[:4]):
                self.checked = True  # the first words of a worker are encoded both ways
                return ids
            self.fast = None
        return [np.frombuffer(x, kind) for x in self._encode(lines)]

    def _learn(self, new: list[str]) -> None:
        """Words that begin with a space are encoded in long lines, where each begins at a token that begins
        with a space; one call per word would cost several times as much."""
        plain = [w for w in new if w[0] == " "]
        cut = [plain[at: at + LINE_WORDS] for at in range(0, len(plain), LINE_WORDS)]
        for words, ids in zip(cut, self._lines(["".join(words) for words in cut]) if cut else ()):
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) == len(words) and begins[0] == 0:
                data, ends = ids.tobytes(), (np.append(begins[1:], len(ids)) * self.width).tolist()
                self.words.update(zip(words, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))))
            else:  # a vocabulary of another kind
                self.words.update(zip(words, self._encode(words)))
        rest = [w for w in new if w[0] != " "]
        self.words.update(zip(rest, self._encode(rest)))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:  # words met early are the frequent ones
            self.words = dict(islice(self.words.items(), CACHE_WORDS // 4))
        cut = [None if "\0" in x or crowded(x) else x.replace(" ", "\0 ").split("\0") for x in texts]
        new: dict[str, None] = {}
        for ws in cut:
            if ws is not None:
                new.update(dict.fromkeys(set(ws).difference(self.words)))
        self._learn(list(new))
        whole = iter(self._encode([x for x, ws in zip(texts, cut) if ws is None]))
        word = self.words.__getitem__
        return [next(whole) if ws is None else b"".join(map(word, ws)) for ws in cut]


@lru_cache(maxsize=2)
def _cache(path: str) -> WordCache:
    return WordCache(path)


def id_width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of grid cells (n, dimensions), by Skilling's transform."""
    x = [cells[:, i].astype(np.int64).copy() for i in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the coarsest level down
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ turn) >> b & 1)
    return key


def _projection(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def curve_keys(ids: list[np.ndarray], seed: int = SEED) -> np.ndarray:
    """Hilbert keys of documents given by their ids."""
    vectors = np.zeros((len(ids), BUCKETS))
    for i, row in enumerate(ids):
        hashed = (row.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
        vectors[i] = np.bincount(hashed, minlength=BUCKETS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    at = vectors / np.where(norms == 0, 1, norms) @ _projection(seed)
    cells = np.clip((at + 3.0) / 6.0 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert_key(cells, BITS)


def tokenize(docs: DataFrame, tokenizer: str, text: str = "text", end_id: int = END_ID, seed: int = SEED) -> DataFrame:
    """(row, doc_id, key, n, width, ids): one row per document, ids with the end id, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _cache(tokenizer)
        kind = f"<u{cache.width}"
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            coded = cache.encode(["" if x is None else x for x in batch[text]])
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "key": curve_keys([np.frombuffer(x, kind) for x in coded], seed),
                "n": np.array([len(x) // cache.width + 1 for x in coded], np.int64),
                "width": np.int32(cache.width),
                "ids": [x + end for x in coded],
            })

    coded = docs.select("doc_id", text).mapInPandas(run, "doc_id bigint, key bigint, n bigint, width int, ids binary")
    return coded.withColumn("row", F.monotonically_increasing_id())


def places(coded: DataFrame) -> DataFrame:
    """(row, at): where each document begins on the line."""
    spark = coded.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sum_ = 0
        for batch in batches:
            ends = sum_ + batch["n"].cumsum()
            yield pd.DataFrame({"row": batch["row"], "part": batch["part"], "n": batch["n"], "before": ends - batch["n"]})
            sum_ = int(ends.iloc[-1]) if len(ends) else sum_

    ranged = (
        coded.select("row", "key", "n").repartitionByRange(partitions(spark), "key", "row")
        .sortWithinPartitions("key", "row").withColumn("part", F.spark_partition_id())
        .select("row", "n", "part").mapInPandas(run, "row bigint, part int, n bigint, before bigint")
    )
    ranged = store(ranged, "places")
    # One row per partition.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total")).select(
        "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    return ranged.join(totals, "part").select("row", (F.col("before") + F.col("offset")).alias("at"))


def pack(docs: DataFrame, tokenizer: str, text: str = "text", length: int = LENGTH, end_id: int = END_ID,
         seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, key
    and, if asked for, the ids as bytes of four."""
    coded = store(tokenize(docs, tokenizer, text, end_id, seed), "tokens")
    placed = coded.join(places(coded), "row").select("doc_id", "key", "n", "width", "ids", "at")
    schema = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint, key bigint" + ", ids binary" * with_ids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, key, n, width, ids, at in batch.itertuples(index=False):
                wide = memoryview(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    piece = wide[4 * start: 4 * (start + size)]
                    row = (doc, start, size, zlib.crc32(piece), n, sequence, offset, key)
                    out.append(row + (bytes(piece),) if with_ids else row)
                    start += size
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return placed.mapInPandas(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences as arrays of ids, unpadded."""
    part = F.struct("offset", "ids")
    joined = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int64) for parts in batch["parts"]]
            yield pd.DataFrame({"sequence_id": batch["sequence_id"], "ids": rows})

    return joined.mapInPandas(run, "sequence_id bigint, ids array<bigint>")
