"""Language-model scores of a Brown class-based bigram model whose classes are found by exchange.

P(word | previous word) = P(class of the word | class of the previous word) * P(word | its class). Exchange
clustering moves a word to the class that raises the likelihood of the training text most, given the classes of all
other words.

* Word counts are exact and cover all training documents. The ``FREQUENT`` words of the highest counts, a list of bounded
  size, get numbers, and documents are stored as numbers, some hundred to a row (a block, of training or of held-out ones); other
  words stand in each block's own list.
* Neighbour counts of the frequent words are gathered once, dealt by word, and stored; each round of
  exchange maps over that table without a shuffle: all words of one half move at once, against the class counts of
  the round before (a 128 x 128 table), then those of the other half.
* Every other word takes the class that its neighbours in all training documents ask for, by the same measure, in one
  shuffle by buckets of words, which also gives its count; no such word can be a hot key, as frequent words are not among them, and
  the number of buckets follows that of these words. Counts and classes come back to the blocks in one join.
* Transitions are counted over the class sequences of all training documents, and smoothed: a class c
  is followed by an unknown word as often as by a word that occurs once in training (such a word would be unknown without
  this occurrence), and what follows an unknown word is what follows such words; known classes
  are interpolated with their overall shares, by the number of different classes seen after c (Witten-Bell). Probabilities of all
  known words and the one unknown event sum to 1 in every context, as they do in the base model.

Edge cases: a null, empty or blank text is the end token alone. Rows that repeat a doc_id, or have none, are documents of
their own; rows without a doc_id are learned from. Texts of any length are scored whole. Ties go to the class
of the smaller number, and a class without words stays empty. Without training documents every token is unknown. An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, most_frequent, partitions, store

FREQUENT = 65_534
END_CODE, OTHER = 0, 65_535  # frequent words have the numbers between
CLASSES = 126
END, UNKNOWN, SIDES = 126, 127, 128  # classes of their own, and how many there are
ONCE = 0x80  # marks a word that occurs once in training, in a class sequence
ROUNDS = 8
HELD = 3 << 17  # different words, or pairs of them, that a task holds before it hands on their counts
SLICE = 1 << 17  # tokens whose pairs are counted at a time
PIECE = 1 << 18  # pairs in a row of the neighbour table, about
CODED, BLOCK_BYTES = 256, 1 << 19  # documents of a block at most, and the bytes of text after which it ends
SHARD = 1 << 21  # tokens whose neighbour counts are merged together, about
BUCKET = 1 << 19  # words of blocks that are classified together, about
WORDS = 1 << 12  # words that are tried on all classes at a time
UNSEEN = 255  # in place of the class of a neighbour that is not frequent
BLOCK = 1 << 12  # neighbour counts that are tried on all classes at a time
STEP = 1 << 16  # classes of lines that are counted or scored at a time


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts one after the other, and where those of each text begin, and the last ones end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    words, starts = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    full = pc.greater(pc.binary_length(words), 0)  # blanks at an end of a text leave an empty one
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full).cast(pa.binary()), before[starts]


def _summed(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return found.select(["word", "n_sum"]).rename_columns(["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            found = _words(batch["text"])[0].value_counts()
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            if sum(map(len, held)) > HELD:
                held = [_summed(held)]
                if len(held[0]) > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=HELD // 4)
                    held = []
        if held:
            yield from _summed(held).to_batches(max_chunksize=HELD // 4)

    return docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _lists(starts: np.ndarray, values: pa.Array | np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def coded(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """(row, held_out, doc_id, sizes, codes, at, others) of ``docs (row, doc_id, held_out, text)``, some documents to a row,
    which has the number of the first: their ids and numbers of tokens; numbers of the words, and the end after each
    document; for each word that is not frequent the place in ``others``, the different ones of these documents."""
    known = docs.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(words)})

    def block(docs: pa.RecordBatch) -> pa.RecordBatch:
        words, starts = _words(docs["text"])
        found = words.dictionary_encode()
        different = found.dictionary
        code = np.fromiter(map(known.value.get, different.to_numpy(zero_copy_only=False), repeat(OTHER)), np.uint16, len(different))
        index = found.indices.to_numpy()
        sizes = np.diff(starts) + 1
        codes = np.full(len(index) + len(docs), END_CODE, np.uint16)
        is_word = np.ones(len(codes), bool)
        is_word[np.cumsum(sizes) - 1] = False
        codes[is_word] = code[index]
        other = code == OTHER
        at = (np.cumsum(other) - 1).astype(np.uint32)[index[other[index]]]
        others = different.filter(pa.array(other))
        return pa.RecordBatch.from_pydict({
            "row": docs["row"][:1], "held_out": docs["held_out"][:1], "doc_id": _lists([0, len(docs)], docs["doc_id"]),
            "sizes": _lists([0, len(docs)], sizes.astype(np.int64)), "codes": pa.array([codes.tobytes()], pa.binary()),
            "at": pa.array([at.tobytes()], pa.binary()), "others": _lists([0, len(others)], others)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held_out in (False, True):
                docs = batch.filter(pc.equal(batch["held_out"], held_out))
                bytes_ = np.cumsum(pc.fill_null(pc.binary_length(docs["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
                first = 0
                while first < len(docs):
                    before = bytes_[first - 1] if first else 0
                    end = min(int(np.searchsorted(bytes_, before + BLOCK_BYTES)) + 1, first + CODED, len(docs))
                    yield block(docs.slice(first, end - first))
                    first = end

    return docs.select("row", "doc_id", "held_out", "text").mapInArrow(
        run, "row bigint, held_out boolean, doc_id array<bigint>, sizes array<bigint>, codes binary, at binary, others array<binary>")


def _planes(x: np.ndarray) -> bytes:
    """Little-endian numbers byte plane by byte plane, which compresses better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _flat(x: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed(word: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted pairs and their counts, of four bytes where that is enough."""
    key = (word << 16 | other).astype(np.uint32)
    small = not len(n) or n.max() < 2**32
    return _planes(np.diff(key, prepend=np.uint32(0))), _planes(n.astype(np.uint32 if small else np.int64))


def _entries(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, neighbours and counts."""
    key = np.cumsum(_flat(keys, "<u4"), dtype=np.uint32)
    return key >> 16, key & 0xFFFF, _flat(counts, "<u4" if len(counts) == len(keys) else "<i8")


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def dealt(docs: DataFrame, tokens: int, most: int) -> int:
    """How many parts tokens are dealt to if a part should hold ``most``, about: a multiple of the tasks."""
    tasks = partitions(docs.sparkSession)
    return tasks * max(1, math.ceil(tokens / (tasks * most)))


def neighbours(docs: DataFrame, tokens: int = 0) -> DataFrame:
    """(half, right, right_n, left, left_n): how often frequent words stand next to each other: pairs of a word and its neighbour to the
    right, and to the left, each with their counts. All pairs of a word are in one row, with words of the same half. A task merges
    shards of words one after the other, the more of them the more ``tokens`` there are."""
    tasks, shards = partitions(docs.sparkSession), dealt(docs, tokens, SHARD)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(pair: np.ndarray, n: np.ndarray) -> Iterator[pd.DataFrame]:
            for side in (0, 1):
                word, other = (pair >> 16, pair & 0xFFFF) if side == 0 else (pair & 0xFFFF, pair >> 16)
                shard = word % shards
                order = np.argsort(shard << 32 | word << 16 | other)
                word, other, shard, count = word[order], other[order], shard[order], n[order]
                cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
                yield pd.DataFrame([(int(shard[i]), side, *_packed(word[i:j], other[i:j], count[i:j]))
                                    for i, j in zip(cuts[:-1], cuts[1:])], columns=["shard", "side", "keys", "counts"])

        keys, counts, size = [], [], 0
        for batch in batches:
            codes = np.frombuffer(np.uint16(END_CODE).tobytes() + b"".join(batch["codes"]), np.uint16)
            for at in range(0, len(codes) - 1, SLICE):
                line = codes[at: at + SLICE + 1].astype(np.int64)
                left, right = line[:-1], line[1:]
                both = (left != OTHER) & (right != OTHER)
                key, n = np.unique(left[both] << 16 | right[both], return_counts=True)
                keys.append(key)
                counts.append(n.astype(np.int64))
                size += len(key)
                if size > HELD:
                    key, n = _merged(keys, counts)
                    keys, counts, size = [key], [n], len(key)
                    if size > HELD // 2:
                        yield from out(key, n)
                        keys, counts, size = [], [], 0
        if size:
            yield from out(*_merged(keys, counts))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(key: np.ndarray, n: np.ndarray) -> Iterator[pd.DataFrame]:
            at = 0
            while at < len(key):  # cut where a word ends
                to = int(np.searchsorted(key, (key[min(at + PIECE, len(key)) - 1] >> 17) + 1 << 17))
                mine, count = key[at:to], n[at:to]
                half, side, at = _half(mine >> 17), mine >> 16 & 1, to
                for h in (0, 1):
                    sides = [np.flatnonzero((half == h) & (side == s)) for s in (0, 1)]
                    packed = [_packed(mine[i] >> 17, mine[i] & 0xFFFF, count[i]) for i in sides]
                    if len(sides[0]) + len(sides[1]):
                        yield pd.DataFrame([(h, *packed[0], *packed[1])], columns=["half", "right", "right_n", "left", "left_n"])

        shard, keys, counts, size = None, [], [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.shard != shard:
                    if keys:
                        yield from out(*_merged(keys, counts))
                    shard, keys, counts, size = r.shard, [], [], 0
                word, other, n = _entries(r.keys, r.counts)
                keys.append(word.astype(np.int64) << 17 | r.side << 16 | other)
                counts.append(n.astype(np.int64))
                size += len(keys[-1])
                if size > HELD:
                    key, n = _merged(keys, counts)
                    keys, counts, size = [key], [n], min(len(key), HELD // 2)  # merged again after as many more
        if keys:
            yield from out(*_merged(keys, counts))

    found = docs.where("not held_out").select("codes").mapInPandas(pairs, "shard int, side int, keys binary, counts binary")
    found = found.repartitionById(tasks, "shard").sortWithinPartitions("shard")
    return found.mapInPandas(merge, "half int, right binary, right_n binary, left binary, left_n binary")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


class Gains:
    """What the log likelihood gains if a word joins a class, given the counts of class pairs."""

    SMALL = 16  # up to this count gains are looked up

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix.astype(np.float64)
        self.sides = [np.ascontiguousarray(self.matrix.T), self.matrix]  # by the neighbour's class: right, left
        self.totals = [self.matrix.sum(1), self.matrix.sum(0)]
        self.now = [_xlogx(m) for m in self.sides]
        self.small = [np.stack([_xlogx(m + r) - x for r in range(self.SMALL + 1)]) for m, x in zip(self.sides, self.now)]

    def best(self, n: int, owner: np.ndarray, side: np.ndarray, near: np.ndarray, count: np.ndarray,
             current: np.ndarray | None = None) -> np.ndarray:
        """The best class of each of ``n`` words with neighbours (owner, side, class, count); ``current`` classes, where
        given, are without the word before it is tried on them."""
        key = (owner * 2 + side) * SIDES + near
        if 2 * SIDES * n <= 4 * len(key):  # the sums of all keys are then no larger than what a sort takes
            sums = np.bincount(key, count, 2 * SIDES * n)  # whole numbers, exact below 2 ** 53
            key = np.flatnonzero(sums)
            count = sums[key].astype(np.int64)
        else:
            key, count = _merged([key], [count])
        owner, side, near = key // (2 * SIDES), key // SIDES % 2, key % SIDES
        gain = np.zeros((n, SIDES))
        for s in (0, 1):
            mine = np.flatnonzero(side == s)
            for at in range(0, len(mine), BLOCK):
                i = mine[at: at + BLOCK]
                o, d, r = owner[i], near[i], count[i]
                value = self.small[s][np.minimum(r, self.SMALL), d]
                big = np.flatnonzero(r > self.SMALL)
                value[big] = _xlogx(self.sides[s][d[big]] + r[big, None]) - self.now[s][d[big]]
                if current is not None:
                    k = np.arange(len(i)), current[o]
                    x = self.sides[s][d, current[o]]
                    value[k] = _xlogx(x) - _xlogx(np.maximum(x - r, 0))
                starts = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
                gain[o[starts]] += np.add.reduceat(value, starts, axis=0)
            sums, total = np.bincount(owner[mine], count[mine], n), self.totals[s]
            different, which = np.unique(sums, return_inverse=True)
            for at in range(0, len(different), BLOCK):
                change = _xlogx(total + different[at: at + BLOCK, None]) - _xlogx(total)
                of = np.flatnonzero((which >= at) & (which < at + BLOCK))
                for i in range(0, len(of), BLOCK):
                    o = of[i: i + BLOCK]
                    less = change[which[o] - at]
                    if current is not None:
                        k, x = (np.arange(len(o)), current[o]), total[current[o]]
                        without = np.maximum(x - sums[o], 0)
                        less[k] = _xlogx(without + sums[o]) - _xlogx(without)
                    gain[o] -= less
        # Words decide at the same time, so an empty class would draw words of all kinds at once.
        empty = np.flatnonzero(self.totals[0] + self.totals[1] == 0)
        own = None if current is None else gain[np.arange(n), current]
        gain[:, empty] = -np.inf
        if current is not None:
            gain[np.arange(n), current] = own
        return np.argmax(gain[:, :CLASSES], axis=1).astype(np.uint8)


def class_pairs(near: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs of frequent words."""
    table = near.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(SIDES * SIDES, np.int64)
        for batch in batches:
            for r in batch.itertuples(index=False):
                word, other, n = _entries(r.right, r.right_n)
                at = table.value[word].astype(np.int64) * SIDES + table.value[other]
                cells += np.bincount(at, n, SIDES * SIDES).astype(np.int64)  # exact below 2 ** 53
        at = np.flatnonzero(cells)
        yield pd.DataFrame({"cell": at, "n": cells[at]})

    return _summed_cells(near.select("right", "right_n").mapInPandas(run, "cell bigint, n bigint"))


def _summed_cells(cells: DataFrame) -> np.ndarray:
    out = np.zeros(SIDES * SIDES, np.int64)
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # 128 x 128 rows at most
        out[r.cell] = r.n
    return out.reshape(SIDES, SIDES)


def first_classes(n_words: int) -> np.ndarray:
    """Classes before the first round: in turn by falling count."""
    return np.concatenate([[END], np.arange(n_words) % CLASSES]).astype(np.uint8)


def exchange(near: DataFrame, classes: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of the frequent words after the given number of rounds."""
    context = near.sparkSession.sparkContext
    for at in range(rounds):
        state = context.broadcast((classes, class_pairs(near, classes)))

        def run(batches: Iterator[pd.DataFrame], state=state) -> Iterator[pd.DataFrame]:
            now, matrix = state.value
            gains = Gains(matrix)
            for batch in batches:
                for r in batch.itertuples(index=False):
                    pairs = [_entries(r.right, r.right_n), _entries(r.left, r.left_n)]
                    word, other, n = (np.concatenate(x) for x in zip(*pairs))
                    side = np.repeat([0, 1], [len(x[0]) for x in pairs])
                    if not word.all():  # the end stays
                        word, other, n, side = (x[word != END_CODE] for x in (word, other, n, side))
                    here = np.zeros(OTHER, bool)
                    here[word] = True
                    ids, owner = np.flatnonzero(here), (np.cumsum(here) - 1)[word]
                    best = gains.best(len(ids), owner, side, now[other].astype(np.int64), n, now[ids].astype(np.int64))
                    changed = best != now[ids]
                    yield pd.DataFrame({"word": ids[changed], "to": best[changed].astype(np.int16)})

        moving = near.where(F.col("half") == at % 2)
        moved = moving.mapInPandas(run, "word bigint, to smallint").toPandas()  # a row for each frequent word at most
        classes = classes.copy()
        classes[moved["word"]] = moved["to"]
        if not len(moved) and at % 2:
            break
    return classes


def _half(word: np.ndarray) -> np.ndarray:
    """0 or 1 by a hash, so that halves mix frequent and less frequent words."""
    return (word * 2654435761 >> 15) & 1


def _hosts(docs: DataFrame, classes: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, row, k, others, n, near): other words of a block of documents that fall into a bucket, their places in the block's list,
    counts in training and the classes left and right of each occurrence."""
    table = np.full(OTHER + 1, UNSEEN, np.uint8)
    table[:len(classes)] = classes
    state = docs.sparkSession.sparkContext.broadcast(table)

    def block(r: dict, others: pa.Array) -> pa.RecordBatch:
        size = len(others)
        bucket = np.fromiter(map(zlib.crc32, others.to_numpy(zero_copy_only=False)), np.uint32, size) % buckets
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        if r["held_out"]:
            n, near = np.zeros(size, np.int32), b""
        else:
            codes, at = np.frombuffer(r["codes"], np.uint16), np.frombuffer(r["at"], np.uint32)
            rank = np.empty(size, np.int64)
            rank[order] = np.arange(size)
            rank = rank[at]
            place = np.flatnonzero(codes == OTHER)[np.argsort(rank, kind="stable")]
            left = np.where(place > 0, codes[place - 1], END_CODE)
            near = np.stack([state.value[left], state.value[codes[place + 1]]], axis=1).tobytes()
            n = np.bincount(rank, minlength=size).astype(np.int32)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[cuts] * 2
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(bucket[cuts[:-1]], pa.int32()), "row": pa.array(np.full(len(cuts) - 1, r["row"])),
            "k": _lists(cuts, order.astype(np.int32)), "others": _lists(cuts, others.take(pa.array(order))), "n": _lists(cuts, n),
            "near": pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(near)])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, others in zip(batch.select(["row", "held_out", "codes", "at"]).to_pylist(), batch["others"]):
                if len(others.values):
                    yield block(r, others.values)

    return docs.select("row", "held_out", "codes", "at", "others").mapInArrow(
        run, "bucket int, row bigint, k array<int>, others array<binary>, n array<int>, near binary")


def answers(docs: DataFrame, classes: np.ndarray, matrix: np.ndarray, words: int) -> DataFrame:
    """(row, k, n, class), lists of the other words of each block that fell into a bucket: their counts in training and their classes.
    ``words`` is about how many tokens are not frequent."""
    state, buckets = docs.sparkSession.sparkContext.broadcast(matrix), dealt(docs, words, BUCKET)

    def best_of(gains: Gains, owner: np.ndarray, total: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Classes of words from the (left, right) classes of their occurrences, ``owner`` being the word of each."""
        best = np.full(len(total), UNKNOWN, np.uint8)

        def tried(n: int, of: np.ndarray, near: np.ndarray) -> np.ndarray:
            code, of, side = near.T.ravel().astype(np.int64), np.concatenate([of, of]), np.repeat([1, 0], len(of))
            use = code != UNSEEN
            return gains.best(n, of[use], side[use], code[use], np.ones(int(use.sum()), np.int64))

        once = total[owner] == 1  # words between the same two classes ask for the same one
        pair, which = np.unique(near[once].astype(np.int64) @ [256, 1], return_inverse=True)
        alike = [tried(len(p), np.arange(len(p)), np.stack([p >> 8, p & 0xFF], axis=1)) for p in np.split(pair, range(WORDS, len(pair), WORDS))]
        best[owner[once]] = np.concatenate(alike)[which]
        more = np.flatnonzero(~once)
        more = more[np.argsort(owner[more], kind="stable")]
        ids = np.flatnonzero(total > 1)
        ends = np.concatenate([[0], np.cumsum(total[ids])])
        for at in range(0, len(ids), WORDS):
            mine = ids[at: at + WORDS]
            i = more[ends[at]: ends[at + len(mine)]]
            best[mine] = tried(len(mine), np.repeat(np.arange(len(mine)), total[mine]), near[i])
        return best

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(state.value)

        def out(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = pa.concat_arrays([x["others"].flatten() for x in parts]).dictionary_encode()
            owner = found.indices.to_numpy()
            n = np.concatenate([x["n"].flatten().to_numpy() for x in parts])
            total = np.bincount(owner, n, len(found.dictionary)).astype(np.int64)
            near = np.frombuffer(b"".join(y for x in parts for y in x["near"].to_pylist()), np.uint8).reshape(-1, 2)
            best, at = best_of(gains, np.repeat(owner, n), total, near), 0
            for x in parts:
                starts = np.concatenate([[0], np.cumsum(pc.list_value_length(x["k"]).to_numpy())])
                mine = owner[at: at + starts[-1]]
                at += starts[-1]
                yield pa.RecordBatch.from_pydict({"row": x["row"], "k": _lists(starts, x["k"].flatten()), "n": _lists(starts, total[mine]),
                                                  "class": _lists(starts, best[mine].astype(np.int16))})

        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch["bucket"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
            for i, j in zip(cuts[:-1], cuts[1:]):
                if held and held[-1]["bucket"][0].as_py() != bucket[i]:
                    yield from out(held)
                    held = []
                held.append(batch.slice(i, j - i))
        if held:
            yield from out(held)

    found = _hosts(docs, classes, buckets).repartitionById(partitions(docs.sparkSession), "bucket").sortWithinPartitions("bucket")
    return found.mapInArrow(classify, "row bigint, k array<int>, n array<bigint>, class array<smallint>")


def other_words(docs: DataFrame, classes: np.ndarray, matrix: np.ndarray, words: int = 0) -> DataFrame:
    """(row, k, n, class) of the k-th other word of each block of documents: its count in training and its class."""
    return answers(docs, classes, matrix, words).selectExpr("row", "inline(arrays_zip(k, n, class))")


@dataclass
class Counts:
    """Training counts of the frequent words, tokens and different tokens."""

    frequent: np.ndarray  # by number; the end first
    tokens: int
    different: int


def resolved(docs: DataFrame, others: DataFrame, counts: Counts, classes: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, emission, line): per document the base score, the sum of the
    logarithms of its words' counts, and its line of classes. ``others`` are the ``answers`` to these ``docs``."""
    state = docs.sparkSession.sparkContext.broadcast((counts, classes))

    def run(block: pa.Table, own: pa.Table) -> pa.Table:
        counts, classes = state.value
        r = block.select(["held_out", "codes", "at"]).to_pylist()[0]
        doc_id, sizes = (pc.list_flatten(block[c]).combine_chunks() for c in ("doc_id", "sizes"))
        sizes = sizes.to_numpy()
        codes, at = np.frombuffer(r["codes"], np.uint16), np.frombuffer(r["at"], np.uint32)
        other = np.flatnonzero(codes == OTHER)
        codes = np.where(codes == OTHER, END_CODE, codes)
        n, line = counts.frequent[codes], classes[codes]
        if len(other):
            ks, own_n, own_class = (pc.list_flatten(own[c]).to_numpy() for c in ("k", "n", "class"))
            place = np.empty(len(ks), np.int64)
            place[ks] = np.arange(len(ks))
            n[other], line[other] = own_n[place[at]], own_class[place[at]]
        known = n > 0
        line[~known] = UNKNOWN
        ends = np.cumsum(sizes)
        starts = ends - sizes  # a document holds one token at least, its end
        base = np.add.reduceat(np.log10((n + 1) / (counts.tokens + counts.different + 1)), starts)
        emission = np.add.reduceat(np.log10(np.maximum(n, 1)), starts)
        once = n == 1
        once[ends - 1] = False  # the end is never unknown once it was seen
        line = line | once * np.uint8(ONCE)
        offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32))
        return pa.table({"doc_id": doc_id, "held_out": pa.repeat(r["held_out"], len(sizes)), "n_tokens": sizes,
                         "n_known": np.add.reduceat(known.astype(np.int64), starts), "base_score": base, "emission": emission,
                         "line": pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(line)])})

    return docs.drop("others").groupBy("row").cogroup(others.groupBy("row")).applyInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, emission double, line binary")


def _steps(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The lines of a batch, ``STEP`` classes at a time: marked classes, the ones before them, and the document of each."""
    ends = np.cumsum([len(x) for x in batch["line"]])
    line = np.frombuffer(b"".join(batch["line"]), np.uint8)
    begins = np.append(0, ends[:-1])  # a line holds one class at least
    for at in range(0, len(line), STEP):
        now = line[at: at + STEP]
        before = np.append(line[at - 1] if at else END, now[:-1]).astype(np.uint8)
        low, high = np.searchsorted(begins, [at, at + STEP])
        before[begins[low:high] - at] = END  # a text begins as if after an end
        yield now, before, np.searchsorted(ends, np.arange(at, at + len(now)), "right")


def transitions(lines: DataFrame) -> np.ndarray:
    """Counts of class pairs in training. The last column counts words that occur once, the last row what follows them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(SIDES * SIDES, np.int64)
        for batch in batches:
            for now, before, _ in _steps(batch):
                once, after_once = now >= ONCE, before >= ONCE
                now, before = (now & 0x7F).astype(np.int64), (before & 0x7F).astype(np.int64)
                cells += np.bincount(before * SIDES + now, minlength=SIDES * SIDES)
                cells += np.bincount(before[once] * SIDES + UNKNOWN, minlength=SIDES * SIDES)
                cells += np.bincount(UNKNOWN * SIDES + now[after_once], minlength=SIDES * SIDES)
                cells[UNKNOWN * SIDES + UNKNOWN] += int((once & after_once).sum())
        at = np.flatnonzero(cells)
        yield pd.DataFrame({"cell": at, "n": cells[at]})

    return _summed_cells(lines.where("not held_out").select("line").mapInPandas(run, "cell bigint, n bigint"))


def smoothed(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log10 probabilities of the next class by class, and log10 of the tokens of each class."""
    seen, once = pairs[:, :UNKNOWN].astype(np.float64), pairs[:, UNKNOWN].astype(np.float64)
    size = seen[:UNKNOWN].sum(0)  # tokens of each class
    share = size / max(size.sum(), 1.0)
    after, kinds = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True).astype(np.float64)
    unknown = (once + 0.5) / (after[:, 0] + 1.0)
    known = np.where(after > 0, (seen + kinds * share) / np.maximum(after + kinds, 1.0), share)
    out = np.concatenate([known * (1 - unknown)[:, None], unknown[:, None]], axis=1)
    return np.log10(np.maximum(out, np.finfo(float).tiny)), np.log10(np.maximum(np.append(size, 1.0), 1.0))


def scored(lines: DataFrame, pairs: np.ndarray) -> DataFrame:
    state = lines.sparkSession.sparkContext.broadcast(smoothed(pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step, size = state.value
        for batch in batches:
            if not len(batch):
                continue
            parts = np.zeros(len(batch))
            for now, before, owner in _steps(batch):
                now, before = now & 0x7F, before & 0x7F
                first = owner[0]
                found = np.bincount(owner - first, step[before, now] - size[now])
                parts[first: first + len(found)] += found
            yield batch.drop(columns=["line", "emission"]).astype({"doc_id": "Int64"}).assign(score=parts + batch["emission"])

    return lines.mapInPandas(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    found = ((bytes(r.word), r.n) for r in most_frequent(counts, "n", most).collect())
    return sorted(found, key=lambda x: (-x[1], x[0]))


def score_documents(docs: DataFrame, held_out: Column, text: str = "text", frequent: int = FREQUENT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row of ``docs``; learned from the
    rows that are not ``held_out``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    n_docs = rows.where("not held_out").count()
    words = store(word_counts(rows.where("not held_out")), "word-counts")
    total = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    top = frequent_words(words, min(frequent, FREQUENT))
    discard(words)
    counts = Counts(np.array([n_docs, *(n for _, n in top)], np.int64), total.n + n_docs, total.v + (n_docs > 0))

    texts = store(coded(rows, [w for w, _ in top]), "coded")
    near = store(neighbours(texts, counts.tokens), "neighbours")
    classes = exchange(near, first_classes(len(top)), rounds)
    matrix = class_pairs(near, classes)
    discard(near)
    rest = total.n - sum(n for _, n in top)  # without held-out documents, whose share is the caller's
    lines = store(resolved(texts, answers(texts, classes, matrix, rest), counts, classes), "class-lines")
    discard(texts)
    found = scored(lines, transitions(lines))
    return found.withColumns({"train_tokens": F.lit(counts.tokens).cast("long"),
                              "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))})
