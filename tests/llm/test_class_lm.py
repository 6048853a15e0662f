"""The class model against a plain version of its own formulas, its classes against planted ones."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import class_lm as lm
from ledgerlake.llm.common import store
from ledgerlake.llm.queries import QUERIES

TINY, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, test boolean"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def base_scores(rows):
    """(n_tokens, n_known, train_tokens, base_score) of (text, held out) rows."""
    lines = [words(t) + [None] for t, _ in rows]
    count = collections.Counter(w for line, (_, out) in zip(lines, rows) if not out for w in line)
    total, different = sum(count.values()), len(count)
    for line in lines:
        yield (len(line), sum(count[w] > 0 for w in line), total, sum(math.log10((count[w] + 1) / (total + different + 1)) for w in line))


def test_op12_base_and_held_out(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    want = dict(zip([r.doc_id for r in rows], zip(held, base_scores([(r.text, h) for r, h in zip(rows, held)]))))
    got = QUERIES["op12_brown_class_lm"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        out, (n, known, total, base) = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    # On documents that it has not seen, the model is well above the base.
    model, base, tokens = (sum(getattr(r, c) for r in got if r.held_out) for c in ("score", "base_score", "n_tokens"))
    assert (model - base) / tokens > 0.1


def class_of_words(df, frequent, rounds):
    """Classes as the operator finds them: word -> class."""
    rows = df.select("doc_id", F.col("test").alias("held_out"), "text", F.monotonically_increasing_id().alias("row"))
    top = lm.frequent_words(lm.word_counts(rows.where("not held_out")), frequent)
    texts = store(lm.coded(rows, [w for w, _ in top]), "test")
    near = store(lm.neighbours(texts), "test")
    classes = lm.exchange(near, lm.first_classes(len(top)), rounds)
    found = {w.decode(): int(c) for (w, _), c in zip(top, classes[1:])}
    others = {r.row: r.others for r in texts.collect()}
    for r in lm.other_words(texts, classes, lm.class_pairs(near, classes)).collect():
        found[bytes(others[r.row][r.k]).decode()] = r["class"]
    return found | {None: lm.END}


def plain_scores(rows, class_of):
    lines = [(words(t) + [None], out) for t, out in rows]
    count = collections.Counter(w for line, out in lines if not out for w in line)
    once = lambda w: w is not None and count[w] == 1
    kind = lambda w: class_of[w] if count[w] else lm.UNKNOWN
    pairs, single, size = collections.Counter(), collections.Counter(), collections.Counter()
    for line, out in lines:
        for a, b in zip([None, *line], line) if not out else ():
            size[kind(b)] += 1
            for c in [kind(a)] + [lm.UNKNOWN] * once(a):
                pairs[c, kind(b)] += 1
                single[c] += once(b)
    total = sum(size.values())
    after, kinds = collections.Counter(), collections.Counter()
    for (c, _), n in pairs.items():
        after[c] += n
        kinds[c] += 1

    def p(c, w):
        unknown = (single[c] + 0.5) / (after[c] + 1)
        if not count[w]:
            return unknown
        d = kind(w)
        known = (pairs[c, d] + kinds[c] * size[d] / total) / (after[c] + kinds[c]) if after[c] else size[d] / total
        return (1 - unknown) * known * count[w] / size[d]

    for c in [*size, lm.UNKNOWN, 77]:  # a distribution in every context
        assert math.isclose(sum(p(c, w) for w in [*count, "never seen"]), 1, rel_tol=1e-9)
    return [sum(math.log10(p(kind(a), b)) for a, b in zip([None, *line], line)) for line, _ in lines]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 60, 0])
def test_scores_follow_the_formulas(llm, frequent):
    rows = [(r.doc_id, r.text, r.doc_id % 5 == 1) for r in llm.read.parquet(f"{TINY}/documents.parquet").limit(60).collect()]
    rows += [(None, "one two three two", False), (3, None, False), (3, "", True), (4, " \n", False), (5, "NEVER seen Wörter never", True)]
    df = llm.createDataFrame([(i, t, bool(o)) for i, t, o in rows], SCHEMA)
    clash = df.withColumns({c: F.lit("x") for c in ("row", "n", "word", "codes", "class", "score")})
    got = lm.score_documents(clash, F.col("test"), frequent=frequent, rounds=4).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    texts = [(t, bool(o)) for _, t, o in rows]
    want = zip([i for i, *_ in rows], plain_scores(texts, class_of_words(df, frequent, 4)), base_scores(texts))
    want = sorted(((i, round(s, 6), *b[:3], round(b[3], 6)) for i, s, b in want), key=lambda r: (key(r), r[1]))
    assert sorted(((r.doc_id, round(r.score, 6), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got),
                  key=lambda r: (key(r), r[1])) == want


def test_gains_are_those_of_the_likelihood():
    """Moving a word whose neighbours stay in other classes changes the likelihood by the difference of its gains."""
    rng = np.random.default_rng(6)
    m = rng.integers(0, 50, (lm.SIDES, lm.SIDES))
    f = lambda x: float(lm._xlogx(np.asarray(x, float)).sum())
    value = lambda m: f(m) - f(m.sum(0)) - f(m.sum(1))
    near, side, count = np.array([90, 91, 92, 90]), np.array([0, 0, 1, 1]), np.array([3, 9, 2, 11])
    at = lambda c: [(c, d) if s == 0 else (d, c) for d, s in zip(near, side)]
    for (i, j), n in zip(at(7), count):
        m[i, j] += n

    def with_word_in(c):
        out = m.copy()
        for (i, j), (k, l), n in zip(at(7), at(c), count):
            out[i, j] -= n
            out[k, l] += n
        return value(out)

    best = lm.Gains(m).best(1, np.zeros(4, np.int64), side, near, count, np.array([7]))
    values = {c: with_word_in(c) for c in range(lm.CLASSES) if c not in (90, 91, 92)}
    assert values[int(best[0])] == max(values.values()) or best[0] in (90, 91, 92)
    assert lm.Gains(m).best(2, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == [0, 0]


def test_exchange_finds_planted_kinds(llm):
    """Three kinds of words follow each other in turn; words of a kind end up apart from those of other kinds."""
    rng = random.Random(8)
    kinds = [[f"{k}{i}" for i in range(60)] for k in "abc"]
    texts = [" ".join(rng.choice(kinds[i % 3]) for i in range(90)) for _ in range(120)]
    df = llm.createDataFrame([(i, t, i % 4 == 0) for i, t in enumerate(texts)], SCHEMA)
    found = class_of_words(df, 100, 8)
    members = collections.defaultdict(collections.Counter)
    for w, c in found.items():
        if w:
            members[c][w[0]] += 1
    assert sum(max(m.values()) for m in members.values()) > 0.95 * sum(sum(m.values()) for m in members.values())
    got = lm.score_documents(df, F.col("test"), frequent=100).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1] + 0.3 * 90 * 30


def test_nothing_to_learn_from(llm):
    df = llm.createDataFrame([(1, "a b", True), (2, None, True)], SCHEMA)
    rows = lm.score_documents(df, F.col("test")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}
    assert lm.score_documents(df.where("doc_id < 0"), F.col("test")).count() == 0


def test_lines_are_read_in_short_steps(monkeypatch):
    """However many classes a batch holds, few are widened at a time; contexts go on over steps and end with a text."""
    monkeypatch.setattr(lm, "STEP", 5)
    lines = [[3], [1, 2 | lm.ONCE, 0], [4, 5, 6, 7, 8, 9, 10, 11, 12, 13], [9, 9], [7]]
    steps = list(lm._steps(pd.DataFrame({"line": [bytes(x) for x in lines]})))
    assert max(len(now) for now, _, _ in steps) == 5
    got = [tuple(map(int, x)) for step in steps for x in zip(*step)]
    assert got == [(now, before, i) for i, x in enumerate(lines) for before, now in zip([lm.END, *x], x)]


def test_gains_by_sums_and_by_sorting_agree():
    rng = np.random.default_rng(3)
    gains, n = lm.Gains(rng.integers(0, 40, (lm.SIDES, lm.SIDES))), 300
    owner = np.sort(rng.integers(0, 3, n))
    side, near, count = rng.integers(0, 2, n), rng.integers(0, lm.CLASSES, n), rng.integers(1, 60, n)
    dense = gains.best(3, owner, side, near, count)
    assert (gains.best(600, owner, side, near, count)[:3] == dense).all()


def test_words_and_where_they_begin():
    texts = [" A b\x0bc\x1cD\x85 \n", "", None, " \t", "É Ä　Ö", "x"]
    got, starts = lm._words(pa.array(texts))
    got = [w.decode() for w in got.to_pylist()]
    assert [got[i:j] for i, j in zip(starts[:-1], starts[1:])] == [words(t) for t in texts]


def test_pairs_of_words_are_packed_whole():
    for counts in ([1, 2**32 - 1, 3], [2**32, 1, 2**40], []):
        word, other = np.array([0, 7, 65534])[:len(counts)], np.array([65534, 0, 65534])[:len(counts)]
        got = lm._entries(*lm._packed(word, other, np.array(counts, np.int64)))
        assert [x.tolist() for x in got] == [word.tolist(), other.tolist(), counts]


def test_other_words_travel_in_blocks_and_buckets(llm):
    """Documents share rows, and so do the words asked for; each gets the count and the class that its occurrences ask for."""
    found = llm.read.parquet(f"{TINY}/documents.parquet").limit(150).collect()
    rows = [(i, r.text, i % 5 == 1) for i, r in enumerate(found)] + [(900, "once never twice", False), (901, "unseen", True)]
    df = llm.createDataFrame(rows, SCHEMA).repartition(2).select("doc_id", F.col("test").alias("held_out"), "text",
                                                                   F.monotonically_increasing_id().alias("row"))
    top = lm.frequent_words(lm.word_counts(df.where("not held_out")), 80)
    texts = store(lm.coded(df, [w for w, _ in top]), "test")
    near = store(lm.neighbours(texts), "test")
    classes = lm.exchange(near, lm.first_classes(len(top)), 2)
    matrix = lm.class_pairs(near, classes)
    finer = store(lm.neighbours(texts, 400 << 20), "test")
    assert finer.count() > near.count() and (lm.class_pairs(finer, classes) == matrix).all()
    assert (lm.exchange(finer, lm.first_classes(len(top)), 2) == classes).all()
    assert texts.count() < len(rows) / 5
    assert sorted(i for r in texts.collect() for i in r.doc_id) == sorted(i for i, _, _ in rows)
    packed = lm.answers(texts, classes, matrix, 0)
    assert packed.count() <= texts.count() * lm.dealt(texts, 0, lm.BUCKET) and packed.count() < lm.other_words(texts, classes, matrix).count() / 5

    class_of = {w.decode(): int(c) for (w, _), c in zip(top, classes[1:])} | {None: lm.END}
    contexts, gains = collections.defaultdict(list), lm.Gains(matrix)
    for _, text, out in rows:
        line = [None, *words(text), None]
        for i, w in enumerate(line[1:-1], 1):
            if w not in class_of:
                contexts[w] += [] if out else [(s, class_of[x]) for s, x in ((1, line[i - 1]), (0, line[i + 1])) if x in class_of]
    count = collections.Counter(w for _, text, out in rows if not out for w in words(text))
    want = {w: (count[w], int(gains.best(1, np.zeros(len(c), np.int64), *np.array(c, np.int64).reshape(-1, 2).T, np.ones(len(c), np.int64))[0])
                if count[w] else lm.UNKNOWN) for w, c in contexts.items()}
    others = {r.row: r.others for r in texts.collect()}
    for tokens in (0, 40 << 20):  # the more there are, the more buckets
        got = [(bytes(others[r.row][r.k]).decode(), (r.n, r["class"])) for r in lm.other_words(texts, classes, matrix, tokens).collect()]
        assert dict(got) == want and len(got) == sum(map(len, others.values()))
    assert lm.dealt(texts, 40 << 20, lm.BUCKET) > lm.dealt(texts, 0, lm.BUCKET)
