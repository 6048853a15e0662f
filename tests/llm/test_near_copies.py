"""Near copies of the pipeline against a brute force over all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import common, near_copies
from tests.llm.test_queries import least_reachable

TINY = "/root/testdata/sf0.001/documents.parquet"


def brute_shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {" ".join(words[i: i + 5]) for i in range(max(1, len(words) - 4))}


def brute_components(rows):
    sets = [brute_shingles(t) for _, t in rows]
    near = lambda x: [y for y, s in enumerate(sets) if 5 * len(s & sets[x]) >= 4 * len(s | sets[x])]
    return least_reachable([i for i, _ in rows], near)


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def clash(df):
    """Columns whose names the operator uses itself."""
    return df.withColumns({c: F.lit("x") for c in ("rid", "k1", "k2", "n", "token", "tokens", "hub", "root", "kept", "a", "b")})


@pytest.mark.parametrize("hot, part", [(1000, 2048), (3, 2048), (3, 4)])
def test_components_are_those_of_all_pairs(llm, hot, part, monkeypatch):
    rng = random.Random(7)
    texts = ["", " \n", None, "one", "ONE ", "a b c d e", "a b c d e f"]
    for _ in range(25):
        words = [f"w{rng.randrange(10**5)}" for _ in range(rng.choice([8, 20, 60, 200]))]
        texts += [" ".join(words), *(edited(rng, words, rng.randint(0, max(1, len(words) // 40))) for _ in range(6))]
        texts += [" ".join(words[: len(words) * k // 20]) for k in (15, 16, 17, 18)]
    rows = list(enumerate(texts))
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(near_copies, "PART", part)
    monkeypatch.setattr(near_copies, "HELD", 50 if part < 9 else 1 << 20)
    found = near_copies.near_copies(clash(df), hot=hot).collect()
    got, want = {r.doc_id: r.component_id for r in found}, brute_components(rows)
    assert [got[i] for i, _ in rows] == want
    assert sorted(r.doc_id for r in found if r.kept) == sorted(set(want))
    assert near_copies.near_copies(df.where("doc_id < 0")).count() == 0


def test_stage_takes_near_copies_beyond_four_bits(llm):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, edited(random.Random(i), words, 1 if i else 0)) for i in range(12)] + [(20, "other text " * 9), (None, " ".join(words))]
    df = llm.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(llm, df, "").collect()) == [0, 20]


def test_rows_are_told_apart_by_id_and_text(llm):
    """Two texts under one id, repeated rows, and rows without an id: one row of each group stays."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(5, one), (5, two), (7, one), (7, one), (9, two), (5, one), (None, three), (None, three), (None, "alone"), (3, f"{three} end")]
    df = llm.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.near_copies(llm, df, "").collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in kept) == sorted(
        [((False, 5), one), ((False, 5), two), ((False, 3), f"{three} end"), ((True, 0), "alone")])
    same = [(1, one, "en"), (1, one, "en"), (1, one, "de")]
    df = llm.createDataFrame(same, "doc_id bigint, text string, lang string")
    assert near_copies.drop_copies(df).count() == 1


def test_stage_against_all_pairs_of_the_corpus(llm):
    stages, docs = dict(corpus_pipeline.STAGES), llm.read.parquet(TINY)
    for name in ("quality", "lines"):
        docs = common.store(stages[name](llm, docs, ""), "test")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i for (i, _), c in zip(rows, brute_components(rows)) if i == c}
    assert {r.doc_id for r in stages["near_copies"](llm, docs, "").collect()} == want


def test_first_shingles_are_enough():
    for n in range(1, 400):
        k = near_copies.first_length(n, 0.8)
        assert k == n - -(-4 * n // 5) + 1
    assert len(near_copies.shingles("a b c d e f")) == 2 and np.array_equal(near_copies.shingles("A  b"), near_copies.shingles("a b"))


def test_fingerprints_come_first(llm, monkeypatch):
    """Close copies are found by the fingerprints' chains, before any first shingle is looked at."""
    words = [f"w{i}" for i in range(2000)]
    rows = [(i, edited(random.Random(i), words, 1)) for i in range(6)] + [(9, "other text " * 9)]
    seen, close = [], near_copies._close
    monkeypatch.setattr(near_copies, "_close", lambda active: seen.append(close(active)) or seen[0])
    found = near_copies.near_copies(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {**dict.fromkeys(range(6), 0), 9: 9}
    pairs = [(r.hub, r.rid) for r in seen[0].collect()]
    nodes = sorted({x for p in pairs for x in p})
    assert len(nodes) == 6 and len(set(least_reachable(nodes, lambda x: [
        nodes.index(b if a == nodes[x] else a) for a, b in pairs if nodes[x] in (a, b)]))) == 1


def test_bitmaps_differ_in_no_more_bits_than_sets_are_apart():
    rng = np.random.default_rng(5)
    for n, d in ((1, 0), (3, 2), (400, 40), (400, 300), (5000, 900)):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[d // 2:], rng.integers(0, 1 << 63, d, dtype=np.uint64)]))
        bits = [np.unpackbits(np.frombuffer(near_copies.parities(x), np.uint8)) for x in (a, b)]
        assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b))
