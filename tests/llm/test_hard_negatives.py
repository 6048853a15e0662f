"""Exact products, heaps and mined negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<float>"


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (33, 64, 65), (70, 41, 129), (0, 4, 3), (3, 0, 4)])
@pytest.mark.parametrize("top", [9, 1 << 29])
def test_strassen_is_exact(shape, top):
    rng = np.random.default_rng(1)
    m, k, n = shape
    a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
    want = a.astype(object) @ b.astype(object) if k else np.zeros((m, n), object)
    for leaf in (1, 4, 32):
        assert (hn.strassen(a, b, leaf) == want).all()


def test_heaps_keep_the_best_of_all_pushes():
    rng = np.random.default_rng(2)
    heaps, seen = hn.Heaps(7, 4), []
    for _ in range(9):
        n = int(rng.integers(0, 60))
        new = rng.integers(0, 7, n), rng.integers(-5, 5, n), rng.integers(0, 1000, n)
        heaps.push(*new)
        seen += zip(*(x.tolist() for x in new))
    got = {}
    for o, s, i in zip(heaps.owner.tolist(), heaps.score.tolist(), heaps.id.tolist()):
        got.setdefault(o, []).append((-s, i))
    assert got == {o: sorted((-s, i) for p, s, i in seen if p == o)[:4] for o in {x[0] for x in seen}}


def brute(rows, positives=5, negatives=10):
    part = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, l, v in rows
            if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, l, v) in enumerate(part):
        if i % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), j, m) for k, (j, m, w) in enumerate(part) if k != n and len(w) == len(v)]
        for p, j, _ in sorted(s for s in scores if s[2] == l)[:positives]:
            inside = sorted(s for s in scores if s[2] != l and -30 * p <= -100 * s[0] <= -90 * p)[:negatives]
            out += [(i, j, at + 1, k, -p, -s) for at, (s, k, _) in enumerate(inside)]
    return sorted(out)


def mined(df, **sizes):
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in cols) for r in hn.mine(df, F.col("vec_id") % 100 == 0, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"anchor_part": 3, "candidate_part": 40, "tile": 16, "leaf": 2}])
def test_against_brute_force(llm, sizes, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), np.round(rng.normal(0.2, 0.4, 5), 1).astype(np.float32).tolist()) for i in range(0, 1500, 5)]
    rows += [(300, 1, rows[0][2]), (300, 1, rows[0][2]), (7, 2, rows[3][2])]  # repeated ids, equal vectors
    rows += [(None, 1, rows[0][2]), (100, None, rows[0][2]), (200, 1, None), (400, 1, [float("nan")] * 5), (500, 1, [float("inf")] + [0.0] * 4),
             (600, 1, [None, 1.0, 1.0, 1.0, 1.0]), (700, 9, [1.0] * 5), (800, 1, [1.0, 2.0]), (801, 1, [1.0, 2.0]), (802, 0, [0.5, 1.0]),
             (900, 1, []), (901, 1, []), (902, 2, [])]
    df = llm.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(hn, "FAN_IN", 2)
    want = brute(rows)
    assert len(want) > 300 and any(r[0] == 800 for r in want) and any(r[0] == 900 for r in want)
    assert mined(df.withColumn("row", F.lit("x")).withColumn("side", F.lit("y")), **sizes) == want


def test_huge_and_empty(llm):
    rows = [(0, 1, [3e38, 0.0]), (1, 1, [1.0, 1.0]), (100, 1, [2.0 ** 20, 1.0]), (101, 1, [2.0 ** 20, 1.0]), (102, 2, [2.0 ** 19, 1.0])]
    df = llm.createDataFrame(rows, SCHEMA)
    assert mined(df) == brute(rows[1:])  # a score with the first could pass a long: it takes no part
    assert mined(df.where("vec_id < 0")) == []
    assert mined(df.where("vec_id < 2")) == []
