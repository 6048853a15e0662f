"""Registered corpus queries against SQL, or against brute force where SQL can't express them."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from ledgerlake.llm.queries import QUERIES, SQL, tokenizer_path
from tests.compare import connect, difference

SF, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_all_are_registered():
    known = entry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in known if re.match(r"op\d+_", n)} == {str(n) for n in range(1, 14)}
    assert "pipeline" in known


def documents(spark, sf=TINY):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def least_reachable(ids, linked):
    """Smallest id per connected component, by search."""
    out = {}
    for i in sorted(range(len(ids)), key=lambda i: ids[i]):
        if i in out:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = ids[i]
                todo += linked(x)
    return [out[i] for i in range(len(ids))]


def test_op1(spark):
    rows = documents(spark)
    ids = [r.doc_id for r in rows]
    fps = np.array([brute_fingerprint(r.text) for r in rows], np.uint64)
    want = least_reachable(ids, lambda x: np.flatnonzero(np.bitwise_count(fps ^ fps[x]) <= 4).tolist())
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_pigeonring"](spark, TINY).collect()}
    assert got == {i: (f"{int(f):016x}", c) for i, f, c in zip(ids, fps, want)}


def test_op5_on_labelled_documents(spark):
    """Accuracy on labelled documents of another size than the chain has seen most of."""
    got = QUERIES["op5_toxicity_chain"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("toxic", "t")
    counts = {(r.t, r.toxic): r["count"] for r in got.join(labels, "doc_id").groupBy("t", "toxic").count().collect()}
    assert got.count() == 10_000
    assert counts[1, True] > 0.9 * (counts[1, True] + counts.get((1, False), 0))
    assert counts.get((0, True), 0) < 0.01 * counts[0, False]


def brute_repeats(bodies, length):
    starts = collections.Counter(b[i: i + length] for b in bodies for i in range(len(b) - length + 1))
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if starts[b[i: i + length]] > 1:
                gone[i: i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        yield len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def test_op6(spark):
    rows = documents(spark)
    want = dict(zip([r.doc_id for r in rows], brute_repeats([(r.text or "").encode() for r in rows], 200)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op6_suffix_runs"](spark, TINY).collect()}
    assert got == want


def test_op7(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in documents(spark)}
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in QUERIES["op7_hilbert_packing"](spark, TINY).collect():
        row = np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4")
        assert (r.doc_tokens, len(row), zlib.crc32(row.tobytes())) == (len(ids[r.doc_id]), r.length, r.ids_crc32)
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for found, size in [(v, len(ids[k])) for k, v in pieces.items()] + [(v, None) for v in places.values()]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == size if size is not None else at <= 2048
    short = [k for k, v in places.items() if sum(n for _, n in v) < 2048]
    assert short in ([], [max(places)])


def planted_vectors(rng, n, dim=64):
    """Random vectors of a few labels, with pairs and clusters at 0.93 to 0.95 and just below."""
    v = rng.standard_normal((n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    label = rng.integers(0, 4, n)
    for i in range(0, n - 6, 6):  # five at a stated cosine of the first of every six
        for j in range(1, 6):
            side = rng.standard_normal(dim)
            side -= side @ v[i] * v[i]
            cosine = rng.uniform(0.93, 0.95) if j < 4 else rng.uniform(0.90, 0.9299)
            v[i + j] = cosine * v[i] + (1 - cosine ** 2) ** 0.5 * side / np.linalg.norm(side)
        label[i: i + 6] = label[i]
    return v * rng.uniform(0.1, 9, n)[:, None], label


def test_op8_recall(llm, tmp_path):
    """All pairs by brute force over several thousand vectors, most of them right at the threshold."""
    rng = np.random.default_rng(12)
    v, label = planted_vectors(rng, 6000)
    rows = [(i, x.tolist(), int(l)) for i, (x, l) in enumerate(zip(v.astype(np.float32), label))]
    llm.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    v = v.astype(np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    close = (v @ v.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(close, False)
    got = {r.vec_id: r for r in QUERIES["op8_hyperplane_embeddings"](llm, str(tmp_path)).collect()}
    n = np.array([got[i].n_links for i in range(len(v))])
    assert close.sum() > 5000 and (n <= close.sum(1)).all()
    assert n.sum() >= 0.99 * close.sum()
    component = least_reachable(list(range(len(v))), lambda x: np.flatnonzero(close[x]).tolist())
    assert np.mean([got[i].component_id == c for i, c in enumerate(component)]) > 0.98


def test_op9(spark):
    """The test pages hold one article each."""
    import html

    got = {r.page_id: r for r in QUERIES["op9_host_path_extraction"](spark, SF).collect()}
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n".join(x for x in blocks if x)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (text, len(text))
