"""Nulls, empty and long texts, ties and repeated rows, empty tables, clashing columns."""

import gzip
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import (common, embeddings, html_extract, line_dedup, mixing, packing, quality_rules, simhash, suffix_dedup,
                            toxicity, warc)
from ledgerlake.llm.queries import tokenizer_path
from tests.llm.test_queries import brute_repeats, least_reachable

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "the quick brown fox jumps over the lazy dog and runs " * 4000
ODD = [None, "", " \n\t ", "one", "é x\x0by", "a\nb\n\nb", LONG, LONG, "word " * 30]


@pytest.fixture
def odd(llm):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None) for i, t in enumerate(ODD)]
    return llm.createDataFrame([*rows, rows[3], (None, "no id", None, None, 1), (None, None, None, None, None)], DOCS)


@pytest.fixture
def none(llm):
    return llm.createDataFrame([], DOCS)


def clash(df):
    """Columns whose names the operators use themselves."""
    return df.withColumns({c: F.lit("x") for c in ("key", "n", "size", "fp", "h", "node", "count", "position", "rank")})


def test_simhash(odd, none):
    rows = simhash.near_duplicates(clash(odd)).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[0].fp == by[1].fp == by[2].fp == 0 and by[2].component_id == 0
    assert by[7].component_id == by[6].component_id == 6
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_hot_keys_give_the_same_components(llm):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(600)}
    fps = np.array(sorted(fps | {rng.getrandbits(64) for _ in range(300)}), np.uint64)
    signed = fps.view(np.int64).tolist()
    df = llm.createDataFrame([(x,) for x in signed], "fp bigint")
    want = least_reachable(signed, lambda x: np.flatnonzero(np.bitwise_count(fps ^ fps[x]) <= 4).tolist())
    for hot in (20, 100_000):
        found = {r.node: r.component for r in common.components(simhash.near_links(df, 4, hot)).collect()}
        assert [found.get(x, x) for x in signed] == want


@pytest.mark.parametrize("value", [4, 0])
def test_simhash_links_whose_keys_read_like_those_of_another_start(llm, value):
    """Pairs that one start alone proves, for every start, with second segments equal to a number of a start."""
    rng = random.Random(9)
    widths = [13, 13, 13, 13, 12]
    begins = [sum(widths[:i]) for i in range(5)]
    fps = set()
    for start in range(5):
        for bits in ((0, 0, 2, 0, 2), (0, 0, 1, 1, 2), (0, 0, 0, 4, 0), (0, 1, 1, 0, 2)):
            for other in (0, value, 1 << 11, rng.getrandbits(12)):
                a = sum((value if i == (start + 1) % 5 else other if i == (start + 4) % 5 else rng.getrandbits(12)) << begins[i] for i in range(5))
                b = a
                for k, n in enumerate(bits):
                    at = (start + k) % 5
                    for bit in rng.sample(range(widths[at]), n):
                        b ^= 1 << (begins[at] + bit)
                fps |= {a, b}
    fps |= {5 | 4 << 13, (5 | 4 << 13) ^ (1 << 26 | 1 << 27 | 1 << 52 | 1 << 53)}
    fps = np.array(sorted(fps), np.uint64)
    signed = fps.view(np.int64).tolist()
    want = least_reachable(signed, lambda x: np.flatnonzero(np.bitwise_count(fps ^ fps[x]) <= 4).tolist())
    df = llm.createDataFrame([(x,) for x in signed], "fp bigint")
    for hot in (3, 100_000):
        found = {r.node: r.component for r in common.components(simhash.near_links(df, 4, hot)).collect()}
        assert [found.get(x, x) for x in signed] == want


def test_components_of_long_chains_and_stars(llm):
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5)]
    df = llm.createDataFrame(chain, "a bigint, b bigint")
    found = {r.node: r.component for r in common.components(df).collect()}
    assert set(found.values()) == {0, 1000} and len(found) == 301 + 400
    assert common.components(df.where("a < 0")).count() == 0


def test_line_dedup(llm, odd, none):
    long_line = "A shared line of more than forty characters, É."
    rows = [(i, f"own {i}\n  {long_line.upper().replace('É', 'É') if i % 2 else long_line}\t\nend", "x") for i in range(6)]
    df = llm.createDataFrame([*rows, (9, f"{long_line}\n{long_line}", "x"), (None, long_line, "x")],
                             "doc_id int, text string, key string")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert out[0].text == "own 0\nend" and out[0].n_dropped == 1
    assert out[9].text == f"{long_line}\n{long_line}" and out[9].n_lines == 2
    assert out[None].text == "" and out[None].n_dropped == 1
    kept = line_dedup.dedup_lines(clash(odd))
    assert kept.count() == odd.count() and {r.n_lines for r in kept.where("doc_id < 2").collect()} == {1}
    assert line_dedup.dedup_lines(none).count() == 0
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing(llm, odd, none):
    sizes = [(i, s, n) for i, (s, n) in enumerate([("a", 10)] * 30 + [("b", 7)] * 400 + [(None, 3)] * 50 + [("c", 0)])]
    df = llm.createDataFrame(sizes, "doc_id bigint, source string, size bigint")
    rows = mixing.allot(df).collect()
    taken = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    target = {r.source: r.target for r in rows}
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert target["a"] == 900.0 and target["c"] == 0.0
    assert abs(sum(target.values()) - (300 + 2800 + 150)) < 1e-6
    assert sorted(mixing.allot(df).collect(), key=str) == sorted(rows, key=str)
    mixed = mixing.mix(clash(odd))
    assert mixed.columns == clash(odd).columns and mixed.where("text is null").count() == 0
    assert mixing.mix(none).count() == 0


def test_quality_rules(odd, none):
    rows = {r.doc_id: r for r in quality_rules.apply_rules(clash(odd)).collect()}
    assert rows[0].n_words == rows[1].n_words == 0 and rows[0].base_failed
    assert rows[5].n_dup_lines == 1 and rows[8].n_repeat_words == 30
    assert quality_rules.keep(clash(odd)).columns == clash(odd).columns
    assert quality_rules.apply_rules(none).count() == 0


@pytest.mark.parametrize("text, n", [("a b c", 0), ("a b c a b c", 6), ("a a a a", 4), ("a b c d a b c x", 6), ("a b", 0)])
def test_repeated_windows(llm, text, n):
    assert quality_rules.measures(llm.createDataFrame([(text,)], "text string")).first().n_repeat_words == n


def test_packing(llm, odd, none):
    pieces = packing.pack(clash(odd), tokenizer_path())
    rows = pieces.collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert len([r for r in rows if r.start == 0]) == odd.count()
    assert {r.doc_tokens for r in rows if r.doc_id in (0, 1)} == {1}
    sequences = packing.sequences(pieces).collect()
    assert sorted(len(r.ids) for r in sequences)[1:] == [2048] * (len(sequences) - 1)
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_hilbert_neighbours_are_one_step_apart():
    cells = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    key = packing.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1).max() == 1


def test_word_cache_agrees_with_the_tokenizer():
    cache = packing.WordCache(tokenizer_path())
    texts = ["", " a", "a  b", "a \nb", "x <|endoftext|> y", "it's 12 o'clock\n\n", "a\0b c", "é ß z", "tail "]
    for text, ids in zip(texts, cache.encode(texts)):
        want = cache.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, f"<u{cache.width}").tolist() == want


def test_embeddings(llm):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    rows = [(i, (base + 0.01 * rng.standard_normal(8)).tolist(), 1) for i in range(40)]
    rows += [(100, base.tolist(), 1), (101, base.tolist(), 1), (102, base.tolist(), 2), (103, base.tolist(), None)]
    rows += [(104, None, 1), (105, [0.0] * 8, 1), (106, [float("nan")] * 8, 1), (107, [1.0, None], 1), (108, [], 1),
             (109, base[:4].tolist(), 1), (None, base.tolist(), 1)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("key", F.lit(1))
    for part in (embeddings.PART, 4):
        flat = embeddings.vectors(df)
        assert flat.count() == 44
        out = embeddings.near_duplicates(df)
        got = {r.vec_id: r for r in out.collect()}
        assert len(got) == len(rows)
        assert {got[i].n_links for i in [*range(40), 100, 101]} == {41} and got[101].component_id == 0 and not got[101].kept
        assert all(got[i].n_links == 0 and got[i].kept for i in (102, 103, 104, 105, 106, 107, 108, 109, None))
    assert embeddings.near_duplicates(df.where("vec_id < 0")).count() == 0


def test_embedding_hot_buckets_count_every_link_once(llm):
    rng = np.random.default_rng(6)
    v = rng.standard_normal(16) + 0.25 * rng.standard_normal((150, 16))
    classes = llm.createDataFrame([(i, 1, 16, 1, x.tobytes()) for i, x in enumerate(v)],
                                  "id bigint, label int, dim int, copies bigint, vector binary")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    for part in (7, 1000):
        rows = embeddings.links(classes, recall=0.999999, part=part).where("b is null").groupBy("a").agg(F.sum("n").alias("n")).collect()
        got = {r.a: r.n for r in rows}
        assert [got.get(i, 0) for i in range(150)] == want.tolist()


PAGE = """<body class="x1"><header>Top</header><div id="cookie-notice">We use</div><div class="content post-12"><h1>T &amp; x</h1>
<p>One <b>two</b><br>three&nbsp;four<p>Five<ul><li>a<li>b</ul></div><section class="comments"><p>me too</p></section>
<aside>s</aside><form><p>q</p></form><script>var a = "<p>no</p>";</script><footer>f</footer>"""


def test_html(llm):
    rows = [(i, f"https://h.example/{i}", PAGE.replace("12", str(i))) for i in range(5)]
    rows += [(10, None, None), (11, "no url", ""), (12, "https://h.example/x", "plain text &lt;b&gt;"),
             (13, "https://h.example/y", "<!-- never ends <p>x</p>"), (3, "https://h.example/3", PAGE), (None, None, "<p>a</p>")]
    df = llm.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"path": F.lit(1), "text": F.lit("old")})
    out = html_extract.extract_pages(df).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    assert got[0] == got[3] == "T & x\nOne two three four\nFive\na\nb"
    assert got[10] == got[11] == got[13] == "" and got[12] == "plain text <b>" and got[None] == "a"
    assert html_extract.extract_pages(df.where("page_id < 0")).count() == 0


def test_html_consensus_overrules_a_page(llm):
    """A page whose related links are longer than its article still gives the article."""
    body = "<body><div class='c'><p>{}</p></div><div class='blurb'><p>{}</p></div></body>"
    rows = [(i, "https://a.example/", body.format("main " * 60, "side " * 10)) for i in range(9)]
    rows.append((9, "https://a.example/", body.format("main " * 20, "side " * 30)))
    df = llm.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(df).collect()}
    assert got[9] == ("main " * 20).strip()


def test_warc(llm):
    rows = [(5, "https://e.example/a b", "<p>é</p>"), (3, None, "<p>é</p>"), (4, "u", None), (7, "u", ""), (None, None, "<p>é</p>"),
            (8, "u", "WARC/1.1\r\n\r\nURL 1.2.3.4 20200101000000 text/html 5\n" + LONG), (8, "u", "twice"), (9, "u", "twice")]
    df = llm.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    out = warc.page_records(df).collect()
    assert len(out) == len(rows)
    kind = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in out}
    assert kind[3, 9] == kind[4, 0] == ("response", None) and kind[5, 9] == kind[None, 9] == ("revisit", 3)
    assert kind[7, 0] == ("revisit", 4) and kind[9, 5] == ("revisit", 8)
    assert {r.payload_digest for r in out if r.payload_bytes == 0} == {"3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"}
    assert warc.page_records(df.where("page_id < 0")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    blocks = [b"HTTP/1.0 200 OK\n\nbody", b"", b"no http \xff\x00 at all\n\nhttp://x 1 2 3 4\n"]
    data = warc.arc_header("f.arc", version) + b"\n"
    for b in blocks:
        data += warc.arc_record(version, "f.arc", len(data), "http://x.example/a b", b) + b"\n"
    found = list(warc.parse_arc(warc.opened(gzip.compress(data))))
    assert [r.block for r in found] == blocks and {r.url for r in found} == {"http://x.example/a%20b"}
    assert {r.version for r in found} == {version} and found[0].status == ("200" if version == 2 else None)
    cut = list(warc.parse_arc(io.BytesIO(data[:-5])))
    assert [r.truncated for r in cut] == [False, False, True]
    with pytest.raises(ValueError, match="version block"):
        list(warc.parse_arc(io.BytesIO(b"http://x 1.2.3.4 20200101000000 text/html 0\n")))


def test_warc_blocks_that_are_not_utf8_survive():
    record = warc.warc_record([("WARC-Type", "resource")], b"\xff\xfe\r\n\r\n") + "\n"
    (headers, block), = warc.parse_warc(io.BytesIO(record.encode() * 1))
    assert block == b"\xff\xfe\r\n\r\n" and headers["warc-type"] == "resource"
    assert warc.iso_date("199912312359") == "1999-12-31T23:59:00Z"


def test_suffix_repeats(llm, none):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    text = lambda a, b: " ".join(words[a:b])
    shared = text(0, 60)
    bodies = [text(100, 300), text(200, 420), shared, f"x{shared}y", f"{text(500, 540)} {shared} {text(600, 700)}", "ab" * 500, "",
              "short", "a" * 199, "a" * 200, "a" * 201, text(800, 900), text(800, 900), text(850, 880) + "!" + text(881, 990)]
    bodies += [f"{text(1000 + 9 * i, 1005 + 9 * i)} {text(2000, 2050)} {text(3000 - i, 3030)}" for i in range(40)]
    rows = [*enumerate(bodies), (len(bodies), None), (None, text(100, 200)), (2, shared)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string").withColumn("kh", F.lit(1))
    want = list(brute_repeats([(t or "").encode() for _, t in rows], 200))
    for hot in (1024, 3):
        out = suffix_dedup.remove_repeats(df, hot=hot).collect()
        got = sorted(((r.doc_id is None, r.doc_id or 0), (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in out)
        assert got == sorted(((i is None, i or 0), w) for (i, _), w in zip(rows, want))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_merge_of_front_coded_runs():
    rng = random.Random(2)
    runs = [sorted(bytes(rng.choices(b"ab", k=rng.randrange(12))) for _ in range(rng.randrange(40))) for _ in range(7)]
    merged = list(suffix_dedup.merge_runs([suffix_dedup.front_code(r) for r in runs]))
    strings = [s for _, _, s, _ in merged]
    assert strings == sorted(x for r in runs for x in r)
    for a, b, known in zip(strings, strings[1:], [k for *_, k in merged][1:]):
        assert known == suffix_dedup.common_prefix(a, b, 0)
    assert all(runs[r][i] == s for r, i, s, _ in merged)


def test_anchors_follow_content_across_chunks(monkeypatch):
    body = bytes(random.Random(4).choices(b"abcd ", k=5000))
    whole = suffix_dedup.anchors(body, 200, 50)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    for a, b in zip(whole, suffix_dedup.anchors(body, 200, 50)):
        assert a.tolist() == b.tolist()
    shifted = suffix_dedup.anchors(body[1234:], 200, 50)
    assert set(shifted[0] + 1234) <= set(whole[0])


def test_toxicity(llm, odd, none):
    labels = llm.createDataFrame([(i, i % 2, None if i == 3 else i % 2) for i in range(6)] + [(None, 1, 1), (2, 1, 0)],
                                 "doc_id bigint, bad int, toxic int")
    chain = toxicity.fit_chain(clash(odd), labels, {"bad": F.col("bad"), "toxic": F.col("toxic")})
    rows = toxicity.score_documents(clash(odd), chain).collect()
    assert len(rows) == odd.count() and all(0 <= r.p_toxic <= 1 for r in rows)
    empty = toxicity.fit_chain(none, labels, {"toxic": F.col("toxic")})
    assert not any(r.toxic for r in toxicity.score_documents(odd, empty).collect())
    assert toxicity.score_documents(none, chain).count() == 0


def test_chain_uses_earlier_categories():
    """The second category is the first one but for a word; its model leans on the first one's probability."""
    rng = np.random.default_rng(8)
    n = 1500
    first = rng.random(n) < 0.4
    docs = [np.unique(np.append(rng.integers(100, 5000, 30), [7] * int(f))).astype(np.int32) for f in first]
    labels = {"a": first.astype(float), "b": first.astype(float)}
    import pandas as pd

    chain = toxicity.train_chain(np.arange(n), docs, rng.random((n, 3)), pd.DataFrame(labels))
    assert [x.category for x in chain] == ["a", "b"]
    assert len(chain[1].weights) == len(chain[1].words) + toxicity.MEASURES + 2 and chain[1].weights[-2] > 0.5
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0])) == pytest.approx(0.55)


def brute_pipeline_ids(spark, docs):
    """Documents left before mixing, by the operators' definitions on the driver."""
    kept = {r.doc_id: r.text for r in quality_rules.keep(docs).collect()}
    counts, holder = {}, {}
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({i: i + 32 for i in range(65, 91)})
    for i, t in kept.items():
        for k in {key(x) for x in (t or "").split("\n")}:
            counts[k] = counts.get(k, 0) + 1
            holder[k] = max(i, holder.get(k, i))
    many = {k for k, n in counts.items() if n >= 5 and len(k) >= 40}
    texts = {i: "\n".join(x for x in (t or "").split("\n") if key(x) not in many or holder[key(x)] == i) for i, t in kept.items()}
    from tests.llm.test_near_copies import brute_components

    return {i: texts[i] for (i, _), c in zip(texts.items(), brute_components(list(texts.items()))) if i == c}


def test_pipeline_stages_against_brute_force(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_pipeline_ids(llm, docs)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_copies", "mixture", "packing"]
    for name in ("quality", "lines", "near_copies"):
        docs = common.store(stages[name](llm, docs, ""), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id: r.text for r in docs.collect()} == want
    mixed = common.store(stages["mixture"](llm, docs, ""), "test")
    words = mixing.words_of("text")
    had = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    took = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    assert abs(sum(took.values()) - sum(had.values())) <= len(had) and all(took.get(s, 0) <= 3 * had[s] for s in had)
    packed = stages["packing"](llm, mixed, "")
    assert packed.where("start = 0").count() == mixed.count()


def test_pipeline_of_odd_documents(llm, odd, none):
    """Of texts that pass the rules one row of each group of copies stays, one without an id too; all others go."""
    kept = quality_rules.keep(llm.read.parquet("/root/testdata/sf0.001/documents.parquet")).orderBy("doc_id").limit(40).collect()
    one, two, three = [r.text for r in kept if r.lang == kept[0].lang][:3]
    rows = [(1001, one), (None, one), (1002, two), (1002, two), (None, three), (None, f" {three}"), (1003, None)]
    docs = odd.unionByName(llm.createDataFrame([(i, t, "en", "s0", None) for i, t in rows], DOCS))
    for _, stage in corpus_pipeline.STAGES:
        docs = common.store(stage(llm, docs, ""), "test")
    assert sorted((r.doc_id or 0, r.start) for r in docs.where("start = 0").collect()) == [(0, 0), (1001, 0), (1002, 0)]
    for _, stage in corpus_pipeline.STAGES:
        none = common.store(stage(llm, none, ""), "test")
    assert none.count() == 0 and {"doc_id", "start", "length", "ids"} <= set(none.columns)
