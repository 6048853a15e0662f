"""Alignment against a brute force that tokenizes whole texts and compares all tokens of a document."""

import collections
import functools
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import tokenizer_alignment as ta
from ledgerlake.llm.queries import QUERIES, tokenizer_path

TINY = "/root/testdata/sf0.001"
A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@functools.cache
def tokenizers():
    import public_tokenizers
    import sentencepiece
    import tiktoken
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    first = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text):
    """(first id, bytes) and (second id, bytes) of a text, or nothing."""
    first, second = tokenizers()
    if not text:
        return [], []
    a = [(i, first.decode_single_token_bytes(i)) for i in first.encode_ordinary(" " + text)]
    b = []
    for i in second.encode(text):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
    body = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == body == b"".join(x for _, x in b) else ([], [])


def offsets(toks):
    ends = np.cumsum([len(x) for _, x in toks]).tolist()
    return [(i, e - len(x), e) for (i, x), e in zip(toks, ends)]


def brute(texts):
    docs = []
    for text in texts:
        a, b = map(offsets, tokens(text))
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, s = [], 0
        for e in common:
            groups.append([[i for i, x, _ in t if s <= x < e] for t in (a, b)])
            s = e
        links, j = collections.Counter(), 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][1] < e:
                if b[j][2] > s:
                    links[i, b[j][0]] += 1
                j += 1
        docs.append((a, b, groups, links))
    counts = collections.Counter(x for *_, links in docs for x in links)
    highest = collections.defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    for a, b, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        yield (len(a), len(b), len(groups), sum(links.values()), sum(m for x, m in links.items() if counts[x] == highest[x[0]]),
               sum(m * counts[x] for x, m in links.items()), hashlib.sha256(text.encode()).hexdigest() if a else "")


def test_op11(spark):
    rows = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows])))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_fragment_alignment"](spark, TINY).collect()}
    assert got == want and sum(w[3] > w[2] for w in want.values()) > 100


ODD = [None, "", " ", "  ", "a", " a", "a ", "x  y \n\n z", "▁x", "a▁ b", "<s> </s> <unk> <|endoftext|>", "<0x41>", "ﬁ é Å", "日本語 \U0001f642\U0001f468‍\U0001f469",
       "a\x00b", "tab\tin nb　ideographic   sep", "It's 'twas we'll  I'm", "a" * 3000, "é" * 700, "don't " * 900, " " * 500, "\n" * 300]


@pytest.mark.parametrize("chunk, fan_in, frequent", [(1 << 15, 8, 1 << 18), (64, 2, 50), (300, 3, 0)])
def test_ranges_of_any_size_give_the_same(llm, chunk, fan_in, frequent):
    rng = random.Random(4)
    alphabet = ["internationalization", "café", "naïve", "中文", "x", "...", "'s", "123456", "\n", "\t", "  ", "\U0001f642", "Straße", " ", "ﬁ", "ум"]
    texts = ODD + [" ".join(rng.choice(alphabet) for _ in range(n)).replace("  ", " " * rng.randint(1, 3)) for n in (5, 40, 300, 900, 900)]
    texts += [texts[-1], texts[-1] + "▁"]
    df = llm.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id int, text string")
    out = ta.align_documents(df.withColumns({c: F.lit("x") for c in ("row", "at", "links", "count", "best")}), A, B, chunk=chunk, fan_in=fan_in,
                             frequent=frequent)
    got = {r.doc_id or 0: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    assert got == dict(enumerate(brute(texts)))
    assert [got[i] for i in (0, 1)] == [(0, 0, 0, 0, 0, 0, "")] * 2 and got[8][0] == 0 and got[len(texts) - 1][0] == 0


def test_empty_table(llm):
    assert ta.align_documents(llm.createDataFrame([], "doc_id bigint, text string"), A, B).count() == 0


def test_composition_is_associative():
    v = ta.vocabularies(A, B)
    rng = random.Random(5)
    text = " ".join(rng.choice(["internationalization", "of", "naïve", "tokenizers", "中文字", "counterrevolutionaries"]) for _ in range(400))
    body = b" " + text.encode()
    cuts = ta.ranges(body, 40)
    parts = ta.fragments(v, [(body[low:high], low, s, e) for s, e, low, high in cuts])
    assert len(parts) > 50 and any(len(p.suffix[0]) or len(p.suffix[1]) for p in parts) and any(len(p.prefix[0]) > 1 for p in parts)

    def fold(parts):
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts = parts[:i] + [ta.compose(v, parts[i], parts[i + 1])] + parts[i + 2:]
        f = ta.closed_document(v, parts[0])
        return f.n_a, f.n_b, f.n_groups, f.n_links, ";".join(f.groups), f.links.tolist(), f.times.tolist()

    assert len({repr(fold(list(parts))) for _ in range(5)}) == 1
    assert [s for s, *_ in cuts[1:]] == [e for _, e, *_ in cuts[:-1]] and cuts[-1][1] == len(body)


def test_pieces_of_known_words_are_looked_up():
    """Words have the same pieces alone as in their text, and are encoded once."""
    v = ta.Vocabularies(A, B)
    texts = ["the cat sat", "the cat's cat sat", "a▁ b the", "a  cat", " cat", "cat ", "x\u00a0y cat", "\u200b cat", "日本 語 cat", "<s> cat </s>", "e \u0301a",
             "a\tb c\nd", "ﬁ ½ cat", "🙂 cat🙂"]
    got = v.encode([b" " + t.encode() for t in texts])
    for t, found in zip(texts, got):
        a, b = tokens(t)
        assert (found is None) == (not b) and (found is None or ([i for i, _ in a], [i for i, _ in b]) == tuple(x.tolist() for x in found))
    read, encode = [], v.pieces._encode
    v.pieces._encode = lambda t: read.extend(t) or encode(t)
    assert v.encode([b" sat the cat new"])[0] is not None and read == [" new"]
