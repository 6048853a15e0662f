"""Toxicity by a classifier chain over hashed words.

Categories are label columns, in order. Each has a logistic model over the words that tell most about it, a few
measures of the text, and the probabilities of the categories before it. Those probabilities are out of
fold while training: documents are dealt into folds by their id, and a document's comes from the model that
has not seen its fold, so later models learn from what they will meet. Word choice is part of each fit.

The models are fitted on a bounded sample of labelled documents (``SAMPLE`` of them, those of least hash of id), in one
task, and are at most ``WORDS`` weights each; every document is scored, whole, where it lies, without a shuffle.
The decision threshold of a category is the one of best F1 over the out-of-fold probabilities.

Edge cases: a null, empty or blank text scores on its measures alone; a null label leaves its row out of that
category's fit; repeated labels of a document count once, by their maximum; a category without both classes in the
sample gets its base rate as probability and flags nothing; rows without a doc_id are scored and never train;
an empty table gives no row; texts of any length are scored whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import store

SAMPLE = 12_000
FOLDS = 3
WORDS = 384
HASH_BITS = 20
LEAST_DOCS = 3  # of a word
RIDGE = 1.0
MEASURES = 3
_TERM = re.compile(r"[^\W_]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")


class Link(NamedTuple):
    """The model of one category; features are hashed words, then measures, earlier categories, and a constant."""

    category: str
    words: np.ndarray
    weights: np.ndarray
    threshold: float


def terms(text: str | None) -> tuple[np.ndarray, list[float]]:
    """(distinct hashed words in order, measures) of a text."""
    text = text or ""
    found = _TERM.findall(text.lower())
    mask = (1 << HASH_BITS) - 1
    hashed = np.array(sorted({xxhash.xxh32_intdigest(w) & mask for w in set(found)}), np.int32)
    n = max(1, len(found))
    return hashed, [np.log1p(len(found)), len(_SYMBOL.findall(text)) / n, text.count("\n") / n]


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant and is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], RIDGE)
    shrink[-1] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _best_words(docs: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """Words whose share of documents differs most between the classes, in standard errors."""
    size = 1 << HASH_BITS
    pos = np.zeros(size)
    neg = np.zeros(size)
    for words, label in zip(docs, y):
        (pos if label else neg)[words] += 1
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
    p = (pos + neg) / (n1 + n0)
    z = np.abs(pos / n1 - neg / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[pos + neg < LEAST_DOCS] = 0
    order = np.lexsort((np.arange(size), -z))[:n]
    return np.sort(order[z[order] > 0])


def _design(words: np.ndarray, docs: list[np.ndarray], measures: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    x = np.zeros((len(docs), len(words) + measures.shape[1] + earlier.shape[1] + 1))
    for i, doc in enumerate(docs):
        if len(words) and len(doc):
            at = np.searchsorted(words, doc)
            at[at == len(words)] = 0
            x[i, at[words[at] == doc]] = 1
    x[:, len(words): -1] = np.hstack([measures, earlier])
    x[:, -1] = 1
    return x


def _probability(link: Link, docs, measures, earlier) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(link.words, docs, measures, earlier) @ link.weights, -30, 30)))


def _train(category: str, docs, measures, earlier, y: np.ndarray) -> Link:
    n1, n = float(y.sum()), len(y)
    if n1 in (0.0, n):
        weights = np.zeros(measures.shape[1] + earlier.shape[1] + 1)
        weights[-1] = np.log((n1 + 0.5) / (n - n1 + 0.5))
        return Link(category, np.empty(0, np.int32), weights, 2.0)
    words = _best_words(docs, y, WORDS)
    return Link(category, words, _fit(_design(words, docs, measures, earlier), y), 0.5)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Midway between the two scores where F1 is best; equal scores fall on one side."""
    order = np.argsort(-p, kind="stable")
    q, hit = p[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(q[1:] != q[:-1], True)
    f1[~last] = -1
    k = int(np.argmax(f1))
    return float((q[k] + (q[k + 1] if k + 1 < len(q) else 0)) / 2)


def train_chain(ids: np.ndarray, docs: list[np.ndarray], measures: np.ndarray, labels: pd.DataFrame) -> list[Link]:
    """The links of the chain, one per column of ``labels``; NaN is no label."""
    fold = np.array([xxhash.xxh32_intdigest(str(i)) % FOLDS for i in ids])
    earlier, chain = np.zeros((len(ids), 0)), []
    for category in labels:
        y = labels[category].to_numpy(float)
        known = ~np.isnan(y)
        out_of_fold = np.zeros(len(ids))
        pick = lambda rows: ([docs[i] for i in rows], measures[rows], earlier[rows])
        for k in range(FOLDS):
            learn, rest = np.flatnonzero(known & (fold != k)), np.flatnonzero(fold == k)
            out_of_fold[rest] = _probability(_train(category, *pick(learn), y[learn]), *pick(rest))
        rows = np.flatnonzero(known)
        link = _train(category, *pick(rows), y[rows])
        if len(link.words):
            link = link._replace(threshold=best_threshold(out_of_fold[rows], y[rows]))
        chain.append(link)
        earlier = np.column_stack([earlier, out_of_fold])
    return chain


def sample_labels(labels: DataFrame, categories: dict[str, object], sample: int) -> DataFrame:
    """At most ``sample`` labelled documents: those of the least hash of their id."""
    columns = [F.max(c.cast("double")).alias(name) for name, c in categories.items()]
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(*columns)
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, object], text: str = "text",
              sample: int = SAMPLE) -> list[Link]:
    """The chain fitted on a bounded sample. ``categories`` maps names to label expressions of 0 and 1, in order."""
    names = list(categories)
    chosen = store(sample_labels(labels, categories, sample), "labelled")
    # At most ``sample`` rows of a few numbers, whatever the tables.
    rows = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, found, measured, marks = [], [], [], []
        for batch in batches:
            for x in batch[text]:
                words, measure = terms(x)
                found.append(words)
                measured.append(measure)
            ids.append(batch["doc_id"].to_numpy())
            marks.append(batch[names])
        if not ids:
            return
        ids = np.concatenate(ids)
        order = np.argsort(ids, kind="stable")
        chain = train_chain(ids[order], [found[i] for i in order], np.array(measured)[order],
                            pd.concat(marks, ignore_index=True).iloc[order].reset_index(drop=True))
        yield pd.DataFrame({"category": [x.category for x in chain], "words": [x.words.tolist() for x in chain],
                            "weights": [x.weights.tolist() for x in chain], "threshold": [x.threshold for x in chain]})

    fitted = rows.coalesce(1).mapInPandas(
        run, "category string, words array<int>, weights array<double>, threshold double").collect()
    by = {r.category: Link(r.category, np.array(r.words, np.int32), np.array(r.weights), r.threshold) for r in fitted}
    empty = lambda name, k: Link(name, np.empty(0, np.int32), np.zeros(MEASURES + k + 1), 2.0)
    return [by.get(name, empty(name, k)) for k, name in enumerate(names)]


def score_documents(docs: DataFrame, chain: list[Link], text: str = "text") -> DataFrame:
    """(doc_id, p_<category>, <category>) of every document."""
    names = [x.category for x in chain]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [terms(x) for x in batch[text]]
            found = [x[0] for x in parsed]
            measures = np.array([x[1] for x in parsed]).reshape(-1, MEASURES)
            earlier = np.zeros((len(batch), 0))
            out = {"doc_id": batch["doc_id"].astype("Int64")}
            for link in chain:
                p = _probability(link, found, measures, earlier)
                out[f"p_{link.category}"], out[link.category] = p, p >= link.threshold
                earlier = np.column_stack([earlier, p])
            yield pd.DataFrame(out)

    schema = "doc_id bigint, " + ", ".join(f"p_{c} double, {c} boolean" for c in names)
    return docs.select("doc_id", text).mapInPandas(run, schema)
