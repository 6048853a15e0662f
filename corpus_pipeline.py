"""A corpus pipeline: every stage takes the documents its predecessor kept and gives the next ones.

Stages exchange Parquet tables in the shared folder, so a lost executor costs no finished stage.
All stages but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import line_dedup, mixing, near_copies as copies, packing, quality_rules
from ledgerlake.llm.common import prepare, store, table
from ledgerlake.llm.queries import tokenizer_path


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    prepare(spark)
    return _measured(line_dedup.dedup_lines(docs).select(*docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more): the one with
    the smallest id. Rows are told apart by id and text; a row without an id stays only if its group has no other."""
    prepare(spark)
    return copies.drop_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the source mix takes them, repetitions as rows of their own."""
    prepare(spark)
    return _measured(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, with their token ids."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packed),
]

# The near-duplicate stage links documents transitively by shingle sets, which SQL can't
# express at any size; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
