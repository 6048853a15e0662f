"""Line deduplication in Spark SQL functions only.

Long lines found in many documents (menus, licences, notices) are dropped everywhere but in the
document with the largest id that holds them. Lines are exploded as keys of 128 hash bits, counted
by distinct document with partial aggregates, and the positions to drop are joined back to the
whole texts in one shuffle by row: document and 128 hash bits of the text.

Edge cases: a null or empty text is one empty line; rows that repeat a doc_id count as one document
and each loses its own lines of a dropped key, none if that document keeps them; rows without a doc_id never count as a
document, and each loses all its lines of a dropped key; an empty table
gives no row; texts of any length are split whole; extra columns are carried along under any name that does not begin with ``__ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import BLANKS, ascii_lower, store

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _text_hashes(text: str) -> list[Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("__ld_t1"), F.xxhash64(F.lit(1), whole).alias("__ld_t2")]


def keyed_lines(df: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(doc_id, t1, t2, position, k1, k2) of the lines long enough to count; t1 and t2 are hashes of the text."""
    key = F.col("__ld_key")
    row = ["doc_id", "__ld_t1", "__ld_t2", "__ld_at"]
    return (
        df.select("doc_id", *_text_hashes(text), F.posexplode(_lines(text)).alias("__ld_at", "__ld_line"))
        .where(F.length("__ld_line") >= min_chars)
        .select(*row, line_key(F.col("__ld_line")).alias("__ld_key"))
        .where(F.length(key) >= min_chars)
        .select(*row, F.xxhash64(key).alias("__ld_k1"), F.xxhash64(F.lit(1), key).alias("__ld_k2"))
    )


def frequent_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """Keys found in ``min_docs`` documents or more, with the document that keeps them."""
    return (
        keys.groupBy("__ld_k1", "__ld_k2", "doc_id").agg(F.lit(1).alias("__ld_one"))
        .groupBy("__ld_k1", "__ld_k2")
        .agg(F.count("doc_id").alias("__ld_docs"), F.max("doc_id").alias("__ld_keeper"))
        .where(F.col("__ld_docs") >= min_docs)
        .select("__ld_k1", "__ld_k2", "__ld_keeper")
    )


def dedup_lines(df: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``df`` with ``text`` less the dropped lines, ``n_lines`` and ``n_dropped``."""
    keys = keyed_lines(df, text, min_chars)
    # A third of all documents may hold one line. As a stored table the frequent lines bring no partitioning
    # along, so both sides of the join are shuffled for it and adaptive execution can split the hot key.
    frequent = store(frequent_lines(keys, min_docs), "frequent-lines")
    dropped = (
        keys.join(frequent, ["__ld_k1", "__ld_k2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("__ld_keeper")))
        .groupBy(F.col("doc_id").alias("__ld_doc"), "__ld_t1", "__ld_t2")
        .agg(F.array_sort(F.collect_set("__ld_at")).alias("__ld_drop"))
    )
    lines, drop = F.col("__ld_lines"), F.col("__ld_drop")
    h1, h2 = _text_hashes(text)
    same = F.col("doc_id").eqNullSafe(F.col("__ld_doc")) & (h1 == F.col("__ld_t1")) & (h2 == F.col("__ld_t2"))
    joined = df.join(dropped, same, "left").withColumn("__ld_lines", _lines(text))
    kept = F.when(drop.isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop),
                                 lambda p: F.get(lines, p)), "\n"))
    out = joined.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size(drop), F.lit(0)).cast("long"),
        text: kept,
    })
    return out.drop("__ld_doc", "__ld_t1", "__ld_t2", "__ld_drop", "__ld_lines")
