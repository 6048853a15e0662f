"""The registered queries of the corpus operators and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (class_lm, embeddings, hard_negatives, html_extract, line_dedup, mixing, packing, quality_rules, simhash, suffix_dedup,
                            tokenizer_alignment, toxicity, warc)
from ledgerlake.llm.common import prepare, store, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
    return fn


@query
def op1_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@query
def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages")).drop("record_id", "url")


SQL["op2_arc_to_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first,
         list_transform(range(8), lambda i: CAST('0x' || substr(h, CAST(1 + 5 * i AS INT), 5) AS INT)) AS fives
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + (fives[1 + k // 4] >> CAST(15 - 5 * (k % 4) AS INT)) % 32 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM r
"""


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS dropped
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = store(docs.select("doc_id", "source", mixing.words_of("text").alias("size")), "sizes")
    return mixing.allot(sizes).select("doc_id", "size", "source_size", "target", "taken")


SQL["op4_source_mixing"] = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat('{mixing.SEED}:', doc_id)) AS k
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source
), prefix AS (
  SELECT *, 3 * source_size AS cap,
         sum(3 * source_size) OVER o AS caps, sum(w) OVER o AS ws,
         sum(source_size) OVER () AS total, sum(w) OVER () AS all_w
  FROM src WINDOW o AS (ORDER BY source_size / w, source ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT CAST(total - caps + cap AS DOUBLE) / CAST(all_w - ws + w AS DOUBLE) AS level, cap, w FROM prefix
), level AS (SELECT max(level) AS level FROM levels), plan AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * level) AS target FROM src, level
), part AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM plan
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, CAST(round(target - whole * source_size) AS BIGINT)
            - coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM sized s JOIN part p ON s.source IS NOT DISTINCT FROM p.source
"""


@query
def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The label columns of the table, in the order of the chain: junk reads unlike prose, insults stand in either.
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"),
                               {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")})
    return toxicity.score_documents(docs, chain)


@query
def op6_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@query
def op8_hyperplane_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op8_hyperplane_embeddings"] = """
WITH RECURSIVE pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b
    ON a.label = b.label AND a.vec_id <> b.vec_id
   AND list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.93
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, p.b FROM reach r JOIN pairs p ON r.other = p.a
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT l.vec_id, (SELECT count(*) FROM pairs p WHERE p.a = l.vec_id) AS n_links, component_id,
       l.vec_id = component_id AS kept
FROM least l
"""


@query
def op9_host_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).drop("text")


_RULES_SQL = " AND ".join(
    f"({r.per} = 0 OR CAST({r.of} AS DOUBLE) {sign} {r.per} * CAST({bound} AS DOUBLE))"
    for r in quality_rules.RULES for bound, sign in ((r.least, ">="), (r.most, "<=")) if bound is not None)
_STOP_SQL = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
SQL["op10_quality_rules"] = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), word AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM w
), win AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS win
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM win WHERE win IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), measured AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(ws, lambda x: lower(x) IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS BIGINT) AS n_alpha_words,
         CAST(len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
         CAST(len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id
), base AS (
  SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM measured
)
SELECT *, NOT base_failed AND {_RULES_SQL} AS kept FROM base
"""


@query
def op11_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


@query
def op12_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return class_lm.score_documents(table(spark, sf_dir, "documents"), held_out)


@query
def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL["op13_strassen_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10
"""
