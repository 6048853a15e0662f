"""Quality rules: a table of thresholds compiled into one Spark projection.

``measures`` adds the counts of a text as columns, ``verdict`` turns a table of rules into one
boolean expression over them, ``apply_rules`` does both. Everything is a built-in expression: no
user function, no shuffle, one pass over the table.

Edge cases: a null or blank text has no words and fails; a text of one line has no repeated line;
extra columns are carried along, and helper columns have names that no input uses (``__qr_``).
Repeated rows are judged one by one; an empty table gives no row; texts of any length are judged whole. The window key is a
64-bit hash chained over three words. Windows are sorted by its leading bits, as many as the positions leave (47 for a hundred
thousand words, 44 for a million), and compared by all 64: where two different windows share the leading bits, equal ones may be
parted and a repetition missed. That some pair of a text does has a probability of n^2 / 2^(65 - bits of n): below 4e-5 for a
hundred thousand words, about 0.03 for a million.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import BLANK_RUN, WORD

# Frequent function words of four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "are", "with", "be", "by", "this",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "est", "pour", "dans",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im", "nicht", "ein", "eine",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "su", "al",
)
SYMBOLS = "[#*$%&|<>]"


class Rule(NamedTuple):
    """A ratio ``of / per`` and the bounds it must keep, both included; null is no bound."""

    name: str
    of: str
    per: str
    least: float | None
    most: float | None


# Ratios are over words or over lines that hold a word; a rule is skipped where ``per`` is zero.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 0.3),
    Rule("alphabetic_word_ratio", "n_alpha_words", "n_words", 0.6, None),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count(items: Column) -> Column:
    return F.size(items).cast("long")


def _covered(positions: Column) -> Column:
    """Words under windows of three that start at the sorted ``positions``."""
    return F.when(F.size(positions) == 0, F.lit(0)).otherwise(
        F.aggregate(
            positions,
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )
    )


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts the rules read, as long columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, BLANK_RUN), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    df = df.withColumns({"__qr_words": words, "__qr_lines": lines})
    w, lines = F.col("__qr_words"), F.col("__qr_lines")
    n = F.size(w)
    # Bits a position needs; the rest of the 64 hold the window's hash. Sorting plain longs brings
    # equal windows side by side, and neighbours are then compared by their whole hash.
    df = df.withColumn(
        "__qr_windows",
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3),
                                   lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
        .otherwise(F.array().cast("array<bigint>")),
    )
    windows = F.col("__qr_windows")
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    bits = F.ceil(F.log2(n.cast("double") + 1)).cast("int")
    df = df.withColumn("__qr_bits", bits)
    b = F.col("__qr_bits")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1
    df = df.withColumn(
        "__qr_sorted",
        F.when(repeats, F.sort_array(F.transform(
            windows, lambda h, i: F.call_function("shiftleft", h, b).bitwiseOR(i.cast("long")))))
        .otherwise(F.array().cast("array<bigint>")),
    ).withColumn("__qr_mask", mask)
    s, m = F.col("__qr_sorted"), F.col("__qr_mask")
    at = lambda v: F.get(windows, v.bitwiseAND(m).cast("int"))
    same = lambda v, other: other.isNotNull() & (at(v) == at(other))
    df = df.withColumn(
        "__qr_positions",
        F.sort_array(F.transform(
            F.filter(s, lambda v, k: same(v, F.get(s, k - 1)) | same(v, F.get(s, k + 1))),
            lambda v: v.bitwiseAND(m).cast("int"))),
    )
    df = df.withColumns({
        "n_words": _count(w),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_lines": _count(lines),
        "n_dup_lines": _count(lines) - _count(F.array_distinct(lines)),
        "n_repeat_words": _covered(F.col("__qr_positions")).cast("long"),
        "n_stop_words": _count(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))),
        "n_alpha_words": _count(F.filter(w, lambda x: x.rlike(r"\p{L}"))),
        "n_bullet_lines": _count(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))),
        "n_ellipsis_lines": _count(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))),
    })
    return df.drop(*[c for c in df.columns if c.startswith("__qr_")])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds."""
    held = F.lit(True)
    for rule in rules:
        of, per = F.col(rule.of).cast("double"), F.col(rule.per).cast("double")
        for bound, inside in ((rule.least, lambda x, y: x >= y), (rule.most, lambda x, y: x <= y)):
            if bound is not None:
                held = held & ((per == 0) | inside(of, per * F.lit(float(bound))))
    return held


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``df`` with its measures, ``base_failed`` and ``kept``."""
    return measures(df, text).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def keep(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep.

    A filter on ``kept`` would be pushed below the measures and repeat their expressions inside one
    another; an explode of one element or none keeps the same rows and computes each once.
    """
    judged = apply_rules(df, rules, text)
    return judged.select(*df.columns, F.explode(F.array_repeat(F.lit(True), F.col("kept").cast("int"))).alias("__qr_kept")
                         ).drop("__qr_kept")
