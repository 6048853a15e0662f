"""Contract checks and data-quality gates. Each is one pass over the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import REQUEST_ID_MAX, REQUEST_RANGES, Contract
from ledgerlake.functions.stats import clean_double


class QualityError(ValueError):
    """A gate or a fail-fast contract check found bad rows."""


def _violations(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules a row breaks, in order. A rule that evaluates to null counts as kept."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def check_contract(df: DataFrame, contract: Contract, mode: str = "split", values: bool = False) -> DataFrame:
    """Add ``violations``: required values that are missing, and values of the wrong type; with
    ``values`` also those outside their range or domain, and texts that are too long.

    ``mode='fail'`` raises on the first bad batch instead, naming how often each rule was broken.
    """
    rules: list[tuple[str, Column]] = []
    for name, dtype in contract.types.items():
        if name not in df.columns:
            if name in contract.required:
                rules.append((f"{name}:missing", F.lit(True)))
            continue
        if name in contract.required:
            rules.append((f"{name}:required", F.col(name).isNull()))
        if df.schema[name].dataType != dtype:
            rules.append((f"{name}:type", F.col(name).isNotNull() & F.col(name).try_cast(dtype).isNull()))
    if values:
        for name, (low, high) in contract.ranges.items():
            if name in df.columns:
                v = _number(df, name)
                rules.append((f"{name}:range", (v < low) | (v > high)))
        rules += [(f"{name}:domain", ~F.col(name).isin(*allowed)) for name, allowed in contract.domains.items()
                  if name in df.columns]
        rules += [(f"{name}:max_length", F.length(name) > limit) for name, limit in contract.max_length.items()
                  if name in df.columns]
    checked = df.withColumn("violations", _violations(rules))
    if mode == "fail":
        bad = checked.select(F.explode("violations").alias("rule")).groupBy("rule").count().collect()  # one row per rule
        if bad:
            raise QualityError(f"{contract.name}: " + ", ".join(f"{r['rule']}={r['count']}" for r in bad))
        return df
    return checked


def dq_fraud(df: DataFrame, score: str = "fraud_score") -> DataFrame:
    s = clean_double(F.col(score))
    nulls = F.count_if(s.isNull())
    outside = F.count_if((s < 0) | (s > 1))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        nulls.alias("null_scores"),
        outside.alias("out_of_range"),
        F.round(F.avg(s.isNull().cast("int")) * 100, 2).alias("null_pct"),
        ((nulls == 0) & (outside == 0)).alias("passed"),
    )


def dq_credit(df: DataFrame, bands: tuple[str, ...] = ("high", "medium", "low")) -> DataFrame:
    invalid = F.count_if(F.col("risk_band").isNull() | ~F.col("risk_band").isin(*bands))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        invalid.alias("invalid_bands"),
        F.count_if(clean_double(F.col("score")).isNull()).alias("null_scores"),
        (invalid == 0).alias("passed"),
    )


def dq_churn(df: DataFrame) -> DataFrame:
    p = clean_double(F.col("churn_probability"))
    outside = F.count_if((p < 0) | (p > 1))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        outside.alias("out_of_range"),
        F.count_if(clean_double(F.col("confidence")).isNull()).alias("null_confidence"),
        (outside == 0).alias("passed"),
    )


def gate(report: DataFrame) -> dict:
    """Raise unless the one-row report passed; return it as a dict."""
    row = report.first().asDict()
    if not row["passed"]:
        raise QualityError(f"data quality gate failed: {row}")
    return row


def _long(one_row: DataFrame, names: list[tuple[str, str]], first: str) -> DataFrame:
    """One aggregated row ``m0..mn`` to rows ``(first, column, violations)``."""
    cells = ", ".join(f"'{kind}', '{column}', m{i}" for i, (kind, column) in enumerate(names))
    return one_row.select(F.expr(f"stack({len(names)}, {cells}) AS (`{first}`, `column`, violations)"))


def validate_features(df: DataFrame, rules: dict) -> DataFrame:
    """Rows ``(check, column, violations)`` for the declared rules.

    ``rules`` may hold required_columns, non_nullable, ranges (inclusive) and types (Spark type
    names). Column presence and types are read off the schema, the rest is one aggregate.
    """
    names: list[tuple[str, str]] = []
    exprs: list[Column] = []

    def add(kind: str, column: str, found: Column) -> None:
        exprs.append(found.cast("bigint").alias(f"m{len(names)}"))
        names.append((kind, column))

    present = set(df.columns)
    for c in rules.get("required_columns", []):
        add("required", c, F.lit(0 if c in present else 1))
    for c in rules.get("non_nullable", []):
        if c in present:
            add("non_null", c, F.count_if(_missing(df, c)))
    for c, (low, high) in rules.get("ranges", {}).items():
        if c in present:
            v = _number(df, c)
            add("range", c, F.count_if((v < low) | (v > high)))
    for c, expected in rules.get("types", {}).items():
        if c in present:
            add("type", c, F.lit(0 if df.schema[c].dataType.simpleString() == expected else 1))
    return _long(df.agg(F.count(F.lit(1)).alias("n"), *exprs), names, "check")


def _is_floating(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def _number(df: DataFrame, c: str) -> Column:
    return clean_double(F.col(c)) if _is_floating(df, c) else F.col(c)


def _missing(df: DataFrame, c: str) -> Column:
    return _number(df, c).isNull()


def check_constraints(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows ``(constraint, column, violations)``: NOT NULL, range, domain, length, primary key.

    A primary-key violation is a row beyond the first with the same key.
    """
    names: list[tuple[str, str]] = []
    exprs: list[Column] = []

    def add(kind: str, column: str, broken: Column) -> None:
        exprs.append(F.count_if(broken).alias(f"m{len(names)}"))
        names.append((kind, column))

    for c in contract.required:
        add("not_null", c, _missing(df, c))
    for c, (low, high) in contract.ranges.items():
        if c in df.columns:
            v = _number(df, c)
            add("range", c, (v < low) | (v > high))
    for c, values in contract.domains.items():
        add("domain", c, ~F.col(c).isin(*values))
    for c, limit in contract.max_length.items():
        if c in df.columns:
            add("max_length", c, F.length(c) > limit)
    per_rule = _long(df.agg(*exprs), names, "constraint")
    if not contract.primary_key:
        return per_rule
    keys = df.groupBy(*contract.primary_key).agg(F.count(F.lit(1)).alias("n"))
    surplus = keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
        F.lit("primary_key").alias("constraint"),
        F.lit("+".join(contract.primary_key)).alias("column"),
        F.col("violations"),
    )
    return per_rule.unionByName(surplus)


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``valid`` and ``errors`` to scoring requests.

    An id is ASCII letters, digits, ``-`` and ``_`` with at least one letter or digit.
    """
    tid = F.col("transaction_id")
    rules: list[tuple[str, Column]] = [
        ("id_length", tid.isNull() | (F.length(tid) < 1) | (F.length(tid) > REQUEST_ID_MAX)),
        ("id_format", ~tid.rlike("^[A-Za-z0-9_-]*[A-Za-z0-9][A-Za-z0-9_-]*$")),
    ]
    for c, (low, high) in REQUEST_RANGES.items():
        v = _number(df, c)
        rules.append((c, v.isNull() | (v < low) | (v > high)))
    broken = reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(True)) for _, r in rules])
    return df.withColumn("errors", _violations(rules)).withColumn("valid", ~broken)
