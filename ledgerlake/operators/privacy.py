"""Hashing, redaction, pattern masking and field encryption."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = "***MASKED***"
REDACTED = "***REDACTED***"
ENCRYPTED = "ENC:"

# Columns that hold personal data, and the patterns in the order they are applied.
PII_COLUMNS = ("customer_id", "account_id", "email", "phone", "address", "name", "ssn")
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b",
}
# Fields to encrypt per layer and data set.
PII_FIELDS = {
    ("bronze", "fraud"): ("customer_id", "transaction_id", "payload.device_id"),
    ("bronze", "credit_risk"): ("account_id", "customer_id"),
    ("bronze", "churn"): ("customer_id",),
    ("silver", "fraud"): ("customer_id", "transaction_id"),
    ("silver", "credit_risk"): ("account_id",),
    ("silver", "churn"): ("customer_id",),
}


def hash_value(c: Column, salt: str) -> Column:
    return F.substr(F.sha2(F.concat(c.cast("string"), F.lit(salt)), 256), F.lit(1), F.lit(16))


def hash_columns(df: DataFrame, cols: list[str], salt: str) -> DataFrame:
    """Salted 16-digit hashes, stable across tables so that they still join. Null stays null."""
    return df.withColumns({c: hash_value(F.col(c), salt) for c in cols if c in df.columns})


def redact(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.lit(REDACTED)) if col in df.columns else df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def mask_text(c: Column) -> Column:
    for pattern in PII_PATTERNS.values():
        c = F.regexp_replace(c, F.lit(pattern), F.lit(MASK))
    return c


def mask_patterns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mask every pattern in the given (default: all) text columns."""
    return df.withColumns({c: mask_text(F.col(c)) for c in (cols or text_columns(df))})


def pii_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows ``(column, pattern, matches)``, counted in one pass on the unmasked text."""
    cells, exprs = [], []
    for c in cols or text_columns(df):
        for name, pattern in PII_PATTERNS.items():
            m = f"m{len(exprs)}"
            exprs.append(F.coalesce(F.sum(F.regexp_count(F.col(c), F.lit(pattern))), F.lit(0)).alias(m))
            cells.append(f"'{c}', '{name}', {m}")
    stacked = f"stack({len(cells)}, {', '.join(cells)}) AS (`column`, pattern, matches)"
    return df.agg(*exprs).select(F.expr(stacked))


def mask_table(df: DataFrame, salt: str) -> DataFrame:
    """Hash the known columns and mask patterns in the other text columns.

    Hashed columns are left alone: an all-digit hash would otherwise look like a card number.
    """
    known = [c for c in PII_COLUMNS if c in df.columns]
    others = [c for c in text_columns(df) if c not in known]
    out = hash_columns(df, known, salt)
    return mask_patterns(out, others) if others else out


def pii_fields(layer: str, dataset: str) -> tuple[str, ...]:
    return PII_FIELDS.get((layer, dataset), ())


def _encrypt(c: Column, key: Column) -> Column:
    text = c.cast("string")
    sealed = F.concat(F.lit(ENCRYPTED), F.base64(F.aes_encrypt(F.encode(text, "UTF-8"), key, F.lit("GCM"))))
    return F.when(text.startswith(ENCRYPTED), text).when(text.isNotNull(), sealed)


def _decrypt(c: Column, key: Column) -> Column:
    body = F.try_to_binary(F.substr(c, F.lit(len(ENCRYPTED) + 1)), F.lit("base64"))
    opened = F.try_aes_decrypt(body, key, F.lit("GCM")).cast("string")
    return F.when(c.startswith(ENCRYPTED), opened).otherwise(c)


class MissingField(ValueError):
    """A configured field is not in the table."""


def _json_value(text: Column, inner: str) -> Column:
    return F.get_json_object(text, f"$.{inner}")


def _change_json(text: Column, inners: list[str], change) -> Column:
    """The JSON object with some fields changed and its other fields as they are. A text that is no
    object, or has no such field or only nulls there, stays what it is."""
    # One struct for each text: what the lambda takes from it is parsed once, however often it is used.
    values = [_json_value(text, inner).alias(f"f{i}") for i, inner in enumerate(inners)]
    parsed = F.array(F.struct(F.from_json(text, "map<string,variant>").alias("all"), *values))

    def changed(p: Column) -> Column:
        def put(k: Column, v: Column) -> Column:
            for i, inner in enumerate(inners):
                v = F.when((k == inner) & p[f"f{i}"].isNotNull(), change(p[f"f{i}"]).cast("variant")).otherwise(v)
            return v

        present = reduce(or_, (p[f"f{i}"].isNotNull() for i in range(len(inners))))
        return F.when(p["all"].isNotNull() & present, F.to_json(F.transform_values(p["all"], put))).otherwise(text)

    return F.get(F.transform(parsed, changed), F.lit(0))


def located(df: DataFrame, name: str) -> str:
    """Where a configured field lies: Bronze events keep their fields in the text of ``payload``."""
    inside = "payload" in df.columns and isinstance(df.schema["payload"].dataType, T.StringType)
    return f"payload.{name}" if inside and "." not in name and name not in df.columns else name


def field_value(df: DataFrame, name: str) -> Column | None:
    """A configured field as text: a column, a field of a struct, or a field inside a JSON text."""
    name = located(df, name)
    top, _, inner = name.partition(".")
    if top not in df.columns:
        return None
    if inner and isinstance(df.schema[top].dataType, T.StringType):
        return _json_value(F.col(top), inner)
    if inner and inner not in df.schema[top].dataType.names:
        return None
    return F.col(name).cast("string")


def _apply(df: DataFrame, fields, change, strict: bool) -> DataFrame:
    in_json: dict[str, list[str]] = {}
    for name in fields:
        name = located(df, name)
        top, _, inner = name.partition(".")
        if field_value(df, name) is None:
            if strict:
                raise MissingField(f"{name} is to be encrypted, but the table has {df.columns}")
            continue
        if not inner:
            df = df.withColumn(top, change(F.col(top)))
        elif isinstance(df.schema[top].dataType, T.StructType):
            df = df.withColumn(top, F.col(top).withField(inner, change(F.col(name))))
        else:
            in_json.setdefault(top, []).append(inner)
    return df.withColumns({top: _change_json(F.col(top), list(dict.fromkeys(inners)), change) for top, inners in in_json.items()})


def encrypt_fields(df: DataFrame, fields, key: bytes, enabled: bool = True, strict: bool = True) -> DataFrame:
    """AES-256-GCM with a fresh random nonce per value; values already encrypted pass through.

    Nested fields are named with a dot and lie in a struct or in the text of a JSON object. Only text
    survives the round trip unchanged in type. A configured field that the table does not have raises, as
    leaving it out would leave personal data in plain text elsewhere unnoticed.
    """
    return _apply(df, fields, lambda c: _encrypt(c, F.lit(key)), strict) if enabled else df


def decrypt_fields(df: DataFrame, fields, key: bytes) -> DataFrame:
    """Open encrypted values; plain text passes through, unreadable values become null."""
    return _apply(df, fields, lambda c: _decrypt(c, F.lit(key)), strict=False)


def undecryptable(df: DataFrame, fields, key: bytes) -> DataFrame:
    """Rows with an encrypted value that cannot be opened, for quarantine."""
    broken = F.lit(False)
    for name in fields:
        c = field_value(df, name)
        if c is None:
            continue
        broken = broken | (c.isNotNull() & _decrypt(c, F.lit(key)).isNull())
    return df.where(broken)


def encryption_coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows ``(field, encrypted, total, percentage)`` with an ``__all__`` row for the whole table."""
    values = [field_value(df, f) for f in fields]
    # A field that is not there is not encrypted: it counts as none of the rows.
    sealed = [F.lit(False) if v is None else F.coalesce(v.startswith(ENCRYPTED), F.lit(False)) for v in values]
    counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"m{i}") for i, c in enumerate(sealed)])
    cells = "".join(f"'{f}', m{i}, n, " for i, f in enumerate(fields))
    every = " + ".join(["0L", *[f"m{i}" for i in range(len(fields))]])
    rows = counted.select(
        F.expr(f"stack({len(fields) + 1}, {cells}'__all__', {every}, n * {len(fields)}) AS (field, encrypted, total)")
    )
    share = F.coalesce(F.try_divide(F.col("encrypted") * 100.0, F.col("total")), F.lit(0.0))
    return rows.withColumn("percentage", F.round(share, 2))
