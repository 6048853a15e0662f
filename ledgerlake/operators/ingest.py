"""Raw stream records to Bronze rows, with a quarantine for the ones that cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import BRONZE_FRAUD, Contract
from ledgerlake.operators.quality import check_contract


def _field(variant: Column, name: str) -> Column:
    return F.try_variant_get(variant, f"$.{name}", "string")


def _with_default(variant: Column, name: str, default: str) -> Column:
    """The default stands in for an absent key only; an explicit JSON null stays null."""
    raw = F.try_variant_get(variant, f"$.{name}", "variant")
    return F.when(raw.isNull(), F.lit(default)).otherwise(_field(variant, name))


def parse_events(raw: DataFrame, data: str = "data") -> DataFrame:
    """Base64 JSON records (``data``, ``sequence``, ``arrival``) to Bronze columns.

    Adds ``ok`` (a JSON object was read) and ``error``; nothing is dropped, see ``split_valid``.
    """
    text = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    doc = F.when(F.is_valid_utf8(text), F.try_parse_json(text))
    # One-element explode: the record is decoded and parsed once, where a plain column would be
    # computed again below every filter that is pushed through the projection.
    once = F.explode(F.array(F.struct(text.alias("text"), doc.alias("doc"))))
    parsed = raw.withColumn("__r", once).select(*raw.columns, F.col("__r.text").alias("__text"), F.col("__r.doc").alias("__doc"))
    # a valid JSON text is an object exactly if it opens with a brace
    is_object = F.col("__doc").isNotNull() & F.col("__text").rlike(r"^[ \t\r\n]*\{")
    v = F.col("__doc")
    payload = F.try_variant_get(v, "$.payload", "variant")
    return parsed.withColumn("ok", is_object).select(
        *[c for c in raw.columns if c not in (data, "sequence", "arrival")],
        F.when(F.col("ok"), _field(v, "event_id")).alias("event_id"),
        F.when(F.col("ok"), _with_default(v, "event_type", BRONZE_FRAUD.defaults["event_type"])).alias("event_type"),
        F.when(F.col("ok"), F.try_to_timestamp(_field(v, "event_time"))).alias("event_time"),
        F.when(F.col("ok"), _with_default(v, "source_system", BRONZE_FRAUD.defaults["source_system"])).alias(
            "source_system"
        ),
        F.when(
            F.col("ok"),
            F.when(payload.isNull(), F.lit("{}")).when(~F.is_variant_null(payload), F.to_json(payload)),
        ).alias("payload"),
        F.col("sequence").alias("kinesis_sequence"),
        F.col("arrival").alias("kinesis_timestamp"),
        "ok",
        F.when(F.col("__doc").isNull(), "invalid json")
        .when(~F.col("ok"), "record is not a json object")
        .alias("error"),
        F.coalesce("__text", data).alias("record"),
    )


def payload_fields(bronze: DataFrame) -> DataFrame:
    """Bronze fraud rows with the payload fields the features need as typed columns."""
    doc = F.try_parse_json("payload")
    return bronze.withColumn("__p", doc).select(
        "*",
        F.try_variant_get("__p", "$.customer_id", "string").alias("customer_id"),
        F.try_variant_get("__p", "$.device_id", "string").alias("device_id"),
        F.try_variant_get("__p", "$.latitude", "double").alias("latitude"),
        F.try_variant_get("__p", "$.longitude", "double").alias("longitude"),
    ).drop("__p")


def split_valid(parsed: DataFrame, failed_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(Bronze rows, dead letters as ``record, error, failed_at``)."""
    failed_at = failed_at if failed_at is not None else F.current_timestamp()
    good = parsed.where("ok").drop("ok", "error", "record")
    keep = [c for c in parsed.columns if c not in (*BRONZE_FRAUD.columns, "ok", "error", "record")]
    dlq = parsed.where("NOT ok").select(*keep, "record", "error", failed_at.alias("failed_at"))
    return good, dlq


def ingest_counts(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count_if(F.col("ok")).alias("processed"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def dedup_events(df: DataFrame, key: str = "event_id", order: str = "kinesis_sequence") -> DataFrame:
    """One row per event, the first delivery. Copies are dropped before the shuffle as well.

    Rows without an id are no copies of each other: all of them stay. Sequence numbers held as text are
    ordered as numbers (up to 38 digits; a longer number is a later one), so 9 comes before 10.
    """
    placed: list[Column] = [F.col(order)]
    if isinstance(df.schema[order].dataType, T.StringType):
        digits = F.regexp_replace(order, "^0+(?=[0-9])", "")
        placed = [F.when(F.col(order).rlike("^[0-9]+$"), F.length(digits)), digits, F.col(order)]
    # One of its own per row where there is no id, so that such rows do not meet in one task.
    lone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    first = Window.partitionBy(key, "__lone").orderBy(*placed)
    ranked = df.withColumn("__lone", lone).withColumn("__r", F.row_number().over(first))
    return ranked.where(F.col("__r") == 1).drop("__r", "__lone")


def ingest_batch(raw: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(typed Bronze rows, rejected rows with their violations) of a text-typed batch."""
    checked = check_contract(raw, contract)
    typed = [F.col(c).try_cast(t).alias(c) if c in raw.columns else F.lit(None).cast(t).alias(c)
             for c, t in contract.types.items()]
    extra = [c for c in raw.columns if c not in contract.types]
    good = checked.where(F.size("violations") == 0).select(*extra, *typed)
    bad = checked.where(F.size("violations") > 0)
    return good, bad
