"""Hashing, masking and encryption."""

from pyspark.sql import functions as F

from ledgerlake.operators import privacy
from ledgerlake.plans.catalog import query
from ledgerlake.plans.migration import encrypt_migrate, encrypted_files, migration_status
from ledgerlake.session import shared_dir
from ledgerlake.sources.publish import row_file

SALT = "pepper"
KEY = bytes(range(32))  # a job parameter in real use

EMAIL, PHONE, SSN, CARD = privacy.PII_PATTERNS.values()


def masked(c: str) -> str:
    for p in privacy.PII_PATTERNS.values():
        c = f"regexp_replace({c}, '{p}', '{privacy.MASK}', 'g')"
    return c.replace("{", "{{").replace("}", "}}")


def counted(c: str, pattern: str) -> str:
    p = pattern.replace("{", "{{").replace("}", "}}")
    return f"CAST(coalesce(sum(len(regexp_extract_all({c}, '{p}'))), 0) AS BIGINT)"


def hashed(c: str) -> str:
    return f"substr(sha256(concat({c}, '{SALT}')), 1, 16)"


@query("pii_hash", f"SELECT transaction_id, {hashed('customer_id')} AS customer_id FROM {{tx_scores}}")
def _(fx):
    return privacy.hash_columns(fx("tx_scores").select("transaction_id", "customer_id"), ["customer_id"], SALT)


@query("pii_redact_column", "SELECT c_custkey, '***REDACTED***' AS c_name, c_mktsegment FROM {customer}")
def _(fx):
    return privacy.redact(fx("customer").select("c_custkey", "c_name", "c_mktsegment"), "c_name")


@query("pii_mask_patterns", f"SELECT id, {masked('text')} AS text FROM {{texts}}")
def _(fx):
    return privacy.mask_patterns(fx("texts"), ["text"])


@query(
    "pii_detect",
    " UNION ALL ".join(
        f"SELECT 'text' AS \"column\", '{n}' AS pattern, {counted('text', p)} AS matches FROM {{texts}}"
        for n, p in privacy.PII_PATTERNS.items()
    ),
)
def _(fx):
    return privacy.pii_report(fx("texts"), ["text"])


@query(
    "pii_mask_table",
    f"SELECT {hashed('customer_id')} AS customer_id, {masked('note')} AS note "
    "FROM (SELECT concat('c', doc_id) AS customer_id, text AS note FROM {documents}) t",
)
def _(fx):
    table = fx("documents").select(F.concat(F.lit("c"), "doc_id").alias("customer_id"), F.col("text").alias("note"))
    return privacy.mask_table(table, SALT)


def sealed_length(c: str) -> str:
    # nonce of 12 bytes and tag of 16 bytes, base64 in groups of 3 bytes, then the prefix
    return f"CAST(4 + ((length({c}) + 28 + 2) // 3) * 4 AS INT)"


@query(
    "encrypt_fields",
    f"""SELECT event_id, true AS sealed, {sealed_length('transaction_id')} AS transaction_length,
               {sealed_length('customer_id')} AS customer_length FROM {{tx_scores}}""",
)
def _(fx):
    out = privacy.encrypt_fields(fx("tx_scores"), privacy.pii_fields("silver", "fraud"), KEY)
    return out.select(
        "event_id",
        (F.startswith("transaction_id", F.lit("ENC:")) & F.startswith("customer_id", F.lit("ENC:"))).alias("sealed"),
        F.length("transaction_id").alias("transaction_length"),
        F.length("customer_id").alias("customer_length"),
    )


@query("decrypt_fields", "SELECT event_id, transaction_id, customer_id FROM {tx_scores}")
def _(fx):
    fields = privacy.pii_fields("silver", "fraud")
    sealed = privacy.encrypt_fields(fx("tx_scores").select("event_id", *fields), fields, KEY)
    return privacy.decrypt_fields(sealed, fields, KEY)


@query(
    "encrypt_bronze_payload",
    """SELECT seq, d AS device_id, event_id, d IS NOT NULL AS sealed
       FROM (SELECT event_id AS seq, concat('e', event_id) AS event_id, concat('d', event_id % 4) AS d FROM {events_k}) t""",
)
def _(fx):
    """Bronze fraud keeps its personal data in a JSON text: sealed there, then opened again."""
    # Ciphers cost far more than a shuffle, and a file of few row groups would keep few cores busy.
    spread = fx("events_k").repartition(int(fx.spark.conf.get("spark.sql.shuffle.partitions")))
    bronze = spread.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("e"), "event_id").alias("event_id"),
        F.to_json(F.struct(F.concat(F.lit("c"), "user_id").alias("customer_id"), F.concat(F.lit("t"), "event_id").alias("transaction_id"),
                           F.concat(F.lit("d"), F.col("event_id") % 4).alias("device_id"), "value")).alias("payload"))
    fields = privacy.pii_fields("bronze", "fraud")
    sealed = privacy.encrypt_fields(bronze, fields, KEY)
    opened = privacy.decrypt_fields(sealed.withColumn("was", F.get_json_object("payload", "$.device_id")), fields, KEY)
    return opened.select("seq", F.get_json_object("payload", "$.device_id").alias("device_id"), "event_id",
                         F.startswith("was", F.lit("ENC:")).alias("sealed"))


@query(
    "encryption_coverage",
    """WITH t AS (SELECT count(*) AS total, count(*) FILTER (WHERE fraud_score >= 0.5) AS sealed FROM {tx_scores})
       SELECT 'customer_id' AS field, sealed AS encrypted, total, round(sealed * 100.0 / total, 2) AS percentage FROM t
       UNION ALL SELECT 'transaction_id', 0, total, 0.0 FROM t
       UNION ALL SELECT '__all__', sealed, total * 2, round(sealed * 100.0 / (total * 2), 2) FROM t""",
)
def _(fx):
    """A table half-way through a migration: high scores encrypted, one field not started."""
    scores = fx("tx_scores")
    sealed = privacy.encrypt_fields(scores.where("fraud_score >= 0.5"), ["customer_id"], KEY)
    mixed = sealed.unionByName(scores.where("fraud_score < 0.5"))
    return privacy.encryption_coverage(mixed, ["customer_id", "transaction_id"])


@query(
    "encrypt_migrate",
    """SELECT f AS field, n * m AS encrypted, n * m AS total, 100.0 AS percentage
       FROM (SELECT count(*) AS n FROM {tx_scores}) t, (VALUES ('customer_id', 1), ('transaction_id', 1), ('__all__', 2)) v(f, m)""",
)
def _(fx):
    src, dst, progress = (shared_dir(fx.spark, d) for d in ("plain", "sealed", "progress"))
    fx("tx_scores").write.parquet(src)
    return encrypt_migrate(fx.spark, src, dst, "silver", "fraud", KEY, progress)


@query("migration_status", "SELECT event_id % 4 AS part, count(*) AS rows, 2 * count(*) AS encrypted, true AS done FROM {tx_scores} GROUP BY 1")
def _(fx):
    """One folder of files for each part: all done, and every personal value of each part encrypted."""
    spark = fx.spark
    src, dst, progress = (shared_dir(spark, d) for d in ("plain", "sealed", "progress"))
    fx("tx_scores").withColumn("part", F.col("event_id") % 4).write.parquet(src)
    encrypt_migrate(spark, src, dst, "silver", "fraud", KEY, progress, max_files=2)
    done = migration_status(spark, src, progress).agg(F.bool_and(F.col("state") == "done").alias("done"))
    files = encrypted_files(spark, dst, "silver", "fraud").where("plain = 0")
    rows = spark.read.parquet(dst).select("part", row_file(spark, dst).alias("file"))
    # Files hold several parts: a part's rows count their two values where their file has no plain one.
    found = rows.join(files.select("file"), "file").groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    return found.withColumns({"encrypted": 2 * F.col("rows"), "done": done.scalar()})
