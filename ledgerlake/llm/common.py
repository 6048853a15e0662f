"""Shared pieces of the corpus operators: words, stored intermediate tables, graph components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir

# The white space of all word and line rules: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_RUN = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What one Arrow batch may hold on its way to Python: rows of whole documents are large.
BATCH_ROWS, BATCH_BYTES = "20000", "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches that carry whole texts to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Where all characters are ASCII, ``lower`` does that, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and lost executors cost
    nothing that was finished. Later plans know the table's size."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by ``store`` that no later plan reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


LEVELS = 16  # of counts between one and its double


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the highest counts, at most ``most``. Counts are taken by levels, all rows of a level or none, so the
    number is found by a small histogram, and no task or driver ever sorts or receives more than the rows returned."""
    level = F.floor(LEVELS * F.log2(F.col(count).cast("double")) + 1e-9)
    sizes = sorted(((r[0], r[1]) for r in df.groupBy(level.alias("level")).count().collect()), reverse=True)  # 16 x 63 rows at most
    total, lowest = 0, None
    for at, n in sizes:
        total += n
        if total > most:
            break
        lowest = at
    return df.where(level >= lowest) if lowest is not None else df.where(F.lit(False))


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component) of every node of ``links (a, b)``; component is the smallest node reachable.

    Each round every node points at the node of least seeded hash among itself and its neighbours,
    and links are redrawn between the nodes pointed at. That set shrinks by a constant factor a
    round whatever the shape of the graph, so long chains need no more than their logarithm. The
    smallest neighbour is a partial aggregate, so a node with very many links is no task of its own.
    """
    spark = links.sparkSession
    edges = store(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), "links")
    pointers: list[DataFrame] = []
    for seed in range(rounds):
        if edges.isEmpty():
            break
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), c.alias("to"))
        pointer = store(
            ends.groupBy(F.col("a").alias("node")).agg(F.min(rank(F.col("b"))).alias("least"))
            .select("node", F.least(F.col("least"), rank(F.col("node")))["to"].alias("to")),
            "pointers",
        )
        pointers.append(pointer)
        drawn = (
            edges.join(pointer.select(F.col("node").alias("a"), F.col("to").alias("pa")), "a")
            .join(pointer.select(F.col("node").alias("b"), F.col("to").alias("pb")), "b")
            .where("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
        edges = store(drawn, "links")
    else:
        raise RuntimeError("links still left after the last round")
    if not pointers:
        return spark.createDataFrame([], f"node {dict(links.dtypes)['a']}, component {dict(links.dtypes)['a']}")
    root = pointers[-1].select("node", F.col("to").alias("root"))
    for pointer in reversed(pointers[:-1]):
        later = root.select(F.col("node").alias("to"), F.col("root").alias("further"))
        root = store(pointer.join(later, "to", "left").select("node", F.coalesce("further", "to").alias("root")),
                     "roots")
    least = root.groupBy("root").agg(F.min("node").alias("component"))
    return store(root.join(least, "root").select("node", "component"), "components")
