"""Publication of Parquet tables: new files are complete beside the table before anything of it is touched.

A table at ``path`` has an area of its own next to it (``_<name>.incoming``). A publication

1. writes the new files under ``new/`` of the area,
2. writes a manifest, by a rename, which makes it final: what replaces, joins and leaves the table,
3. moves old folders to ``old/`` of the area, new ones to their place, and deletes what leaves,
4. deletes the area.

Whatever happens before step 2 leaves the table as it was. After it, ``recover`` (called at the start of every
publication and load) carries steps 3 and 4 through from wherever they stopped: each move is skipped when it is
done already. There is one writer per table at a time, and storage must rename folders, as HDFS-like file systems do.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Area:
    """The folder beside a table through which its new files come, and its file operations."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, path.rstrip("/")
        parent, _, name = self.table.rpartition("/")
        self.path = f"{parent}/_{name}.incoming" if parent else f"_{name}.incoming"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.table).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def move(self, src: str, dst: str) -> None:
        target = self._path(dst)
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self._path(src), target):
            raise OSError(f"could not move {src} to {dst}")

    def children(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(path))] if self.exists(path) else []

    def folders(self, path: str, depth: int) -> list[str]:
        """Partition folders ``depth`` levels down, relative to ``path``."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{c}".lstrip("/") for f in found for c in self.children(f"{path}/{f}") if "=" in c]
        return found

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(f"{path}.part"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(f"{path}.part", path)

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def recover(spark: SparkSession, path: str) -> None:
    """Finish a publication whose manifest was written, drop one that did not get that far."""
    area = Area(spark, path)
    if area.exists(area.path):
        if area.exists(f"{area.path}/manifest"):
            _apply(area, json.loads(area.read_text(f"{area.path}/manifest")))
        area.delete(area.path)


def _apply(area: Area, manifest: dict) -> None:
    """Every step is skipped where an earlier attempt has done it."""
    at = lambda root, name: f"{root}/{name}".rstrip("/")
    for name in manifest["replace"]:  # a folder; the empty name is the whole table
        new, target = at(f"{area.path}/new", name), at(area.table, name)
        if area.exists(new):
            if area.exists(target):
                area.move(target, at(f"{area.path}/old", name))
            area.move(new, target)
    for name in manifest["add"]:  # a file
        if area.exists(at(f"{area.path}/new", name)):
            area.move(at(f"{area.path}/new", name), at(area.table, name))
    for name in manifest["drop"]:  # a folder or file that nothing replaces
        area.delete(at(area.table, name))


def _publish(area: Area, replace: list[str] = (), add: list[str] = (), drop: list[str] = ()) -> None:
    area.write_text(f"{area.path}/manifest", json.dumps({"replace": list(replace), "add": list(add), "drop": list(drop)}))
    recover(area.spark, area.table)


def _write_new(area: Area, df: DataFrame, partition_by: list[str], sort_by: list[str] = (), spread: bool = True) -> None:
    recover(area.spark, area.table)
    if partition_by and spread:  # rows of one partition value go to several writers when they are many
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{area.path}/new")


def publish_table(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    """Replace the whole table; ``df`` may read it."""
    area = Area(df.sparkSession, path)
    _write_new(area, df, partition_by or [], sort_by or [])
    _publish(area, replace=[""])


def publish_partitions(df: DataFrame, path: str, partition_by: list[str], touched: list[str] = ()) -> None:
    """Replace the partitions that ``df`` has rows for; those of ``touched`` (folders relative to the table)
    that it has none for are removed. ``df`` may read the table."""
    area = Area(df.sparkSession, path)
    _write_new(area, df, partition_by)
    filled = area.folders(f"{area.path}/new", len(partition_by))
    _publish(area, replace=filled, drop=sorted(set(touched) - set(filled)))


def publish_files(df: DataFrame, path: str, partition_by: list[str], old_files: list[str], sort_by: list[str] | None = None,
                  spread: bool = True) -> int:
    """Replace the files ``old_files`` (relative to the table) by files with the rows of ``df``; returns how many.
    Files that somebody has added meanwhile stay. ``spread=False`` keeps the partitioning of ``df``."""
    area = Area(df.sparkSession, path)
    _write_new(area, df, partition_by, sort_by or [], spread)
    new = [f"{folder}/{name}".lstrip("/") for folder in area.folders(f"{area.path}/new", len(partition_by))
           for name in area.children(f"{area.path}/new/{folder}") if not name.startswith(("_", "."))]
    _publish(area, add=new, drop=old_files)
    return len(new)


def _root(spark: SparkSession, table: str) -> str:
    """The table's path without scheme and host."""
    root = spark._jvm.org.apache.hadoop.fs.Path(table.rstrip("/"))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()


def relative(spark: SparkSession, table: str, file: str) -> str:
    """A file named by ``DataFrame.inputFiles`` relative to its table."""
    full, root = spark._jvm.org.apache.hadoop.fs.Path(unquote(file)).toUri().getPath(), _root(spark, table)
    if not full.startswith(root + "/"):
        raise ValueError(f"{file} is not in {table}")
    return full[len(root) + 1:]


def inside(spark: SparkSession, table: str, file: Column) -> Column:
    return F.regexp_extract(file, rf"\Q{_root(spark, table)}\E/(.*)$", 1)


def folder_of(file: Column) -> Column:
    return F.regexp_replace(file, "/?[^/]*$", "")


def row_file(spark: SparkSession, table: str) -> Column:
    """The file, relative to the table, that a row of it comes from. The metadata column holds an escaped URI."""
    return inside(spark, table, F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, modified) of every data file of a table, relative to it, from the listing alone: no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(inside(spark, path, F.col("path")).alias("file"), F.col("length").alias("bytes"),
                         F.col("modificationTime").alias("modified"))


def read_folders(rows: DataFrame, path: str) -> list[str]:
    """Folders, relative to the table at ``path``, of the files that ``rows`` of it come from: one for each partition touched."""
    found = rows.select(folder_of(row_file(rows.sparkSession, path))).distinct().collect()
    return sorted(r[0] for r in found)
