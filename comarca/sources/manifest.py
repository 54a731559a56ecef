"""What has been read: a stored manifest of files, and one pointer to the current tables.

Both are folders of Parquet that only ever grow: a run adds a folder, and the
folder counts once its success mark is there.  A reader sees the last complete
pointer, so a run that dies, or a source that fails, leaves the tables as they
were.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import list_files

_FILES = "source string, path string, length long, modified timestamp, snapshot string, layout string, run int"


@dataclass(frozen=True)
class Built:
    """A table's current version, and of what it was made."""

    version: int
    made_of: str


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete runs under a folder."""
    done = list_files(spark, f"{folder}/run=*/_SUCCESS")
    return sorted(int(p.rsplit("run=", 1)[1].split("/")[0]) for p, _ in done)


def next_run(spark: SparkSession, store: str) -> int:
    """One past every number that a run, complete or not, has used."""
    used = list_files(spark, f"{store}/*/run=*") + list_files(spark, f"{store}/*/*/run=*")
    return max((int(p.rsplit("run=", 1)[1].split("/")[0]) for p, _ in used), default=0) + 1


def listed(spark: SparkSession, pattern: str, stamp: str = r"(\d{4}_\d{2})") -> DataFrame | None:
    """(path, length, modified, snapshot) of the files of a pattern; contents are not read. None without files."""
    if not list_files(spark, pattern):
        return None
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    found = found.where(~F.col("path").rlike(r"/[_.][^/]*$"))
    return found.select("path", "length", F.col("modificationTime").alias("modified"), F.nullif(F.regexp_extract("path", stamp + r"[^/]*$", 1), F.lit("")).alias("snapshot"))


def known(spark: SparkSession, store: str) -> DataFrame:
    """Every file that a complete run has read; the last reading of each (source, path)."""
    runs = _runs(spark, f"{store}/manifest")
    if not runs:
        return spark.createDataFrame([], _FILES)
    every = spark.read.schema(_FILES.removesuffix(", run int")).parquet(*(f"{store}/manifest/run={n}" for n in runs)).withColumn("run", F.regexp_extract("_metadata.file_path", r"/run=(\d+)/", 1).cast("int"))
    last = every.groupBy("source", "path").agg(F.max_by(F.struct("length", "modified", "snapshot", "layout", "run"), "run").alias("l"))
    return last.select("source", "path", "l.*")


def unread(found: DataFrame, manifest: DataFrame, source: str) -> DataFrame:
    """Files of a listing that no run has read in this length and state."""
    seen = manifest.where(F.col("source") == source).select("path", "length", "modified")
    return found.join(seen, ["path", "length", "modified"], "left_anti")


def record(files: DataFrame, source: str, layout: str, store: str, run: int) -> None:
    """Add files to the manifest of a run; call when their rows are stored."""
    out = files.select(F.lit(source).alias("source"), "path", "length", "modified", "snapshot", F.lit(layout).alias("layout"))
    out.coalesce(1).write.mode("append").parquet(f"{store}/manifest/run={run}")


def pointer(spark: SparkSession, store: str) -> dict[str, Built]:
    """Current version of each table, by the last complete pointer."""
    runs = _runs(spark, f"{store}/pointer")
    if not runs:
        return {}
    return {r.table: Built(r.version, r.made_of) for r in spark.read.parquet(f"{store}/pointer/run={runs[-1]}").collect()}


def switch(spark: SparkSession, store: str, run: int, tables: Mapping[str, Built]) -> None:
    """Make these the current tables, all at once."""
    rows = [(t, b.version, b.made_of) for t, b in sorted(tables.items())]
    spark.createDataFrame(rows, "table string, version int, made_of string").coalesce(1).write.mode("overwrite").parquet(f"{store}/pointer/run={run}")


def current(spark: SparkSession, store: str, table: str) -> DataFrame | None:
    """A table in its current version; None where it was never built."""
    built = pointer(spark, store).get(table)
    return None if built is None else spark.read.parquet(f"{store}/gold/{table}/run={built.version}")
