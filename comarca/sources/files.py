"""Parquet sets that drift, snapshots, latest files and existence."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .lattice import read_drifting


def register_table(spark: SparkSession, name: str, path) -> DataFrame:
    """One Parquet path as a temporary view."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what matches, by path; through the file system Spark uses."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in found)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder through the file system Spark uses."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def latest_file(spark: SparkSession, pattern: str, by: str = "name") -> str | None:
    """Last file by name, or newest by time (of equal times the last name); None if none."""
    found = list_files(spark, pattern)
    return max(found, key=lambda f: (f[1], f[0]) if by == "time" else (f[0],))[0] if found else None


def read_first_schema(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All files by the first one's columns: others add nothing, what they lack is null."""
    found = [f for f, _ in list_files(spark, pattern)]
    if not found:
        return None
    return spark.read.schema(schema or spark.read.parquet(found[0]).schema).parquet(*found)


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def union_by_name(frames: list[DataFrame], strings: bool = True) -> DataFrame:
    """Union over all columns, missing ones null.

    With ``strings`` every column is text first, so that types which differ
    between files widen instead of failing at run time.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(as_strings, frames) if strings else frames)


def read_union_by_name(spark: SparkSession, pattern: str) -> DataFrame | None:
    """Files of different columns and types as one table, each column in the type that all fit.

    Footers are read in one job, files scanned once for each layout.
    """
    return read_drifting(spark, [f for f, _ in list_files(spark, pattern)])


def with_snapshot(df: DataFrame, pattern: str = r"(\d{4}_\d{2})") -> DataFrame:
    """Add ``snapshot``, the stamp in the file's name."""
    return df.withColumn("snapshot", F.nullif(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1), F.lit("")))


def latest_snapshot(df: DataFrame, column: str = "snapshot") -> DataFrame:
    """Rows of the last snapshot only."""
    last = df.agg(F.max(column).alias("_last"))
    return df.join(F.broadcast(last), F.col(column).eqNullSafe(F.col("_last"))).drop("_last")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def tables(spark: SparkSession, views: bool = True) -> list[str]:
    """Names in the catalog, with or without temporary views."""
    return sorted(t.name for t in spark.catalog.listTables() if views or t.tableType != "TEMPORARY")


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """A table if it is there, so a missing source leaves nulls and no error."""
    try:
        return spark.table(name) if exists(spark, name) else None
    except AnalysisException:
        return None


def first_result(attempts) -> DataFrame | None:
    """The first of several readers that gives rows; later ones do not run."""
    for attempt in attempts:
        df = attempt()
        if df is not None and not df.isEmpty():
            return df
    return None


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """A column by name, or a null of that type where it is absent."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)
