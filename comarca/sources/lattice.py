"""Parquet sets whose columns and types drift: one schema for all, one scan a layout.

Footers are read in tasks, one job whatever the number of files.  Types merge
as a semilattice: a missing column adds nothing, whole numbers widen
(tinyint < smallint < int < bigint), numbers of any kind meet in double, dates
meet timestamps in timestamp, and whatever has no narrower meeting point is
text.  The order of the files does not matter.  A bigint beyond 2**53 loses its
last digits where another file has the column as double.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema

#: Stores whose files a task can open in part; others come whole through Spark's reader.
_RANGED = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs"}
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_REAL = [T.FloatType(), T.DoubleType()]


def joined(a: T.DataType, b: T.DataType) -> T.DataType:
    """Narrowest type of the lattice that both fit."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if all(t in _WHOLE or t in _REAL or isinstance(t, T.DecimalType) for t in (a, b)):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in (a, b)):
        return T.TimestampType()
    return T.StringType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """Every column of any schema, with the type they all fit; columns in order of first appearance."""
    kinds: dict[str, T.DataType] = {}
    for field in (f for s in schemas for f in s.fields):
        kinds[field.name] = joined(kinds.get(field.name, T.NullType()), field.dataType)
    return T.StructType([T.StructField(n, T.StringType() if isinstance(k, T.NullType) else k) for n, k in kinds.items()])


def _layout(source) -> str:
    return from_arrow_schema(pq.read_schema(source)).json()


def _opened(paths: list[str]) -> Iterator[tuple[str, str]]:
    for path in paths:
        scheme, rest = path.split(":", 1) if ":" in path else ("file", path)
        rest = rest if rest.startswith("//") else f"//{rest}"
        store, name = pa.fs.FileSystem.from_uri(f"{_RANGED[scheme]}:{rest}")
        with store.open_input_file(name) as file:
            yield path, _layout(file)


def layouts(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The schema, as JSON, of the files that have it; files in order.

    ``paths`` are files or folders of files; folder names hold no columns.
    """
    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_opened(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)] or [pa.array([], pa.string())] * 2, ["path", "layout"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_layout(io.BytesIO(data)) for data in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "layout"])

    schema, near, far = "path string, layout string", [], []
    # the listing is Spark's, in parallel for many folders; contents are not read
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(paths).select("path")
    for p in sorted(r.path for r in listed.collect()):
        (near if (p.split(":", 1)[0] if ":" in p else "file") in _RANGED else far).append(p)
    rows = []
    if near:
        parts = min(len(near), 4 * spark.sparkContext.defaultParallelism)
        rows += spark.createDataFrame([(p,) for p in near], "path string").repartition(parts).mapInArrow(ranged, schema).collect()
    if far:
        rows += spark.read.format("binaryFile").load(far).select("path", "content").mapInArrow(whole, schema).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: r.path):
        out.setdefault(r.layout, []).append(r.path)
    return out


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; missing ones null."""
    there = {f.name for f in df.schema.fields}
    return df.select(*((F.col(f"`{f.name}`") if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def union_widened(frames: list[DataFrame]) -> DataFrame:
    """Union over all columns, each in the type that all frames fit."""
    schema = merged([f.schema for f in frames])
    return reduce(DataFrame.unionByName, (aligned(f, schema) for f in frames))


def read_drifting(spark: SparkSession, paths: list[str], path_col: str | None = None) -> DataFrame | None:
    """Parquet files of any layouts as one table, with each row's file in ``path_col``; None without files."""
    if not paths:
        return None
    groups = [(T.StructType.fromJson(json.loads(layout)), files) for layout, files in layouts(spark, paths).items()]
    if not groups:
        return None
    frames = [spark.read.schema(schema).parquet(*files) for schema, files in groups]
    if path_col:
        frames = [f.withColumn(path_col, F.col("_metadata.file_path")) for f in frames]
    return union_widened(frames)
