"""Delimited text with broken rows and unknown dialects, all columns strings."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from comarca.functions.text import by_spelling, unique_names


@dataclass(frozen=True)
class Dialect:
    sep: str
    encoding: str


#: Tried in this order by :func:`read_probed`.
DIALECTS = (Dialect(";", "ISO-8859-1"), Dialect(",", "ISO-8859-1"), Dialect("|", "UTF-8"))


def read_strings(spark: SparkSession, path, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, no inference; what does not parse becomes null."""
    return spark.read.csv(path, header=True, inferSchema=False, sep=sep, encoding=encoding, mode="PERMISSIVE")


_FIRST = "_first"


def lines_by_file(spark: SparkSession, path) -> DataFrame:
    """(path, line binary, _first boolean) of every non-empty line of every file, in one scan.

    Lines are bytes, whatever their encoding (of those that keep ASCII as it is); ``_first`` marks a file's first.
    """
    where = F.col("_metadata.file_path").alias("path")
    lines = spark.read.text(path).select(where, F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a split's lines come in order, and a task's splits one after the other
        last = None
        for batch in batches:
            names, starts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            first = []
            for name, start in zip(names, starts):
                first.append(start == 0 and name != last)
                last = name
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(first, pa.bool_())], ["path", "line", _FIRST])

    return lines.mapInArrow(run, f"path string, line binary, {_FIRST} boolean").where(f"octet_length(line) > 0 OR {_FIRST}")


def _sniffed(line: bytes, dialects: tuple[Dialect, ...], least: int) -> tuple[Dialect, list[str]] | None:
    """The first dialect that gives a header of ``least`` names, and the names."""
    for dialect in dialects:
        try:
            text = line.removeprefix(b"\xef\xbb\xbf").decode(dialect.encoding)
        except UnicodeDecodeError:
            continue
        names = next(csv.reader([text], delimiter=dialect.sep), [])
        if len(names) >= least:
            return dialect, unique_names([n.strip().strip("\ufeff") for n in names], fold=True)
    return None


def headers(lines: DataFrame, dialects: tuple[Dialect, ...] = DIALECTS, least: int = 6) -> DataFrame:
    """(path, sep, encoding, names array) of every file, found in tasks from its first line; nulls where no dialect fits."""
    schema = "path string, sep string, encoding string, names array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sniffed(line, dialects, least) for line in batch.column(1).to_pylist()]
            cols = [[f and f[0].sep for f in found], [f and f[0].encoding for f in found], [f and f[1] for f in found]]
            kinds = (pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["path", "sep", "encoding", "names"])

    return lines.where(_FIRST).select("path", "line").mapInArrow(run, schema)


def read_mixed(spark: SparkSession, path, dialects: tuple[Dialect, ...] = DIALECTS, least: int = 6, found: DataFrame | None = None) -> DataFrame:
    """Files of different dialects and headers as one table of strings with ``path``.

    Each file is read by its own dialect and header, all in one scan; quotes
    are honoured inside a line.  A column that a file lacks is null, and so are
    fields beyond its header.  A file that no dialect fits is an error that
    names it.  ``found`` is :func:`headers` of the files, where it is stored.
    """
    lines = lines_by_file(spark, path)
    found = headers(lines, dialects, least) if found is None else found
    shapes = found.groupBy("sep", "encoding", "names").agg(F.min("path").alias("path")).collect()  # as many as there are layouts
    if unread := [r.path for r in shapes if r.names is None]:
        raise ValueError(f"no dialect gives {least} columns: {unread}")
    columns = list(dict.fromkeys(n for r in sorted(shapes, key=lambda r: r.path) for n in r.names))
    width = max((len(r.names) for r in shapes), default=0)
    fields = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    cells = F.lit(None).cast(T.ArrayType(T.StringType()))
    for sep, encoding in {(r.sep, r.encoding) for r in shapes}:
        text = F.decode("line", encoding)
        parsed = F.from_csv(text, fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"sep": sep, "mode": "PERMISSIVE"})
        row = F.array(*(parsed[f"f{i}"] for i in range(width)))
        cells = F.when((F.col("sep") == sep) & (F.col("encoding") == encoding), row).otherwise(cells)
    rows = lines.where(f"NOT {_FIRST}").join(found, "path").select("path", "names", cells.alias("cells"))
    # a name's place in the file's own header
    cell = lambda c: F.get("cells", (F.array_position("names", F.lit(c)) - 1).cast("int"))
    return rows.select("path", *(F.coalesce(*map(cell, cs)).alias(c) for c, cs in by_spelling([c for c in columns if c != "path"]).items()))


def first_line(spark: SparkSession, path, encoding: str) -> str:
    """Header line of the first file by name, without a byte-order mark."""
    row = lines_by_file(spark, path).where(_FIRST).select("path", F.decode("line", encoding).alias("line")).orderBy("path").first()
    return (row.line if row else "").lstrip("\ufeff").removeprefix("ï»¿")


def read_probed(spark: SparkSession, path, dialects: tuple[Dialect, ...] = DIALECTS, least: int = 6) -> DataFrame:
    """Files by their own dialects, without their paths; see :func:`read_mixed`."""
    return read_mixed(spark, path, dialects, least).drop("path")


def fitted(line: Column, sep: str, width: int) -> list[Column]:
    """Fields of a line as exactly ``width`` columns.

    What is too much joins the last field, separators kept; what is missing is ''.
    """
    fields = F.split(line, "\\Q" + sep + "\\E", -1)
    last = F.array_join(F.slice(fields, width, F.greatest(F.size(fields) - width + 1, F.lit(0))), sep)
    return [*(F.coalesce(F.get(fields, i), F.lit("")) for i in range(width - 1)), last]


def fit_lines(lines: DataFrame, header: str, sep: str | None = None, line_col: str = "value") -> DataFrame:
    """Columns of ``header`` from lines of text; the separator is the more frequent of | and ;."""
    sep = sep or ("|" if header.count("|") >= header.count(";") else ";")
    names = unique_names([n.strip() for n in header.split(sep)])
    return lines.select(*(c.alias(n) for n, c in zip(names, fitted(F.col(line_col), sep, len(names)))))


def read_tolerant(spark: SparkSession, path, sep: str | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """Rows of delimited files of one header, none lost: long rows glued, short rows padded."""
    header = first_line(spark, path, encoding)
    lines = lines_by_file(spark, path).where(f"NOT {_FIRST}").select(F.decode("line", encoding).alias("value"))
    return fit_lines(lines, header, sep)


def read_tolerant_files(spark: SparkSession, path, encoding: str = "ISO-8859-1") -> DataFrame:
    """Rows of delimited files of any headers with ``path``, none lost, all in one scan.

    Each file by its own header: the separator is the more frequent of | and ;
    in it; what is too much in a line joins the last field, what is missing is ''.
    """
    lines = lines_by_file(spark, path).withColumn("line", F.decode("line", encoding))
    head = F.regexp_replace("line", "^(\ufeff|ï»¿)", "")
    count = lambda c: F.length("h") - F.length(F.replace("h", F.lit(c)))
    heads = lines.where(_FIRST).select("path", head.alias("h")).withColumn("sep", F.when(count("|") >= count(";"), "|").otherwise(";"))
    names = F.transform(F.split("h", F.concat(F.lit("\\Q"), F.col("sep"), F.lit("\\E")), -1), F.trim)
    heads = heads.select("path", "sep", _numbered(names).alias("names"))
    columns = [r.n for r in heads.select(F.explode("names").alias("n")).distinct().orderBy("n").collect()]  # spellings of headers
    fields, width = F.split("line", F.concat(F.lit("\\Q"), F.col("sep"), F.lit("\\E")), -1), F.size("names")
    last = F.call_function("array_join", F.slice(fields, width, F.greatest(F.size(fields) - width + 1, F.lit(0))), F.col("sep"))
    glued = F.when(F.size(fields) > width, F.concat(F.slice(fields, F.lit(1), width - 1), F.array(last))).otherwise(fields)
    rows = lines.where(f"NOT {_FIRST}").join(heads, "path").select("path", "names", glued.alias("cells"))

    def cell(name: str) -> Column:
        place = F.array_position("names", F.lit(name)).cast("int")
        return F.when(place > 0, F.coalesce(F.get("cells", place - 1), F.lit("")))

    return rows.select("path", *(F.coalesce(*map(cell, cs)).alias(c) for c, cs in by_spelling([c for c in columns if c != "path"]).items()))


def _numbered(names: Column) -> Column:
    """Later repeats of a name get .1, .2 and so on."""
    def one(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, 1, i), lambda x: F.lower(x) == F.lower(name)))
        return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

    return F.transform(names, one)
