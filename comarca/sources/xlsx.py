"""Spreadsheets as rows of cells: a Python data source over zip and XML.

``spark.read.format("xlsx_rows").option("sheet", name).load(folder_or_file)``
gives (path, sheet, row_no, cells array<string>).  A file is one partition;
files that only Spark can open go through :func:`read_rows`, which takes their
bytes from ``binaryFile``.
"""

from __future__ import annotations

import array
import functools
import glob
import io
import itertools
import os
import re
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Rows of a batch, and shared strings a task holds.
_BATCH, _HELD = 2048, 8192
SCHEMA = "path string, sheet string, row_no int, cells array<string>"


def workbook_in(data: bytes) -> bytes:
    """A workbook, or the first one inside a zip of files."""
    with zipfile.ZipFile(io.BytesIO(data)) as outer:
        names = outer.namelist()
        if "xl/workbook.xml" in names:
            return data
        inner = next((n for n in names if n.lower().endswith((".xlsx", ".xls"))), None)
        if inner is None:
            raise ValueError("no workbook in the archive")
        return outer.read(inner)


def column_number(reference: str) -> int:
    """0 for A1, 26 for AA1."""
    n = 0
    for letter in re.match(r"[A-Z]*", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


class _Shared:
    """The shared strings of a workbook, in a scratch file private to the task, found by their offsets."""

    def __init__(self, book: zipfile.ZipFile):
        self.file, self.starts = tempfile.TemporaryFile(), array.array("q", [0])
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as xml:
                for node in _ended(xml, f"{_MAIN}si"):
                    self.file.write(_text(node).encode())
                    self.starts.append(self.file.tell())

    def __getitem__(self, i: int) -> str:
        self.file.seek(self.starts[i])
        return self.file.read(self.starts[i + 1] - self.starts[i]).decode()


def _ended(xml, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a tag as they end; what is behind them is dropped from the tree."""
    above: list = []
    for event, node in ElementTree.iterparse(xml, ("start", "end")):
        if event == "start":
            above.append(node)
            continue
        above.pop()
        if node.tag == tag:
            yield node
            if above:
                above[-1].clear()


def sheet_rows(data: bytes, sheet: str | int | Sequence[str] | None = None, first_row: int = 1) -> Iterator[tuple[str, int, list]]:
    """(sheet, row number, cells) of a sheet by name (of several, the first that is there) or place; None: the active one.

    Rows are read one by one: beside the packed file a task holds one row, eight
    bytes for each shared string, and the last thousands of these.
    """
    with zipfile.ZipFile(io.BytesIO(workbook_in(data))) as book:
        root = ElementTree.fromstring(book.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), links[s.get(_LINK)]) for s in root.iter(f"{_MAIN}sheet")]
        if sheet is None:
            view = next(root.iter(f"{_MAIN}workbookView"), None)
            sheet = int(view.get("activeTab", 0)) if view is not None else 0
        names = [sheet] if isinstance(sheet, str) else sheet
        picked = sheets[sheet] if isinstance(sheet, int) else next((s for n in names for s in sheets if s[0] == n), None)
        if picked is None:
            raise ValueError(f"no sheet named {sheet!r}")
        shared = functools.lru_cache(maxsize=_HELD)(_Shared(book).__getitem__)
        target = picked[1].lstrip("/")
        with book.open(target if target.startswith("xl/") else f"xl/{target}") as file:
            number = 0
            for node in _ended(file, f"{_MAIN}row"):
                number = int(node.get("r", number + 1))
                if number < first_row:
                    continue
                cells: list = []
                for cell in node.iter(f"{_MAIN}c"):
                    at = column_number(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = cell.get("t", "n"), cell.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells[at] = _text(cell)
                    elif value is not None and value.text is not None:
                        cells[at] = shared(int(value.text)) if kind == "s" else value.text
                yield picked[0], number, cells


def _option(value: str | None) -> str | int | None:
    return int(value) if value is not None and value.isdigit() else value


class XlsxReader(DataSourceReader):
    """A partition for each workbook; files of the driver's and the executors' shared paths only."""

    def __init__(self, options):
        self.path, self.sheet, self.first = options["path"].removeprefix("file:"), _option(options.get("sheet")), int(options.get("firstRow", 1))

    def partitions(self):
        found = sorted(glob.glob(os.path.join(self.path, "*"))) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [InputPartition(f) for f in found if f.lower().endswith((".xlsx", ".zip"))]

    def read(self, partition):
        with open(partition.value, "rb") as file:
            data = file.read()
        for sheet, number, cells in sheet_rows(data, self.sheet, self.first):
            yield partition.value, sheet, number, cells


class XlsxSource(DataSource):
    @classmethod
    def name(cls):
        return "xlsx_rows"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return XlsxReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)


def read_rows(spark: SparkSession, path, sheet: str | int | Sequence[str] | None = None, first_row: int = 1) -> DataFrame:
    """Rows of every workbook, or zipped workbook, under any path Spark can read.

    A workbook is a task's; its rows leave it in batches of ``_BATCH``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()))
        for batch in batches:
            for i in range(batch.num_rows):
                name, rows = batch.column(0)[i].as_py(), sheet_rows(batch.column(1)[i].as_py(), sheet, first_row)
                while part := [(name, *row) for row in itertools.islice(rows, _BATCH)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], ["path", "sheet", "row_no", "cells"])

    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def fixed_width(rows: DataFrame, names: list[str], key_cell: int = 1) -> DataFrame:
    """Cells as named columns, padded or cut; rows without the key cell go."""
    return rows.where(F.get("cells", F.lit(key_cell)).isNotNull()).select(*(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)))
