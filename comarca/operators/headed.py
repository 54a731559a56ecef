"""Headers of many tables at once: each table's own header row, its names, its rows by name.

Input rows have (table keys..., ``row_no`` int, ``cells`` array<string>).
Tables of different headers are one DataFrame: a column that a table lacks is
null there.  A header row is a row of a few cells, named in tasks; rows are
matched with their table's names by a join on the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from comarca.functions.text import ascii_name, by_spelling, unique_names

#: (header cells, cells of the row below) -> (names, how many rows the header takes).
Naming = Callable[[Sequence[str | None], Sequence[str | None]], tuple[list[str], int]]


def plain_names(upper: Sequence[str | None], lower: Sequence[str | None]) -> tuple[list[str], int]:
    """Trimmed cells; ``col_<place>`` for empty ones; repeats numbered ``.n``."""
    return unique_names([(c or "").strip() or f"col_{i}" for i, c in enumerate(upper)], fold=True), 1


def ascii_names(upper: Sequence[str | None], lower: Sequence[str | None]) -> tuple[list[str], int]:
    """Canonical ASCII names; ``col_<place>`` for empty cells; repeats numbered ``_n``."""
    return unique_names([f"col_{i}" if c is None else ascii_name(c) for i, c in enumerate(upper)], "_", fold=True), 1


def filled(least: int, longer_than: int = 0) -> Column:
    """Rows with ``least`` cells of more than ``longer_than`` characters."""
    return F.size(F.filter("cells", lambda c: F.length(F.trim(c)) > longer_than)) >= least


def holds_any(names: Sequence[str]) -> Column:
    """Rows in which a cell is one of the names, in any case."""
    return F.arrays_overlap(F.transform("cells", lambda c: F.upper(F.trim(c))), F.array(*(F.lit(n.upper()) for n in names)))


def _padded(cells: Sequence[str | None] | None, width: int) -> list[str | None]:
    return [*(cells or []), *[None] * (width - len(cells or []))]


def headers(rows: DataFrame, keys: Sequence[str], test: Column, naming: Naming = plain_names, within: int | None = None, needed: bool = False) -> DataFrame:
    """(keys, names array, body int): each table's names and its first row behind the header.

    The header is the first row (of the first ``within``) that passes; the
    first row of a table without one, or no row of that table if ``needed``.
    """
    early = test if within is None else test & (F.col("row_no") <= within)
    heads = rows.groupBy(*keys).agg(F.min(F.when(early, F.col("row_no"))).alias("_head"), F.min("row_no").alias("_least"), F.max(F.size("cells")).alias("_width"))
    heads = heads.where("_head IS NOT NULL") if needed else heads
    heads = heads.select(*keys, F.coalesce("_head", "_least").alias("_head"), "_width")
    near = rows.join(heads, list(keys)).where((F.col("row_no") - F.col("_head")).isin(0, 1))
    row = lambda i: F.first(F.when(F.col("row_no") == F.col("_head") + i, F.col("cells")), ignorenulls=True)
    pairs = near.groupBy(*keys).agg(row(0).alias("_upper"), row(1).alias("_lower"), F.first("_head").alias("_head"), F.first("_width").alias("_width"))
    schema = pairs.select(*keys).schema.add("names", T.ArrayType(T.StringType())).add("body", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upper, lower, head, width = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_upper", "_lower", "_head", "_width"))
            # as wide as the table's widest row, so a column without a heading has a place
            named = [naming(_padded(u, n), _padded(w, n)) for u, w, n in zip(upper, lower, width)]
            body = [h + n for h, (_, n) in zip(head, named)]
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([n for n, _ in named], pa.list_(pa.string())), pa.array(body, pa.int32())], schema.names)

    return pairs.mapInArrow(run, schema)


def by_name(rows: DataFrame, heads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows behind their header with a column for every name of any table.

    Names that differ in case only are one column.  Names are collected: they are as many as the spellings of headers, not as the data.
    """
    names = [r.n for r in heads.select(F.explode("names").alias("n")).distinct().orderBy("n").collect()]
    spelled = by_spelling([n for n in names if n not in keys])
    cell = lambda n: F.get("cells", (F.array_position("names", F.lit(n)) - 1).cast("int"))
    met = rows.join(heads, list(keys)).where(F.col("row_no") >= F.col("body"))
    return met.select(*keys, "row_no", *(F.coalesce(*(cell(s) for s in ss)).alias(n) for n, ss in spelled.items()))
