"""Raw rows of cells to tables: headers, positions, gates.

Input rows have (table keys..., ``row_no`` int, ``cells`` array<string>).
Spark has no row order, so ``row_no`` carries the source's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.functions.text import unique_names


def _least_row(rows: DataFrame, test: Column) -> int | None:
    return rows.where(test).agg(F.min("row_no")).first()[0]


def header_by_names(rows: DataFrame, names: Sequence[str], within: int | None = 25) -> int | None:
    """First row (of the first ``within``) with one of the names as a cell."""
    test = F.arrays_overlap(F.transform("cells", lambda c: F.upper(F.trim(c))), F.array(*(F.lit(n.upper()) for n in names)))
    return _least_row(rows if within is None else rows.where(F.col("row_no") <= within), test)


def header_by_fill(rows: DataFrame, least: int = 3, within: int | None = 10, long_text: bool = False) -> int:
    """First row with ``least`` filled cells (or texts of two letters and more); the first row else."""
    filled = F.filter("cells", lambda c: (F.length(c) > 1) if long_text else c.isNotNull())
    found = _least_row(rows if within is None else rows.where(F.col("row_no") <= within), F.size(filled) >= least)
    return found if found is not None else rows.agg(F.min("row_no")).first()[0]


def fused_header(upper: Sequence[str | None], lower: Sequence[str | None]) -> list[str]:
    """The lower header cell if it has text, else the upper one."""
    width = max(len(upper), len(lower))
    pad = lambda h: [*h, *[None] * (width - len(h))]
    return [(low or "").strip() or (up or "").strip() for up, low in zip(pad(upper), pad(lower))]


def cells_of(rows: DataFrame, row_no: int) -> list[str | None]:
    found = rows.where(F.col("row_no") == row_no).select("cells").first()
    return list(found.cells) if found else []


def with_names(rows: DataFrame, names: Sequence[str], mark: str = ".") -> DataFrame:
    """Cells as columns by position; repeats of a name are numbered."""
    kept = [c for c in rows.columns if c != "cells"]
    return rows.select(*kept, *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(unique_names(list(names), mark))))


def positional(rows: DataFrame, names: Sequence[str], width: int) -> DataFrame:
    """The first columns by position, as many as both the names and the table have."""
    kept = [c for c in rows.columns if c != "cells"]
    return rows.select(*kept, *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names[:width])))


def from_first(rows: DataFrame, keys: Sequence[str], test: Column) -> DataFrame:
    """Rows of each table from the first that passes on; all of them if none does."""
    start = F.min(F.when(test, F.col("row_no"))).over(Window.partitionBy(*keys))
    return rows.withColumn("_start", start).where(F.col("row_no") >= F.coalesce("_start", F.col("row_no"))).drop("_start")


def header_matches(cells: Column, prefixes: Sequence[str]) -> Column:
    """Every cell starts with the prefix at its place, in any case."""
    test = F.lit(True)
    for i, prefix in enumerate(prefixes):
        test = test & F.coalesce(F.lower(F.trim(F.get(cells, F.lit(i)))).startswith(prefix.lower()), F.lit(False))
    return test


def first_table(rows: DataFrame, table: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows of the first table whose first row matches the prefixes."""
    heads = rows.where((F.col("row_no") == 0) & header_matches(F.col("cells"), prefixes)).agg(F.min(table).alias("_t"))
    return rows.join(F.broadcast(heads), F.col(table) == F.col("_t")).drop("_t")


def picked_tables(rows: DataFrame, table: str, wanted: Sequence[int]) -> DataFrame:
    """Tables by number; numbers that are not there give nothing, the others keep theirs."""
    return rows.where(F.col(table).isin(list(wanted)))


def cleaned_table(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Line breaks to blanks, a blank first header row dropped, an empty first column dropped."""
    tidy = rows.withColumn("cells", F.transform("cells", lambda c: F.trim(F.replace(c, F.lit("\n"), F.lit(" ")))))
    blank = F.forall("cells", lambda c: F.coalesce(c, F.lit("")) == "")
    per = Window.partitionBy(*keys)
    tidy = tidy.withColumns({"_skip": (F.col("row_no") == 0) & blank, "_lead": F.max(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))).over(per)})
    tidy = tidy.where(~F.col("_skip"))
    cut = F.when(F.col("_lead") == "", F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0)))).otherwise(F.col("cells"))
    return tidy.withColumn("cells", cut).drop("_skip", "_lead")


def shape_report(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and greatest width of each extracted table, largest first."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size("cells")).alias("n_cols")).orderBy(F.desc(F.col("n_rows") * F.col("n_cols")), *keys)


def pages_to_try(page: int, n_pages: int, reach: int = 3) -> list[int]:
    """The page, then one before, one after, and so on outward, inside the document."""
    order = [page, *(p for d in range(1, reach + 1) for p in (page - d, page + d))]
    return [p for p in order if 0 <= p < n_pages]
