"""Extractors tried in order, each on what the earlier ones left open; the best of several pages.

A unit (a document and an event, say) is open until an extractor gives it a
table that passes that extractor's gate.  Everything is one plan: the next
extractor sees the open units by an anti-join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import header_matches

#: Open units -> (unit keys..., table, row_no, cells) of what the extractor finds in them.
Extractor = Callable[[DataFrame], DataFrame]


def table_grades(rows: DataFrame, keys: Sequence[str], prefixes: Sequence[str] = ()) -> DataFrame:
    """(keys, n_rows, n_cols, filled, headed) of each table.

    ``filled`` is the share of cells with text; ``headed`` whether the first row starts as ``prefixes`` say.
    """
    some = F.size(F.filter("cells", lambda c: F.coalesce(c, F.lit("")) != ""))
    first = F.min_by(header_matches(F.col("cells"), prefixes), F.col("row_no"))
    per = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size("cells")).alias("n_cols"), F.sum(some).alias("_some"), F.sum(F.size("cells")).alias("_all"), first.alias("headed"))
    return per.select(*keys, "n_rows", "n_cols", F.coalesce(F.try_divide(F.col("_some").cast("double"), F.col("_all").cast("double")), F.lit(0.0)).alias("filled"), "headed")


def gated(rows: DataFrame, unit: Sequence[str], least_rows: int, prefixes: Sequence[str] = (), authoritative: bool = False) -> DataFrame:
    """Rows of tables with ``least_rows`` rows; of an ``authoritative`` header match, those that match only."""
    keys = [*unit, "table"]
    test = F.col("n_rows") >= least_rows
    kept = table_grades(rows, keys, prefixes).where(test & F.col("headed") if authoritative else test)
    return rows.join(kept.select(*keys), keys, "left_semi")


def chain(units: DataFrame, extractors: Sequence[tuple[str, Extractor]], unit: Sequence[str], store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Rows of the first extractor that has any for a unit, with its name as ``extractor``.

    ``extractors`` give rows that have passed their gates.  ``store`` (frame, name)
    writes an extractor's rows and reads them back, where it is too dear to run twice.
    """
    parts, open_ = [], units.select(*unit).distinct()
    for name, extract in extractors:
        found = extract(open_)
        found = found.withColumn("extractor", F.lit(name)) if store is None else store(found, name).withColumn("extractor", F.lit(name))
        parts.append(found)
        open_ = open_.join(found.select(*unit).distinct(), list(unit), "left_anti")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def best_page(grades: DataFrame, doc: Sequence[str], page: str, wanted: Column) -> DataFrame:
    """One row of ``grades`` for each document: a headed table first, then the most
    cells with text, then the page nearest to ``wanted``, then the first page and table."""
    order = [F.desc("headed"), F.desc(F.round(F.col("n_rows") * F.col("n_cols") * F.col("filled"))), F.abs(F.col(page) - wanted), F.col(page), F.col("table")]
    return grades.withColumn("_r", F.row_number().over(Window.partitionBy(*doc).orderBy(*order))).where("_r = 1").drop("_r")
