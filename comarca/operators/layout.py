"""Words with places on a page to rows of cells.

Input words have (page keys..., ``x0`` double, ``top`` double, ``text``
string).  Pages are what is spread over the executors; a page's words pass its
task in order, a batch at a time, so a page of any size takes bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .aggregate import grouped_medians


def anchored_groups(values: Column, tolerance: float) -> Column:
    """Group number of each of sorted values: a new group starts when a value
    is over ``tolerance`` past the *first* value of the running group."""
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(-1).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, value: Column) -> Column:
        new = state["anchor"].isNull() | (value - state["anchor"] > tolerance)
        n = F.when(new, state["n"] + 1).otherwise(state["n"])
        anchor = F.when(new, value).otherwise(state["anchor"])
        return F.struct(anchor.alias("anchor"), n.alias("n"), F.array_append(state["out"], n).alias("out"))

    return F.aggregate(values, start, step, lambda s: s["out"])


def word_lines(words: DataFrame, page: Sequence[str], tolerance: float) -> DataFrame:
    """Words with their ``line`` number on the page, from the top; see :func:`anchored_groups` for where a line starts.

    Sorted words stream through a page's task; what goes from one batch to the
    next is the page, the first top of its running line, and the line's number.
    A word without a top is a line of its own, before the others.
    """
    plain = words.select(*page, F.col("x0"), F.col("top").cast("double").alias("_top"), "top", "text")
    ordered = plain.repartition(*page).sortWithinPartitions(*page, "_top", "x0", "text")
    schema = ordered.select(*page).schema.add("line", T.IntegerType())
    for c in ("x0", "top", "text"):
        schema = schema.add(ordered.schema[c])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchor, line = None, np.nan, -1
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            keys = list(zip(*(column(c).to_pylist() for c in page)))
            tops = np.array([np.nan if t is None else t for t in column("_top").to_pylist()], dtype=float)
            lines, i = np.empty(len(tops), dtype=np.int32), 0
            while i < len(tops):
                if keys[i] != now:
                    now, anchor, line = keys[i], np.nan, -1
                if np.isnan(anchor) or tops[i] - anchor > tolerance:
                    anchor, line = tops[i], line + 1
                end = i + 1
                while end < len(tops) and keys[end] == now and tops[end] - anchor <= tolerance:
                    end += 1
                lines[i:end] = line
                i = end
            yield pa.RecordBatch.from_arrays([*(column(c) for c in page), pa.array(lines), *(column(c) for c in ("x0", "top", "text"))], schema.names)

    return ordered.mapInArrow(run, schema)


def line_texts(lines: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page, line, top, n_words, text) of each line, words from left to right."""
    ordered = F.array_sort(F.collect_list(F.struct("x0", "text")))
    return lines.groupBy(*page, "line").agg(F.min("top").alias("top"), F.count(F.lit(1)).alias("n_words"), F.array_join(F.transform(ordered, lambda w: w["text"]), " ").alias("text"))


def from_entity(lines: DataFrame, page: Sequence[str], names: Sequence[str], header: str | None = None) -> DataFrame:
    """Lines from a page's first known entity (after the header line, if one is asked for).

    A page without the header gives nothing.
    """
    texts = line_texts(lines, page)
    known = F.lit(False)
    for name in names:
        known = known | F.upper("text").startswith(name.upper())
    per = Window.partitionBy(*page)
    head = F.min(F.when(F.upper("text").contains(header.upper()), F.col("line"))) if header else F.lit(-1)
    texts = texts.withColumn("_head", head.over(per) if header else head)
    texts = texts.withColumn("_first", F.min(F.when(known & (F.col("line") > F.col("_head")), F.col("line"))).over(per))
    wanted = texts.where(F.col("_head").isNotNull() & (F.col("line") >= F.col("_first"))).select(*page, "line")
    return lines.join(wanted, [*page, "line"], "left_semi")


def column_starts(lines: DataFrame, page: Sequence[str], width: int | None = None) -> DataFrame:
    """(page, starts array): median x0 of each word place over the lines of the commonest width.

    With fewer than two such lines all lines count.  Lines are counted by width
    and words by place, so no page's lines are gathered in one row.
    """
    placed = lines.withColumns({
        "_place": F.row_number().over(Window.partitionBy(*page, "line").orderBy("x0")),
        "_n": F.count(F.lit(1)).over(Window.partitionBy(*page, "line")),
    })
    spots = placed.groupBy(*page, "_n", "_place", "x0").agg(F.count(F.lit(1)).alias("_times"))
    # no filter on the spots, which would make them anew
    widths = spots.groupBy(*page, "_n").agg(F.sum(F.when(F.col("_place") == 1, F.col("_times"))).alias("_lines"))
    chosen = F.lit(width).cast("long") if width else -F.max(F.struct("_lines", (-F.col("_n")).alias("_less")))["_less"]
    exact = F.sum(F.when(F.col("_n") == width, F.col("_lines"))) if width else F.max("_lines")
    common = widths.groupBy(*page).agg(chosen.alias("_w"), (F.coalesce(exact, F.lit(0)) >= 2).alias("_exact"))
    used = spots.join(common, list(page)).where(((F.col("_n") == F.col("_w")) | ~F.col("_exact")) & (F.col("_place") <= F.col("_w")))
    medians = grouped_medians(used, [*page, "_place"], "x0", "_times", "_x")
    return medians.groupBy(*page).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_x"))), lambda s: s["_x"]).alias("starts"))


def gap_starts(words: DataFrame, page: Sequence[str], gap: float = 25.0) -> DataFrame:
    """(page, starts array): columns begin where a word is ``gap`` or more past all words left of it."""
    ordered = Window.partitionBy(*page).orderBy("left", "right").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("left") - (F.max("right").over(ordered) + 1) >= gap, F.lit(True))
    return words.withColumn("_b", begins).where("_b").groupBy(*page).agg(F.array_sort(F.collect_list(F.col("left").cast("double"))).alias("starts"))


def last_start(x: Column, starts: Column) -> Column:
    """Place of the last start at or left of x, 0 at least."""
    return F.greatest(F.size(F.filter(starts, lambda s: s <= x)) - 1, F.lit(0))


def cells_of_lines(lines: DataFrame, starts: DataFrame, page: Sequence[str], middle: bool = True) -> DataFrame:
    """(page, line, row_no, cells): words joined by column.

    By midpoints between starts, or by the last start to the left.  A line of
    more words than columns begins with an entity of several words: its first
    word is the first column's wherever it stands, and the words behind it
    extend the name up to the first that falls in another column.
    """
    from .joins import midpoint_band

    met = lines.join(starts, list(page))
    by_place = midpoint_band(F.col("x0"), F.col("starts")) if middle else last_start(F.col("x0"), F.col("starts"))
    on_line = Window.partitionBy(*page, "line")
    met = met.withColumns({"_n_words": F.count(F.lit(1)).over(on_line), "_place": F.row_number().over(on_line.orderBy("x0", "text"))})
    surplus = (F.col("_n_words") > F.size("starts")) & (F.col("_place") == 1)
    met = met.withColumn("_c", F.when(surplus, 0).otherwise(by_place)).drop("_n_words", "_place")
    cells = met.groupBy(*page, "line", "_c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), " ").alias("_t"), F.first(F.size("starts")).alias("_n"))
    rows = cells.groupBy(*page, "line").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_t"))).alias("_m"), F.first("_n").alias("_n"))
    full = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit("")))
    return rows.select(*page, "line", F.col("line").alias("row_no"), full.alias("cells"))


def filled_rows(rows: DataFrame) -> DataFrame:
    """Rows with a third of their cells filled, two at least."""
    filled = F.size(F.filter("cells", lambda c: c != ""))
    return rows.where(filled >= F.greatest(F.lit(2), F.floor(F.size("cells") / 3)))


def confident(words: DataFrame, least: float = 25.0) -> DataFrame:
    """Recognised words that are sure enough and not blank."""
    return words.where((F.col("conf") >= least) & (F.trim("text") != ""))


def words_between(words: DataFrame, left: float | None = None, right: float | None = None) -> DataFrame:
    """Words that start inside an x window, both ends included."""
    kept = words if left is None else words.where(F.col("x0") >= left)
    return kept if right is None else kept.where(F.col("x0") <= right)


def entity_lines(lines: DataFrame, page: Sequence[str], right_most: float, least_words: int, least_name: int) -> DataFrame:
    """(page, line, top, n_words, first) of the lines that begin at the left edge with a long enough name, and are wide enough."""
    first = F.min(F.struct("x0", "text"))
    per = lines.groupBy(*page, "line").agg(F.min("top").alias("top"), F.count(F.lit(1)).cast("int").alias("n_words"), first.alias("_f"))
    per = per.select(*page, "line", "top", "n_words", F.col("_f.text").alias("first"), F.col("_f.x0").alias("_x"))
    return per.where((F.col("_x") <= right_most) & (F.col("n_words") >= least_words) & (F.length("first") >= least_name)).drop("_x")


def section_bounds(lines: DataFrame, page: Sequence[str], header: str, below: float = 1.0) -> DataFrame:
    """(page, section, y_min, y_max): what lies under each line whose first word starts with ``header``.

    A section begins ``below`` under its header and ends above the next one of
    the page; the page's last ends with its last word.  Pages without the header have none.
    Words are dealt by page once, for their lines and for the sections.
    """
    firsts = lines.repartition(*page).groupBy(*page, "line").agg(F.min("top").alias("top"), F.min(F.struct("x0", "text")).alias("_f"), F.max("top").alias("_low"))
    per = Window.partitionBy(*page)
    heads = firsts.withColumn("_end", F.max("_low").over(per)).where(F.col("_f.text").startswith(header))
    order = per.orderBy("top", "line")
    nearest = F.lead("top").over(order)
    return heads.select(*page, F.row_number().over(order).alias("section"), (F.col("top") + below).alias("y_min"), F.coalesce(nearest - below, F.col("_end")).alias("y_max"))


def words_in_sections(words: DataFrame, bounds: DataFrame, page: Sequence[str], slack: float = 8.0) -> DataFrame:
    """Words with the ``section`` whose y window, ``slack`` longer at its foot, holds them; some in two.

    ``bounds`` are those of :func:`section_bounds`: on a page both ends rise
    with the section, so the sections that hold a word are a run, from the one
    after the last that has ended to the last that has begun.  Words and ends
    are dealt once, by page, whatever the height of a section.
    """
    there = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in page))
    whole = bounds.where(there & F.col("y_min").isNotNull() & F.col("y_max").isNotNull())
    no = F.lit(None).cast("int")
    # at the same height: a section begins, a word stands, a section ends
    begins = whole.select(*page, F.col("y_min").alias("_at"), F.lit(0).alias("_turn"), F.col("section").alias("_begun"), no.alias("_ended"))
    ends = whole.select(*page, (F.col("y_max") + slack).alias("_at"), F.lit(2).alias("_turn"), no.alias("_begun"), F.col("section").alias("_ended"))
    placed = words.where(there & F.col("top").isNotNull()).select(*words.columns, F.col("top").alias("_at"), F.lit(1).alias("_turn"), no.alias("_begun"), no.alias("_ended"))
    marks = placed.unionByName(begins, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    so_far = Window.partitionBy(*page).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = marks.select("*", F.max("_begun").over(so_far).alias("_last"), (F.coalesce(F.max("_ended").over(so_far), F.min("_begun").over(so_far) - 1) + 1).alias("_first"))
    held = run.where((F.col("_turn") == 1) & (F.col("_first") <= F.col("_last")))
    return held.select(*words.columns, F.explode(F.sequence("_first", "_last")).alias("section"))
