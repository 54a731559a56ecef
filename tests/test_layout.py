"""Lines of words in order, sections, surplus words, extractors in turn, the report's catalogue."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from comarca.functions import numbers
from comarca.operators import aggregate, fallback, joins, layout
from comarca.plans import indicators, serving


def lines_of(rows, tolerance):
    out, pages = {}, {}
    for page, x, top, text in rows:
        pages.setdefault(page, []).append((top is not None, top or 0.0, x, text))
    for page, words in pages.items():
        anchor, line = None, -1
        for there, top, x, text in sorted(words, key=lambda w: w):
            if anchor is None or top - anchor > tolerance:
                anchor, line = (top if there else None), line + 1
            out.setdefault((page, line), []).append(text)
    return {k: sorted(v) for k, v in out.items()}


def test_lines_over_batches_and_pages(spark):
    """Pages longer than a batch, one with a third of all words, words without a top."""
    rnd = random.Random(3)
    rows = [("big" if i % 3 == 0 else f"p{i % 5}", float(rnd.randrange(500)), None if i % 97 == 0 else rnd.randrange(4000) / 4, f"w{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "page string, x0 double, top double, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {}
        for r in layout.word_lines(df, ["page"], 6.0).collect():
            got.setdefault((r.page, r.line), []).append(r.text)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {k: sorted(v) for k, v in got.items()} == lines_of(rows, 6.0)
    chain = spark.createDataFrame([(1, 0.0, t, str(t)) for t in (0.0, 4.0, 7.0)], "page int, x0 double, top double, text string")
    assert sorted((r.top, r.line) for r in layout.word_lines(chain, ["page"], 6.0).collect()) == [(0.0, 0), (4.0, 0), (7.0, 1)]
    assert layout.word_lines(df.where("false"), ["page"], 6.0).collect() == []


def test_sections_and_windows(spark):
    words = [(1, 0.0, 10.0, "Tabla"), (1, 5.0, 10.0, "1"), (1, 0.0, 20.0, "uno"), (1, 0.0, 60.0, "Tabla"), (1, 0.0, 66.0, "dos"), (1, 0.0, 2.0, "before"), (2, 9.0, 5.0, "Tabla"), (2, 0.0, 5.0, "not first")]
    df = spark.createDataFrame(words, "page int, x0 double, top double, text string")
    lines = layout.word_lines(df, ["page"], 3.0)
    bounds = layout.section_bounds(lines, ["page"], "Tabla")
    assert [(r.page, r.section, r.y_min, r.y_max) for r in bounds.orderBy("section").collect()] == [(1, 1, 11.0, 59.0), (1, 2, 61.0, 66.0)]
    held = layout.words_in_sections(df, bounds, ["page"])
    # eight more at the foot: the next header and its rows are near enough to be in both
    assert sorted((r.text, r.section) for r in held.collect()) == [("Tabla", 1), ("dos", 1), ("dos", 2), ("uno", 1)]
    assert {r.text for r in layout.words_between(df, 1.0, 5.0).collect()} == {"1"} and layout.words_between(df).count() == len(words)
    assert [r.first for r in layout.entity_lines(lines, ["page"], 3.0, 1, 4).orderBy("page", "line").collect()] == ["before", "Tabla", "Tabla", "not first"]
    assert [r.first for r in layout.entity_lines(lines, ["page"], 3.0, 2, 4).collect()] == ["Tabla", "not first"]


def test_column_starts_gather_no_page(spark):
    """Commonest widths, ties, a fixed width, places without x, against plain medians; no aggregate collects lines."""
    rnd = random.Random(6)
    rows = [(page, line, rnd.choice([None, -0.0, float(rnd.randrange(-40, 40)), rnd.uniform(-1e3, 1e3)])) for page in (1, 2, 3) for line in range(60 if page < 3 else 3) for _ in range(1 + line % 4 if page < 3 else line + 2)]
    lines = spark.createDataFrame(rows, "page int, line int, x0 double")
    for width in (None, 2, 3, 7):
        want = {}
        for page in (1, 2, 3):
            words = {}
            for p, line, x in rows:
                if p == page:
                    words.setdefault(line, []).append(x)
            sizes = Counter(map(len, words.values()))
            w = width or min(sizes, key=lambda n: (-sizes[n], n))
            used = [sorted(xs, key=lambda x: (x is not None, x or 0.0)) for xs in words.values() if len(xs) == w or sizes[w] < 2]
            columns = [[xs[i] for xs in used if i < len(xs)] for i in range(w)]
            want[page] = [statistics.median(kept) if (kept := [x for x in xs if x is not None]) else None for xs in columns if xs]
        got = {r.page: r.starts for r in layout.column_starts(lines, ["page"], width).collect()}
        assert set(got) == set(want) and all(g == pytest.approx(w_, abs=1e-12) for p in got for g, w_ in zip(got[p], want[p], strict=True))
    starts = layout.column_starts(lines, ["page"])
    assert "percentile" not in (plan := starts._jdf.queryExecution().optimizedPlan().toString()) and "median" not in plan
    assert "collect_list(_n" not in starts._jdf.queryExecution().optimizedPlan().toString()


def test_medians_by_radix_equal_spark(spark):
    """Doubles of all magnitudes and signs, repeated ones, a null group, groups of one, of nulls, of infinities."""
    rnd = random.Random(7)
    inf = float("inf")
    odd = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, inf, -inf, float("nan"), None, 1.0, 1.0000000000000002]
    rows = [(g, rnd.choice([rnd.choice(odd), rnd.uniform(-1, 1) * 10.0 ** rnd.randrange(-300, 300), float(rnd.randrange(5))]), rnd.randrange(1, 4)) for g in (None, *range(40)) for _ in range(1 + (g or 0) * 2 % 37)]
    rows += [(90, None, 1), (91, inf, 2), (91, -inf, 1), (92, float("nan"), 3), (93, 1.0, 1), (93, 2.0, 1)]
    counted = spark.createDataFrame(rows, "g int, v double, n int")
    each = counted.withColumn("_", F.explode(F.sequence(F.lit(1), "n"))).groupBy("g").agg(F.median("v").alias("m"))
    got = {r.g: str(r.m) for r in aggregate.grouped_medians(counted, ["g"], "v", "n", "m").collect()}
    assert got == {r.g: str(None if r.m is None else r.m + 0.0) for r in each.collect()} and got[90] == "None"


def test_high_sections_stay_one_row_a_word(spark):
    """Sections of any height, words on their ends, places and pages that are null; one section is 10**12 high."""
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 1, 2]), None if rnd.random() < 0.05 else float(rnd.randrange(90)), rnd.choice(["Tabla", "x", "y"]), i) for i in range(400)]
    rows += [(3, 0.0, "Tabla", 400), (3, 5e11, "x", 401), (3, 1e12, "y", 402)]
    lines = spark.createDataFrame([(p, t, w, i, i, 0.0) for p, t, w, i in rows], "page int, top double, text string, id int, line int, x0 double")
    for below, slack in ((1.0, 8.0), (1.0, 0.0), (0.5, 30.0), (4.0, 2.0)):
        bounds = layout.section_bounds(lines, ["page"], "Tabla", below)
        want = sorted((i, b.section) for b in bounds.collect() for p, t, _, i in rows if None not in (p, t, b.y_min, b.y_max) and p == b.page and b.y_min <= t <= b.y_max + slack)
        got = layout.words_in_sections(lines, bounds, ["page"], slack)
        assert got.columns == [*lines.columns, "section"] and sorted((r.id, r.section) for r in got.collect()) == want and want


def test_surplus_words_extend_the_name(spark):
    def cells(words):
        rows = [(1, 0, x, t) for x, t in words]
        lines = spark.createDataFrame(rows, "page int, line int, x0 double, text string")
        starts = spark.createDataFrame([(1, [0.0, 50.0, 100.0])], "page int, starts array<double>")
        return layout.cells_of_lines(lines, starts, ["page"]).first().cells

    assert cells([(0.0, "San"), (12.0, "Andrés"), (51.0, "1"), (99.0, "2")]) == ["San Andrés", "1", "2"]
    assert cells([(40.0, "Norte"), (44.0, "Sur"), (70.0, "1"), (99.0, "2")]) == ["Norte", "Sur 1", "2"]  # the first word is the name's
    assert cells([(40.0, "Norte"), (70.0, "1"), (99.0, "2")]) == ["", "Norte 1", "2"]  # exact width: by place alone
    assert cells([(0.0, "Uno"), (99.0, "2")]) == ["Uno", "", "2"]


def test_interval_join_equals_all_pairs(spark):
    rnd = random.Random(8)
    points = [(i, rnd.randrange(3), rnd.choice([None, rnd.uniform(-90, 90), float(rnd.randrange(-9, 9) * 10)])) for i in range(300)]
    spans = [(i, rnd.randrange(3), *((lo := float(rnd.randrange(-90, 90))), lo + rnd.choice([-5, 0, 3, 77]))) for i in range(60)]
    got = joins.interval_join(spark.createDataFrame(points, "p int, k int, v double"), spark.createDataFrame(spans, "s int, k int, lo double, hi double"), ["k"], "v", "lo", "hi", 10.0)
    want = {(p, s) for p, k, v in points for s, j, lo, hi in spans if v is not None and k == j and lo <= v <= hi}
    found = [(r.p, r.s) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)


def test_interval_join_of_full_bins_and_any_length(spark):
    """Bins far over a cell's side, equal rows, lengths from 0 to infinity, against all pairs."""
    rnd = random.Random(9)
    inf = float("inf")
    points = [(i // 2, rnd.choice([None, 0, 0, 1]), rnd.choice([None, inf, -inf, 1e300, -7e11, *(rnd.uniform(-90, 90) for _ in range(9))])) for i in range(300)]
    spans = []
    for i in range(200):
        lo = rnd.choice([-inf, -1e300, -8e11, float(rnd.randrange(-90, 90))]) if i % 4 == 0 else rnd.uniform(-10, 10)
        spans.append((i // 2, rnd.choice([None, 0, 0, 1]), lo, lo + rnd.choice([0.0, 3.0, 10.0, 77.0, 1e12, 1.5e300, inf]) if lo > -inf else rnd.choice([-inf, 0.0, inf])))
    args = spark.createDataFrame(points, "p int, k int, v double"), spark.createDataFrame(spans, "s int, k int, lo double, hi double")
    want = Counter((p, s, v, lo, hi) for p, k, v in points for s, j, lo, hi in spans if v is not None and k is not None and k == j and lo <= v <= hi)
    for side in (8, 100_000):
        got = joins.interval_join(*args, ["k"], "v", "lo", "hi", 10.0, side)
        assert Counter((r.p, r.s, r.v, r.lo, r.hi) for r in got.collect()) == want and got.columns == ["k", "p", "v", "s", "lo", "hi"]


def test_long_intervals_stay_three_rows(spark):
    points = spark.createDataFrame([(1, 0, 5e11), (2, 0, 2e12)], "p int, k int, v double")
    spans = spark.createDataFrame([(1, 0, 0.0, 1e12), (2, 0, 5e11, 5e11)], "s int, k int, lo double, hi double")
    assert sorted((r.p, r.s) for r in joins.interval_join(points, spans, ["k"], "v", "lo", "hi", 10.0).collect()) == [(1, 1), (1, 2)]


def test_interval_join_in_blocks_smaller_than_cells(spark):
    """Cells of several blocks on both sides, cut anywhere, against all pairs."""
    rnd = random.Random(10)
    points = [(i, i % 2, float(rnd.randrange(-30, 30))) for i in range(200)]
    spans = [(i, i % 2, lo := float(rnd.randrange(-30, 30)), lo + rnd.choice([0.0, 4.0, 10.0])) for i in range(150)]
    args = spark.createDataFrame(points, "p int, k int, v double"), spark.createDataFrame(spans, "s int, k int, lo double, hi double")
    want = Counter((p, s) for p, k, v in points for s, j, lo, hi in spans if k == j and lo <= v <= hi)
    for side, block in ((32, 5), (100_000, 8)):
        assert Counter((r.p, r.s) for r in joins.interval_join(*args, ["k"], "v", "lo", "hi", 10.0, side, block).collect()) == want


def test_pairs_of_full_bins_take_little_disk(spark, tmp_path):
    """Files of pairs grow with the square of a full bin: well under a byte a pair."""
    points = spark.range(1000).select((F.col("id") * 7919).alias("p"), F.lit(0).alias("k"), (F.col("id") % 20 * 5 + 0.5).alias("v"))
    spans = spark.range(3000).select((F.col("id") * 104729).alias("s"), F.lit(0).alias("k"), (F.col("id") * 37 % 1000 / 10).alias("lo")).withColumn("hi", F.col("lo") + 100)
    out = str(tmp_path / "pairs")
    joins.interval_join(points, spans, ["k"], "v", "lo", "hi", 100.0).select("p", "s").write.parquet(out)
    want = sum(1 for i in range(1000) for j in range(3000) if j * 37 % 1000 / 10 <= i % 20 * 5 + 0.5)
    assert spark.read.parquet(out).distinct().count() == spark.read.parquet(out).count() == want
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < want / 3


def test_extractors_in_turn(spark):
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "doc string")
    seen = {}

    def extractor(name, rows, **gate):
        def extract(open_):
            seen[name] = {r.doc for r in open_.collect()}
            found = spark.createDataFrame(rows, "doc string, table int, row_no int, cells array<string>").join(open_, "doc", "left_semi")
            return fallback.gated(found, ["doc"], **gate)

        return name, extract

    stages = [
        extractor("lines", [("a", 0, 0, ["Entidad", "n"]), ("a", 0, 1, ["x", "1"]), ("b", 0, 0, ["Otra", "n"]), ("b", 0, 1, ["y", "1"])], least_rows=2, prefixes=["entidad"], authoritative=True),
        extractor("grid", [("a", 0, 0, ["late"]), ("b", 1, 0, ["y"]), ("c", 0, 0, ["short"])] + [("b", 1, i, ["y"]) for i in (1, 2)], least_rows=3),
        extractor("text", [("c", 0, 0, ["z"])], least_rows=1),
    ]
    stored = []
    got = fallback.chain(units, stages, ["doc"], store=lambda df, name: stored.append(name) or df.cache())
    assert sorted((r.doc, r.extractor, r.row_no) for r in got.collect()) == [("a", "lines", 0), ("a", "lines", 1), ("b", "grid", 0), ("b", "grid", 1), ("b", "grid", 2), ("c", "text", 0)]
    assert seen == {"lines": {"a", "b", "c"}, "grid": {"b", "c"}, "text": {"c"}} and stored == ["lines", "grid", "text"]


def test_catalogue_is_the_published_report():
    listed = serving.catalogue()
    columns = set(indicators.metric_columns("region"))
    assert len(listed) == 36 and len({m for m, *_ in listed}) == 36 and {m for m, *_ in listed} <= columns
    units = {m: (label, unit, only) for m, _, label, unit, only in listed}
    assert units["violencia_genero_intrafamiliar"] == ("Total genero/intrafamiliar", "casos", True)
    assert units["razon_mortalidad_materna"][1] == "x100k NV" and units["prevalencia_desnutricion_aguda"][1] == "x100k <5"
    assert units["capacidad_instalada"][1] == "camas" and units["pob_raizal"][1] == "personas" and units["ips_intervenidas"][1] == ""
    towns = set(indicators.metric_columns("town"))
    # a metric of regions only has no value of its own in a town's row
    assert {m for m, *_, only in listed if not only} - towns == {"casos_sifilis_congenita"}


def test_coverage_alert(spark):
    rows = spark.createDataFrame([(95.0,), (90.0,), (89.9,), (0.0,), (None,)], "v double")
    assert [r.a for r in rows.select(numbers.coverage_alert(F.col("v")).alias("a")).collect()] == ["good", "good", "fair", "fair", "fair"]
