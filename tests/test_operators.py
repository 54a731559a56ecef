from pyspark.sql import functions as F

from comarca.operators import aggregate, joins, latest, layout, ordering, reshape, tables


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_is_unique_and_ranked(spark):
    rows = [(1, 2020, "a"), (1, 2021, None), (1, 2021, "b"), (2, None, "c"), (2, 2000, "d")]
    df = spark.createDataFrame(rows, "k int, y int, v string")
    assert values(latest.latest_per(df, ["k"], [F.col("y")], None, [F.col("v")])) == [(1, 2021, "b"), (2, 2000, "d")]
    done = latest.complete_first(F.nullif("v", F.lit("b")))
    assert values(latest.latest_per(df, ["k"], [done, F.col("y")], {"v": F.col("v")})) == [(1, "a"), (2, "d")]


def test_unused_latest_leaves_the_plan(spark):
    base = spark.range(5).withColumnRenamed("id", "k")
    other = latest.latest_per(spark.range(5).selectExpr("id AS k", "id AS v"), ["k"], [F.col("v")])
    plan = base.join(other, "k", "left").select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_two_level(spark):
    df = spark.createDataFrame([(1, 10, 1, 5.0), (1, 10, 2, 7.0), (2, 10, 1, 1.0)], "e int, g int, y int, v double")
    out = latest.two_level(df, ["e"], ["g"], [F.col("y")], {"v": F.col("v")}, {"s": F.sum("v")})
    assert values(out) == [(10, 8.0)]


def test_overlay(spark):
    base = spark.createDataFrame([(1, 5, "x"), (2, 6, "y")], "k int, v int, w string")
    patch = spark.createDataFrame([(1, 50)], "k int, v int")
    assert values(joins.overlay(base, patch, ["k"], ["v"])) == [(1, 50, "x"), (2, None, "y")]
    assert values(joins.overlay(base, patch.where("false"), ["k"], ["v"])) == values(base)


def test_star_keeps_rows_and_types(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    out = joins.star(base, ["k"], [(spark.createDataFrame([(1, 9)], "k int, v int"), {"v": "bigint"}), (None, {"z": "double"})])
    assert values(out) == [(1, 9, None), (2, None, None)] and dict(out.dtypes)["v"] == "bigint" and dict(out.dtypes)["z"] == "double"


def test_bands(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 9, 10, 19, 20)], "x double")
    assert [r[0] for r in df.select(joins.band_of(F.col("x"), [10, 20])).collect()] == [0, 0, 1, 1, 2]
    starts = F.array(F.lit(0.0), F.lit(10.0), F.lit(30.0))
    assert [r[0] for r in df.select(joins.midpoint_band(F.col("x"), starts)).collect()] == [0, 1, 1, 1, 2]


def test_gate(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "q"), ("a", None), ("b", "q"), ("b", "q"), ("c", None), ("c", None)], "t string, v string")
    good = aggregate.gated(df, ["t"], F.col("v") == "x", 2, 0.3, F.col("v").isNotNull())
    assert {r.t for r in good.collect()} == {"a"}


def test_crosstab_and_rates(spark):
    df = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "p"), ("a", "r")], "r string, c string")
    assert [tuple(r) for r in aggregate.crosstab(df, "r", "c", ["p", "z"]).collect()] == [("a", 1, 0, 3), ("b", 1, 0, 1)]
    rate = aggregate.match_rate(spark.createDataFrame([("x", 1), ("y", None), (None, None)], "raw string, code int"), "raw", "code").first()
    assert (rate.matched, rate.total, rate.pct) == (1, 2, 50.0)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert aggregate.peer_means(df, ["v"]).first().v == 2.0
    assert [r.v for r in ordering.descending(df, "v").collect()][:2] == [3.0, 1.0]


def test_melt_keeps_the_sum(spark):
    df = spark.createDataFrame([("t", "5", "7", "x"), ("u", "1.0", None, "2")], "id string, `Hombres 0` string, `Mujeres 0` string, `Mujeres 1` string")
    long = reshape.melt_counts(df, ["id"], r"^(Hombres|Mujeres)\s+(\d{1,3})", {"sexo": 1, "edad": 2})
    assert values(long) == [("t", "HOMBRES", "0", 5), ("t", "MUJERES", "0", 7), ("u", "HOMBRES", "0", 1), ("u", "MUJERES", "1", 2)]


def test_blank_rows_go_before_constants(spark):
    df = spark.createDataFrame([(None, None), ("a", None)], "a string, b string")
    assert reshape.drop_blank_rows(df).count() == 1
    assert reshape.drop_blank_rows(df.withColumn("c", F.lit(1))).count() == 2


def raw_rows(spark):
    rows = [(0, ["Title"]), (1, ["DP", None, "Sexo"]), (2, ["", "Name", "Hombres"]), (3, ["5", "A", "1"]), (4, ["8", "B", "2", "9"])]
    return spark.createDataFrame(rows, "row_no int, cells array<string>")


def test_headers(spark):
    rows = raw_rows(spark)
    assert tables.header_by_names(rows, ["dp"]) == 1 and tables.header_by_names(rows, ["zz"]) is None
    assert tables.header_by_fill(rows) == 2
    names = tables.fused_header(tables.cells_of(rows, 1), tables.cells_of(rows, 2))
    assert names == ["DP", "Name", "Hombres"]
    out = tables.with_names(rows.where("row_no > 2"), names)
    assert values(out.drop("row_no")) == [("5", "A", "1"), ("8", "B", "2")]
    assert tables.positional(rows, ["a", "b"], 1).columns == ["row_no", "a"]


def test_positional_trim_and_tables(spark):
    rows = spark.createDataFrame([(0, i, [c]) for i, c in enumerate("xay")] + [(1, i, [c]) for i, c in enumerate("xy")], "t int, row_no int, cells array<string>")
    kept = tables.from_first(rows, ["t"], F.get("cells", F.lit(0)) == "a")
    assert values(kept.select("t", "row_no")) == [(0, 1), (0, 2), (1, 0), (1, 1)]
    assert {r.t for r in tables.first_table(rows, "t", ["X"]).collect()} == {0}
    assert tables.picked_tables(rows, "t", [1, 7]).count() == 2
    lead = spark.createDataFrame([(0, 0, ["", " "]), (0, 1, ["", "a\nb"])], "t int, row_no int, cells array<string>")
    assert [r.cells for r in tables.cleaned_table(lead, ["t"]).collect()] == [["a b"]]
    assert tables.pages_to_try(1, 4) == [1, 0, 2, 3]


def test_lines_are_anchored(spark):
    words = [(1, 0.0, 0.0, "a"), (1, 30.0, 4.0, "b"), (1, 0.0, 7.0, "c"), (1, 40.0, 7.8, "d")]
    df = spark.createDataFrame(words, "p int, x0 double, top double, text string")
    lined = layout.word_lines(df, ["p"], 6.0)
    assert {r.text: r.line for r in lined.collect()} == {"a": 0, "b": 0, "c": 1, "d": 1}
    starts = layout.column_starts(lined, ["p"])
    rows = layout.cells_of_lines(lined, starts, ["p"])
    assert values(rows.select("line", "cells")) == [(0, ["a", "b"]), (1, ["c", "d"])]
    assert layout.filled_rows(rows).count() == 2
    assert {r.text for r in layout.from_entity(lined, ["p"], ["c"]).collect()} == {"c", "d"}
    assert layout.from_entity(lined, ["p"], ["c"], header="zz").count() == 0


def test_gaps(spark):
    words = spark.createDataFrame([(1, 0, 20), (1, 10, 60), (1, 70, 80), (1, 120, 130)], "p int, left int, right int")
    assert layout.gap_starts(words, ["p"]).first().starts == [0.0, 120.0]
