import io
import zipfile

from pyspark.sql import functions as F

from comarca.sources import delimited, files, geojson, sinks, xlsx
from comarca.streaming import ingest_available, upsert_latest


def test_tolerant_reader(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿a|b|c\n1|2|3|4|5\n1|2\nñ|x|y\n".encode("utf-8"))
    got = delimited.read_tolerant(spark, str(tmp_path / "x.csv"), encoding="UTF-8")
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect())) == [("1", "2", ""), ("1", "2", "3|4|5"), ("ñ", "x", "y")]


def test_separator_tie_and_names(spark):
    lines = spark.createDataFrame([("1;2",)], "value string")
    assert delimited.fit_lines(lines, "a;a").columns == ["a", "a.1"]
    assert delimited.fit_lines(lines, "ab").columns == ["ab"]


def test_probe(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("a;b;c;d;e;f\nñ;2;3;4;5;6\n".encode("latin-1"))
    assert delimited.read_probed(spark, str(tmp_path / "a.csv")).first().a == "ñ"
    (tmp_path / "b.csv").write_bytes("a|b|c|d|e|f\nñ|2|3|4|5|6\n".encode())
    assert delimited.read_probed(spark, str(tmp_path / "b.csv")).first().a == "ñ"


def workbook(rows) -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings: list[str] = []

    def cell(r, c, v):
        if v is None:
            return ""
        ref = f"{'ABCDEFGH'[c]}{r}"
        if isinstance(v, str):
            strings.append(v)
            return f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'

    body = "".join(f'<row r="{i}">{"".join(cell(i, j, v) for j, v in enumerate(row))}</row>' for i, row in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Uno" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{s}</t></si>' for s in strings)}</sst>")
    return out.getvalue()


def test_spreadsheets(spark, tmp_path):
    data = workbook([["DP", "Año"], ["05", 2024], [None, "x"]])
    (tmp_path / "a.xlsx").write_bytes(data)
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("inner.xlsx", data)
    xlsx.register(spark)
    got = spark.read.format("xlsx_rows").option("sheet", "Uno").load(str(tmp_path))
    assert got.count() == 6
    rows = xlsx.read_rows(spark, str(tmp_path / "*"), 0, 2)
    assert sorted((r.row_no, r.cells) for r in rows.collect())[::2] == [(2, ["05", "2024"]), (3, [None, "x"])]
    assert xlsx.fixed_width(rows, ["a", "b", "c"]).where("a IS NULL").count() == 2


def test_drifting_parquet(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a bigint, b string").write.parquet(str(tmp_path / "t_2024_01.parquet"))
    spark.createDataFrame([("y", 2.0)], "a string, c double").write.parquet(str(tmp_path / "t_2024_02.parquet"))
    union = files.read_union_by_name(spark, str(tmp_path / "t_*.parquet"))
    assert sorted(map(tuple, union.select("a", "b", "c").collect()), key=str) == [("1", "x", None), ("y", None, 2.0)]
    assert files.read_first_schema(spark, str(tmp_path / "none*")) is None
    assert files.latest_file(spark, str(tmp_path / "t_*")).endswith("t_2024_02.parquet")
    assert files.first_result([lambda: None, lambda: union.where("false"), lambda: union]) is union


def test_snapshots(spark, tmp_path):
    for stamp in ("2024_01", "2024_02"):
        spark.range(2).coalesce(1).write.csv(str(tmp_path / stamp))
        next((tmp_path / stamp).glob("part*.csv")).rename(tmp_path / f"s_{stamp}.csv")
    df = files.with_snapshot(spark.read.csv(str(tmp_path / "s_*.csv")))
    assert df.count() == 4 and files.latest_snapshot(df).count() == 2


def test_geojson(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"type":"x","features":[{"type":"f","properties":{"shapeISO":"CO-ANT"},"geometry":{"a":1}},{"type":"f","properties":{}}]}')
    got = geojson.read_features(spark, str(tmp_path / "g.json"), {"CO-ANT": 5}).collect()
    assert got[0].id == "05" and got[0].properties["DPTO"] == "05" and got[1].id is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2024_01", 1), ("2024_02", 2)], "stamp string, v int")
    assert sinks.write_counted(df, str(tmp_path / "p")) == 2
    assert sinks.csv_with_bom(df).startswith(b"\xef\xbb\xbfstamp")
    done = str(tmp_path / "done")
    assert sinks.unprocessed(df, sinks.done_stamps(spark, done)).count() == 2
    sinks.record_stamps(df.where("v = 1").select("stamp"), done)
    assert [r.stamp for r in sinks.unprocessed(df, sinks.done_stamps(spark, done)).collect()] == ["2024_02"]
    sinks.write_csv(df, str(tmp_path / "c"), "|")
    assert spark.read.csv(str(tmp_path / "c"), header=True, sep="|").count() == 2


def test_incremental(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    first = spark.createDataFrame([(1, 2023, "a")], "k int, y int, v string")
    first.write.parquet(inbox)
    assert ingest_available(spark, inbox, first.schema, out, mark) == 1
    spark.createDataFrame([(1, 2024, "b"), (2, 2020, "c")], first.schema).write.mode("append").parquet(inbox)
    assert ingest_available(spark, inbox, first.schema, out, mark) == 2
    assert ingest_available(spark, inbox, first.schema, out, mark) == 0
    stored = spark.read.parquet(out)
    assert sorted(map(tuple, upsert_latest(None, stored, ["k"], [F.col("y")]).collect())) == [(1, 2024, "b"), (2, 2020, "c")]
    assert upsert_latest(first, stored, ["k"], [F.col("y")]).count() == 2
