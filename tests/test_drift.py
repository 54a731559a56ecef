"""Drifting Parquet sets, files of mixed dialects, large workbooks."""

import io
import itertools
import resource
import zipfile

import pytest
from pyspark.sql import types as T

from comarca.sources import delimited, files, lattice, xlsx

KINDS = [T.NullType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.StringType()]


def test_types_are_a_semilattice():
    for a, b, c in itertools.product(KINDS, repeat=3):
        assert lattice.joined(a, b) == lattice.joined(b, a)
        assert lattice.joined(a, lattice.joined(b, c)) == lattice.joined(lattice.joined(a, b), c)
        assert lattice.joined(a, a) == a


def test_widened_columns(spark, tmp_path):
    for name, schema, row in (("a", "k int, v int, d date", (1, 7, None)), ("b", "v bigint, w string", (2**40, "x")), ("c", "v double, k string", (2.5, "q")), ("d", "k int", (3,))):
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(str(tmp_path / f"t_{name}.parquet"))
    got = files.read_union_by_name(spark, str(tmp_path / "t_*.parquet"))
    assert dict(got.dtypes) == {"k": "string", "v": "double", "d": "date", "w": "string"}
    assert sorted((r.k or "", r.v or 0.0, r.w or "") for r in got.collect()) == [("", 2.0**40, "x"), ("1", 7.0, ""), ("3", 0.0, ""), ("q", 2.5, "")]


def test_many_files_take_few_jobs(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for i in range(1000):
        kind = (pa.int32(), pa.int64(), pa.string())[i % 3]
        pq.write_table(pa.table({"v": pa.array([str(i) if i % 3 == 2 else i], kind), f"c{i % 2}": [1.5]}), tmp_path / f"f{i:04}.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        got = lattice.read_drifting(spark, [str(tmp_path)])
    finally:
        jobs = len(tracker.getJobIdsForGroup("footers"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3 + 6  # two listings, the footers, and a listing for each of six layouts
    assert dict(got.dtypes) == {"v": "string", "c0": "double", "c1": "double"} and got.count() == 1000


def test_mixed_dialects(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Año;b;c;d;e;f\nñ\x01x;2;\"q;r\";4;5;6\n\nz;;;;;\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("﻿c|b|Año|g|e|f\n漢|2|3|4|5|6|extra\nshort|1\n".encode())
    (tmp_path / "c.csv").write_bytes(b"b,b,c,d,e,f\n1,2,3,4,5,6\n1,2,3,4,5,6\n")
    got = delimited.read_mixed(spark, str(tmp_path))
    assert set(got.columns) == {"path", "Año", "b", "c", "d", "e", "f", "g", "b.1"}
    rows = sorted(((r.path[-5:], r["Año"], r.b, r["b.1"], r.c, r.g) for r in got.collect()), key=str)
    assert rows == sorted([("a.csv", "ñ\x01x", "2", None, "q;r", None), ("a.csv", "z", None, None, None, None), ("b.csv", "3", "2", None, "漢", "4"), ("b.csv", None, "1", None, "short", None), *[("c.csv", None, "1", "2", "3", None)] * 2], key=str)
    (tmp_path / "d.csv").write_bytes(b"only,three,names\n1,2,3\n")
    with pytest.raises(ValueError, match="d.csv"):
        delimited.read_mixed(spark, str(tmp_path))


def test_large_files_keep_their_lines(spark, tmp_path):
    """Splits of a file have no header of their own, and no line is lost between them."""
    with open(tmp_path / "big.csv", "wb") as out:
        out.write(b"a;b;c;d;e;f\n")
        out.writelines(b"%d;2;3;4;5;6\n" % i for i in range(60_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = delimited.read_mixed(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 5
        assert [r.n for r in got.selectExpr("count(DISTINCT a) AS n").collect()] == [60_000] and got.count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def big_workbook(path, rows: int) -> None:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Uno" sheetId="1" r:id="r"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/sharedStrings.xml", "w") as out:
            out.write(f"<sst {main}>".encode())
            out.writelines(b"<si><t>town %d</t></si>" % i for i in range(rows))
            out.write(b"</sst>")
        with z.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f"<worksheet {main}><sheetData>".encode())
            out.writelines(b'<row r="%d"><c r="A%d" t="s"><v>%d</v></c><c r="C%d"><v>%d</v></c></row>' % (i + 1, i + 1, rows - 1 - i, i + 1, i) for i in range(rows))
            out.write(b"</sheetData></worksheet>")


def test_a_million_rows_in_bounded_memory(tmp_path):
    """Beside the packed file: under 60 MB for a million rows and a million shared strings."""
    big_workbook(tmp_path / "big.xlsx", 1_000_000)
    data = (tmp_path / "big.xlsx").read_bytes()
    before, seen = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, 0
    for i, (_, number, cells) in enumerate(xlsx.sheet_rows(data)):
        assert number == i + 1
        if i % 100_000 == 0:
            assert cells == [f"town {999_999 - i}", None, str(i)]
        seen += 1
    assert seen == 1_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 60_000


def test_batches_of_a_workbook(spark, tmp_path):
    big_workbook(tmp_path / "a.xlsx", 5_000)
    (tmp_path / "b.zip").write_bytes(b"")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.write(tmp_path / "a.xlsx", "inner.xlsx")
    got = xlsx.read_rows(spark, [str(tmp_path / "a.xlsx"), str(tmp_path / "b.zip")], "Uno", 4_001)
    assert got.count() == 2_000 and got.selectExpr("max(row_no) AS m").first().m == 5_000
    assert list(xlsx.sheet_rows((tmp_path / "a.xlsx").read_bytes(), 0, 5_000)) == [("Uno", 5_000, ["town 0", None, "4999"])]
    with pytest.raises(ValueError):
        next(xlsx.sheet_rows(io.BytesIO((tmp_path / "a.xlsx").read_bytes()).getvalue(), "Dos"))
