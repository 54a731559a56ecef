import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = sorted(entry.indicator_queries.QUERIES)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(sf_small):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_small}/{name}'")
    return con


def canonical(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(v):
        return repr(round(v, 6)) if isinstance(v, float) else str(v)

    return [sorted(columns), *sorted(tuple(cell(r[i]) for i in order) for r in rows)]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    got = canonical(df.columns, df.collect())
    if (sql := entry.oracle_sql().get(name)) is None:
        assert len(got) > 1
    else:
        want = duck.sql(sql)
        assert got == canonical(want.columns, want.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() == 25
