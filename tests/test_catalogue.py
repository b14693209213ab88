"""Every named query against its SQL, on the same files."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "None"
    if isinstance(v, dict):
        return repr({k: plain(x) for k, x in v.items()})
    return repr([plain(x) for x in v]) if isinstance(v, list) else repr(v)


def table(arrow):
    names = sorted(arrow.schema.names)
    return names, sorted(tuple(plain(v) for v in r) for r in zip(*(arrow[n].to_pylist() for n in names), strict=True))


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, data, name):
    result = entry_points.queries()[name](spark, data).toArrow()
    if name not in SQL:
        assert result.num_rows > 0
        return
    expected = duck.sql(SQL[name]).to_arrow_table()
    got, want = table(result), table(expected)
    assert got == want
    for n in got[0]:
        assert str(result.schema.field(n).type) == str(expected.schema.field(n).type), n


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["area_name", "sale_year", "sale_month", "avg_price"]
