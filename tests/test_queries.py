"""Every registered query next to its SQL at the smallest scale, and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.conftest import SF
from tools.check import TABLES, canonical

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name, capsys):
    df = QUERIES[name](spark, SF)
    df.explain()
    plan = capsys.readouterr().out
    assert not [op for op in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython") if op in plan]
    got = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert got
        return
    want = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.columns, got) == canonical(want.columns, want.fetchall())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["day", "total", "mean", "std", "maximum", "minimum"] and df.count() > 0


@pytest.mark.parametrize("name,pushed,read", [
    ("orders_on_day", "GreaterThanOrEqual(o_orderdate", "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>"),
    ("filter_agg", "GreaterThanOrEqual(l_quantity,5.0)",
     "struct<l_quantity:double,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>"),
    ("project_rename", "", "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>")])
def test_scans_are_pruned(spark, capsys, name, pushed, read):
    QUERIES[name](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert pushed in plan and f"ReadSchema: {read}" in plan
