"""Every registered query against its DuckDB SQL on the smallest scale, plus the entry point."""
import datetime as dt
import decimal
import math
import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in data)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    import __spark_entry__ as e
    return sorted(e.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = e.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL form")
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, got) == canon(cols, want)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["year", "month", "state_name", "status", "registration_count"]
    assert df.count() > 0
