"""Every registered query against its DuckDB oracle on the smallest data
set (the driver's correctness gate, run locally)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    """ints and floats kept apart, floats to 9 significant digits."""
    import decimal
    if isinstance(v, decimal.Decimal):
        return ("f", float(f"{float(v):.9g}"))
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", float(f"{v:.9g}"))
    if isinstance(v, int) and not isinstance(v, bool):
        return ("i", v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "score" in df.columns


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF)
    rows = sdf.collect()
    sql = entry.oracle_sql().get(key)
    if sql is None:
        pytest.skip("no SQL oracle (rows-only)")
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    dorder = [dcols.index(sdf.columns[i]) for i in order]
    assert Counter(tuple(norm(r[i]) for i in order) for r in rows) == \
        Counter(tuple(norm(r[i]) for i in dorder) for r in drows)
