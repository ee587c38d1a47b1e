from pyspark.sql import functions as F

from zonage.session import bounded_broadcast, materialize


def _hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_bounded_broadcast_rows(spark):
    df = spark.range(3)
    assert bounded_broadcast(df, max_rows=1) is df
    assert bounded_broadcast(df, max_rows=10) is not df


def test_bounded_broadcast_items(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([4, 5],)], "a array<int>")
    assert bounded_broadcast(df, max_rows=10, items=F.size("a"), max_items=4) is df
    assert bounded_broadcast(df, max_rows=10, items=F.size("a"), max_items=5) is not df


def test_materialize_cuts_lineage(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    m = materialize(df)
    plan = m._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan and sorted(r.x for r in m.collect()) == [0, 2, 4, 6, 8]
