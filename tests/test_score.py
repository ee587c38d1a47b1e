import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonage.operators import score as S


def brute_pct(values):
    n = len(values)
    out = []
    for v in values:
        below = sum(1 for w in values if w < v)
        ties = sum(1 for w in values if w == v)
        out.append((below + (ties + 1) / 2) / n)
    return out


def brute_rank_desc(values):
    return [1 + sum(1 for w in values if w > v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=40))
def test_pct_rank_matches_brute_force(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
    got = {r.id: r.p for r in S.pct_rank_avg(df, "v", "p").collect()}
    exp = brute_pct(values)
    assert all(abs(got[i] - exp[i]) < 1e-12 for i in range(len(values)))


def test_rank_desc_ties_and_nulls(spark):
    vals = [0.5, 0.9, 0.5, None, 0.1, 0.9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    got = {r.id: r.rank for r in S.rank_desc(df, "v", "rank").collect()}
    assert got == {0: 3, 1: 1, 2: 3, 3: None, 4: 5, 5: 1}


def test_positions_hot_group_exact(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(0, 5000) / 7.0) for _ in range(3000)] + \
           [("cold", rnd.randint(-100, 100) * 1.5) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, v double")
    hist = df.groupBy("g", "v").agg(F.count("*").alias("_c"))
    got = {(r.g, r.v): (r._below, r._n) for r in S.positions(hist, "v", "_c", ["g"]).collect()}
    for g in ("hot", "cold"):
        vals = [v for gg, v in rows if gg == g]
        for v in set(vals):
            assert got[(g, v)] == (sum(1 for w in vals if w < v), len(vals))


def test_pct_rank_many_equals_single(spark):
    df = spark.createDataFrame([(i, i % 3, (i * 7) % 5) for i in range(12)], "zone int, a int, b int")
    many = {r.zone: (r.pa, r.pb) for r in S.pct_rank_many(df, "zone", {"a": "pa", "b": "pb"}).collect()}
    a = {r.zone: r.pa for r in S.pct_rank_avg(df, "a", "pa").collect()}
    b = {r.zone: r.pb for r in S.pct_rank_avg(df, "b", "pb").collect()}
    assert many == {z: (a[z], b[z]) for z in a}


@pytest.mark.parametrize("vals,expected", [
    ([3.0, 3.0, 3.0], [0.0, 0.0, 0.0]),                 # constant
    ([3.0, None, 3.0], [0.0, 0.0, 0.0]),                # constant with a NULL -> 0 for all
    ([None, None], [None, None]),                        # all NULL
    ([5.0], [0.0]),                                      # single row
    ([0.0, 5.0, 10.0, None], [0.0, 0.5, 1.0, None]),
])
def test_minmax_edge_cases(spark, vals, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    got = [r.n for r in S.minmax(df, {"v": "n"}).orderBy("id").collect()]
    assert got == expected


def test_minmax_fill_and_scale(spark):
    df = spark.createDataFrame([(0, None), (1, 2.0), (2, 4.0)], "id int, v double")
    got = [r.v for r in S.minmax(df, ["v"], fill=0, scale=100.0, digits=2).orderBy("id").collect()]
    assert got == [0.0, 50.0, 100.0]


def test_minmax_wn7_divides_by_one(spark):
    df = spark.createDataFrame([(0, 2.0), (1, 2.0)], "id int, v double")
    assert [r.n for r in S.minmax(df, {"v": "n"}, constant=None).collect()] == [0.0, 0.0]


def test_keep_first_explicit_order(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 2, "z"), (None, 1, "w")],
                               "k string, o int, v string")
    got = {r.k: r.v for r in S.keep_first(df, ["k"], ["o"]).collect()}
    assert got == {None: "w", "a": "y"}


def test_weighted_score_order_and_round(spark):
    df = spark.createDataFrame([(0.1, 0.2)], "a double, b double")
    r = S.weighted_score(df, {"a": 0.3, "b": 0.7}, "s", digits=4).first()
    assert r.s == round(0.3 * 0.1 + 0.7 * 0.2, 4)


def test_rank_with_infinities_and_nan(spark):
    vals = [float("-inf"), -1.0, 0.0, 2.5, float("inf"), float("nan"), 2.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    got = {r.id: r.rank for r in S.rank_desc(df, "v", "rank").collect()}
    # Spark orders NaN above +Inf
    assert got == {5: 1, 4: 2, 3: 3, 6: 3, 2: 5, 1: 6, 0: 7}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=9), min_size=1, max_size=30))
def test_pct_rank_mean_property(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
    got = [r.p for r in S.pct_rank_avg(df, "v", "p").collect()]
    n = len(values)
    assert abs(sum(got) / n - (n + 1) / (2 * n)) < 1e-12


def test_ranks_invariant_to_row_order(spark):
    rnd = random.Random(1)
    rows = [(i, float(rnd.randint(0, 20))) for i in range(200)]
    a = spark.createDataFrame(rows, "id int, v double")
    b = spark.createDataFrame(list(reversed(rows)), "id int, v double").repartition(7)
    ra = {r.id: (r.rank, r.p) for r in S.pct_rank_avg(S.rank_desc(a, "v", "rank"), "v", "p").collect()}
    rb = {r.id: (r.rank, r.p) for r in S.pct_rank_avg(S.rank_desc(b, "v", "rank"), "v", "p").collect()}
    assert ra == rb


def test_positions_spread_values_of_a_narrow_range(spark):
    """300 000 distinct values in a narrow range far from zero fall into many
    window partitions, and the prefix counts stay exact."""
    n = 300_000
    hist = spark.range(n).select((F.lit(1.7e9) + F.col("id")).alias("v"), F.lit(1).cast("long").alias("_c"))
    got = S.positions(hist, "v")
    bad = got.filter((F.col("_below") != (F.col("v") - 1.7e9).cast("long")) | (F.col("_n") != n)).count()
    assert bad == 0 and got.count() == n
    windows = got._jdf.queryExecution().toString()
    assert "_p" in windows
    d = F.col("v")
    b = hist.withColumn("_b", S.value_bucket(d))
    e = b.groupBy("_b").agg(F.min(d).alias("lo"), F.max(d).alias("hi"), F.ceil(F.count("*") / S.PART_VALUES).alias("k"))
    part = F.least(F.floor((d - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("k")), F.col("k") - 1)
    sizes = [r["count"] for r in b.join(e, "_b").groupBy("_b", part).count().collect()]
    assert max(sizes) <= 1.2 * S.PART_VALUES and len(sizes) >= n / S.PART_VALUES


def test_positions_with_infinities_and_nan(spark):
    values = [float("-inf"), -5.0, 0.0, 0.0, 1e-300, 3.0, float("inf"), float("nan")]
    hist = spark.createDataFrame([(v,) for v in values], "v double").groupBy("v").agg(F.count("*").alias("_c"))
    got = {str(r.v): r._below for r in S.positions(hist, "v").collect()}
    assert got == {"-inf": 0, "-5.0": 1, "0.0": 2, "1e-300": 4, "3.0": 5, "inf": 6, "nan": 7}


def test_keep_first_breaks_ties_by_arrays_and_structs(spark):
    df = spark.createDataFrame([(1, [2, 1], (5,), {"a": 1}), (1, [1, 9], (7,), {"b": 1}), (1, [1, 9], (6,), {"c": 1})],
                               "k int, a array<int>, s struct<x: int>, m map<string,int>")
    for _ in range(3):
        got = S.keep_first(df.repartition(3), ["k"], ["k"]).collect()
        assert [(r.a, r.s.x) for r in got] == [([1, 9], 6)]
