import random
import statistics

from pyspark.sql import functions as F

from zonage.operators import agg as A


def test_exact_median_matches_python(spark):
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 10_000))) for _ in range(4001)] + \
           [("even", v) for v in (1.0, 2.0, 3.0, 10.0)] + [("one", 5.0)] + [("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in A.exact_median(df, "g", "v").collect()}
    for g in ("hot", "even", "one"):
        assert got[g] == statistics.median([v for gg, v in rows if gg == g])
    assert "nulls" not in got


def test_exact_median_global(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 4, 2]], "v double")
    assert A.exact_median(df, [], "v").first().median == 3.0


def test_mode_tie_smallest_and_nulls(spark):
    df = spark.createDataFrame([("d", "b"), ("d", "a"), ("d", "b"), ("d", "a"), ("e", None)], "k string, v string")
    got = {r.k: r.v for r in A.mode_by(df, "k", "v").collect()}
    assert got == {"d": "a"}


def test_argmax_ties_alphabetical(spark):
    df = spark.createDataFrame([("z", "SFR", 5.0), ("z", "Free", 5.0), ("z", "Orange", 1.0)],
                               "z string, op string, s double")
    assert A.argmax(df, "z", "s", "op").first().op == "Free"


def test_dominant_is_largest_fragment(spark):
    df = spark.createDataFrame([("z", "BC", 3.0), ("z", "TBC", 2.0), ("z", "TBC", 2.0)],
                               "z string, lvl string, area double")
    assert A.dominant(df, "z", "area", "lvl").first().lvl == "BC"


def test_rate_and_sum_or_zero(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", None)], "k string, ok int")
    got = {r.k: (r.r, r.s) for r in df.groupBy("k").agg(
        A.rate(F.col("ok") == 1).alias("r"), A.sum_or_zero("ok").alias("s")).collect()}
    assert got == {"a": (50.0, 1), "b": (0.0, 0)}


def test_impute_median(spark):
    df = spark.createDataFrame([(1,), (9999,), (3,), (None,)], "y int")
    got = [r.y for r in A.impute_median(df, "y", sentinel=9999).collect()]
    assert sorted(got) == [1.0, 2.0, 2.0, 3.0]


def test_exact_median_hot_group_path_equals_direct(spark):
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(2001)] + \
           [("cold", float(v)) for v in (4, 1, 3, 2)]
    df = spark.createDataFrame(rows, "g string, v double")
    direct = {r.g: r.median for r in A.exact_median(df, "g", "v").collect()}
    bucketed = {r.g: r.median for r in A.exact_median(df, "g", "v").collect()}
    assert direct == bucketed == {"hot": statistics.median([v for g, v in rows if g == "hot"]), "cold": 2.5}
    glob = A.exact_median(df, [], "v").first().median
    assert glob == statistics.median([v for _, v in rows])
