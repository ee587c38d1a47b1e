from zonage.operators import temporal as TM


def years(spark, ys):
    return spark.createDataFrame([(y,) for y in ys], "y int")


def test_nearest_map_ties(spark):
    t, a = years(spark, [2019, 2020, 2021, 2030]), years(spark, [2018, 2020, 2022])
    earlier = {r.target: r.year for r in TM.nearest_year_map(t, a, "earlier").collect()}
    later = {r.target: r.year for r in TM.nearest_year_map(t, a, "later").collect()}
    assert earlier == {2019: 2018, 2020: 2020, 2021: 2020, 2030: 2022}
    assert later == {2019: 2020, 2020: 2020, 2021: 2022, 2030: 2022}


def test_nearest_map_empty(spark):
    assert TM.nearest_year_map(years(spark, [2020]), years(spark, [])).count() == 0


def test_resolve_year(spark):
    a = years(spark, [2018, 2020])
    assert TM.resolve_year(a, "y", 2019, "later").first().year == 2020
    assert TM.resolve_year(a, "y", 2019, "earlier").first().year == 2018
    assert TM.resolve_year(years(spark, []), "y", 2019).count() == 0


def test_nearest_year_join_and_fallback(spark):
    left = spark.createDataFrame([("z1", 2021, 10.0), ("z2", 2021, 20.0)], "zone string, annee int, inc double")
    right = spark.createDataFrame([("z1", 2019, 1.0), ("z1", 2023, 3.0)], "zone string, annee int, px double")
    got = TM.exact_or_nearest(left, right, ["zone"], "annee").collect()
    assert [(r.zone, r.annee, r.px) for r in got] == [("z1", 2021, 1.0)]
    right2 = spark.createDataFrame([("z1", 2021, 5.0)], "zone string, annee int, px double")
    got2 = TM.exact_or_nearest(left, right2, ["zone"], "annee").collect()
    assert [(r.zone, r.px) for r in got2] == [("z1", 5.0)]


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, y int")
    assert sorted(tuple(r) for r in TM.latest_snapshot(df, "y", ["k"]).collect()) == [("a", 3), ("b", 2)]
    assert [tuple(r) for r in TM.latest_snapshot(df, "y").collect()] == [("a", 3)]
