from pyspark.sql import functions as F

from zonage.functions import clean as C


def one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_to_number_traps(spark):
    got = one(spark, ["ns", "nd", "", None, "12,5", "1d", "NaN", "75001.0", " 3.5 ", "-2e3"], C.to_number)
    assert got == [None, None, None, None, None, None, None, 75001.0, 3.5, -2000.0]


def test_to_int_goes_through_double(spark):
    assert one(spark, ["12.0", "12.5", "x", "7"], C.to_int) == [12, None, None, 7]


def test_comma_decimal(spark):
    assert one(spark, ["1042000,00", "45,3", "ns"], C.comma_decimal) == [1042000.0, 45.3, None]


def test_lat_lon_variants(spark):
    df = spark.createDataFrame([(v,) for v in ["48.85, 2.35", "48.85,2.35", "48.85", "a,b", "1,2,3", None]], "v string")
    lat, lon = C.lat_lon("v")
    rows = [tuple(r) for r in df.select(lat, lon).collect()]
    assert rows == [(48.85, 2.35), (48.85, 2.35), (None, None), (None, None), (None, None), (None, None)]


def test_ordinals_and_labels(spark):
    assert one(spark, ["1er", "2e", "11ème", "TOTAL"], C.ordinal) == [1, 2, 11, None]
    assert one(spark, ["PARIS 20E ARRDT", "Paris 1er Arrondissement", "TOTAL", "BOIS DE VINCENNES"],
               C.first_number) == [20, 1, None, None]


def test_code_to_district(spark):
    assert one(spark, ["75001", "75116", "75020.0"], lambda c: C.code_to_district(c, "postal")) == [1, 16, 20]
    assert one(spark, ["75116"], lambda c: C.code_to_district(c, "postal", keep_116=True)) == [116]
    assert one(spark, ["75101", "75120"], lambda c: C.code_to_district(c, "insee")) == [1, 20]
    assert one(spark, ["751010205"], lambda c: C.code_to_district(c, "zone")) == [1]


def test_canonical_operator(spark):
    got = one(spark, [" Bouygues Telecom", "FREE mobile", "orange", "sfr", "la-poste mobile", None], C.canonical)
    assert got == ["Bouygues", "Free", "Orange", "SFR", "La-Poste Mobile", None]


def test_clip_keeps_null(spark):
    assert one(spark, [None, -5.0, 50.0, 150.0], C.clip, "double") == [None, 0.0, 50.0, 100.0]


def test_round_dec_and_half_even(spark):
    assert one(spark, [0.125, 2.675, -1.5], lambda c: C.round_dec(c, 2), "double") == [0.13, 2.68, -1.5]
    assert one(spark, [0.125, 2.5], lambda c: C.round_half_even(c, 0), "double") == [0.0, 2.0]


def test_safe_div_and_per_10k(spark):
    df = spark.createDataFrame([(1, 0), (5, 10)], "a int, b int")
    assert [r[0] for r in df.select(C.safe_div("a", "b")).collect()] == [None, 0.5]
    assert [r[0] for r in df.select(C.per_10k("a", "b")).collect()] == [None, 5000.0]


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "x double")
    assert [r[0] for r in C.sanitize(df).collect()] == [None, None, 1.0]


def test_row_id_null_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    ids = [r[0] for r in df.select(C.row_id("x", "y", "z")).collect()]
    assert ids[0] != ids[1]


def test_band_and_labels(spark):
    assert one(spark, [3.0, 7.0, 12.0, None], C.band, "double") == ["Bon", "Moyen", "Faible", None]
    assert one(spark, [1, 11], C.district_label, "int") == ["1er", "11e"]
    assert one(spark, [7], C.district_zone_prefix, "int") == ["75107"]


def test_values_beyond_their_type_are_null_or_kept(spark):
    df = spark.createDataFrame([("12345678901", 1e30), ("75012345678901", -1.005), (None, None)], "s string, x double")
    got = df.select(C.first_number("s").alias("n"), C.code_to_district("s").alias("p"), C.code_to_district("s", "insee").alias("i"),
                    C.code_to_district("s", "last2").alias("l"), C.round_dec("x", 2).alias("r"),
                    C.round_half_even("x", 2).alias("h")).collect()
    assert [r.n for r in got] == [None, None, None] and [r.p for r in got] == [None, None, None]
    assert got[0].r == 1e30 and got[0].h == 1e30 and got[1].r == -1.01 and got[2].r is None


def test_gauge(spark):
    df = spark.createDataFrame([(4.0,), (5.0,), (9.0,), (10.0,), (30.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.gauge("x")).collect()] == [68.0, 70.0, 46.0, 50.0, 10.0, None]
