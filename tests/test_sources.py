import json
import os

from pyspark.sql import functions as F

from zonage.operators import spatial as G
from zonage.sources import geojson as GJ
from zonage.sources import readers as R


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_semicolon_bom_header(spark, tmpdir_fresh):
    p = write(os.path.join(tmpdir_fresh, "a.csv"), "﻿Identifiant;Nom ;Capacité\n1;Gare;12\n2;Parc;\n")
    df = R.read_delimited(spark, p, R.ReaderSpec(sep=";"))
    assert df.columns == ["Identifiant", "Nom", "Capacité"]
    assert [tuple(r) for r in df.collect()] == [("1", "Gare", "12"), ("2", "Parc", None)]


def test_cp1252_and_ragged_lines(spark, tmpdir_fresh):
    text = "Opérateur;Arrondissement;X\nOrange;75013;1\nSFR;75001;2;extra\nFree;75020\n"
    p = write(os.path.join(tmpdir_fresh, "ant.csv"), text, encoding="cp1252")
    df = R.read_source(spark, "antennas", p)
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("Free", "75020", None), ("Orange", "75013", "1")]
    assert R.resolve_column(df, [], contains="rateur") == "Opérateur"


def test_quoted_json_multiline(spark, tmpdir_fresh):
    shape = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]})
    body = 'id;geo_shape\n1;"' + shape.replace('"', '""') + '"\n'
    p = write(os.path.join(tmpdir_fresh, "g.csv"), body)
    df = R.read_source(spark, "green_spaces", p)
    assert json.loads(df.first().geo_shape)["type"] == "Polygon"


def test_pipe_pruned_and_year_from_file(spark, tmpdir_fresh):
    p1 = write(os.path.join(tmpdir_fresh, "ValeursFoncieres-2021.txt"), "a|b|c\n1|x|10,5\n")
    p2 = write(os.path.join(tmpdir_fresh, "ValeursFoncieres-2022.txt"), "a|b|c\n2|y|3\n")
    spec = R.ReaderSpec(sep="|", keep=["a", "c", "_file"], rename={"c": "valeur"})
    df = R.read_delimited(spark, [p1, p2], spec, with_file=True)
    got = sorted((r.a, r.valeur, r.y) for r in df.select("a", "valeur", R.year_from_file().alias("y")).collect())
    assert got == [("1", "10,5", 2021), ("2", "3", 2022)]


def test_yearly_columns(spark, tmpdir_fresh):
    p1 = write(os.path.join(tmpdir_fresh, "BASE_TD_FILO_IRIS_2019.csv"), "IRIS;DISP_MED19\n751010101;23450,5\n")
    p2 = write(os.path.join(tmpdir_fresh, "BASE_TD_FILO_IRIS_2020.csv"), "IRIS;DISP_MED20\n751010101;ns\n")
    df = R.read_yearly(spark, [p1, p2], R.ReaderSpec(sep=";"), "DISP_MED", "IRIS")
    assert sorted(tuple(r) for r in df.collect()) == [("751010101", 2019, "23450,5"), ("751010101", 2020, "ns")]


def test_coverage_names(spark):
    df = spark.createDataFrame([("2025_T4_couv_Metropole_BOUY_4G_data.parquet",)], "_file string")
    op, tech = R.coverage_layer_keys()
    assert tuple(df.select(op, tech).first()) == ("BOUY", "4G")


def test_positional_and_data_rows(spark):
    df = spark.createDataFrame([("Title", "x", "y"), ("codgeo", "a", "b"), ("75101", "3", "4")], "_c0 string, _c1 string, _c2 string")
    out = R.data_rows(R.positional(df, {0: "codgeo", 2: "n"}), "codgeo", r"^\d{5}$")
    assert [tuple(r) for r in out.collect()] == [("75101", "4")]


def test_geojson_zones(spark, tmpdir_fresh):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"code_iris": "751010101", "nom_iris": "A", "insee_com": 75101},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}},
        {"type": "Feature", "properties": {"code_iris": "751020101", "nom_iris": "B", "insee_com": 75102},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 0], [4, 0], [4, 2], [2, 2], [2, 0]]]]}},
        {"type": "Feature", "properties": {"code_iris": "920010101", "nom_iris": "C", "insee_com": 92001},
         "geometry": {"type": "Polygon", "coordinates": [[[9, 9], [10, 9], [10, 10], [9, 9]]]}},
    ]}
    p = write(os.path.join(tmpdir_fresh, "iris.geojson"), json.dumps(fc))
    zones = GJ.read_zones(spark, p)
    assert sorted((r.zone, r.district) for r in zones.collect()) == [("751010101", 1), ("751020101", 2)]
    edges = GJ.zone_edges(zones)
    assert edges.count() == 8
    area = {r.id: r.area for r in G.polygon_area(edges).collect()}
    assert area == {"751010101": 4.0, "751020101": 4.0}
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0)], "id int, x double, y double")
    got = {r.id: r.zone for r in G.points_in_zones(pts, edges, "x", "y", cell=2.0).collect()}
    assert got == {1: "751010101", 2: "751020101"}


def test_files_with_different_headers_are_joined_by_name(spark, tmpdir_fresh):
    paths = []
    for name, text in [("a.csv", "a|b\n1|2\n"), ("b.csv", "b|a\n2|1\n"), ("c.csv", "a|c\n5|6\n")]:
        paths.append(os.path.join(tmpdir_fresh, name))
        with open(paths[-1], "w") as f:
            f.write(text)
    got = R.read_delimited(spark, paths, R.ReaderSpec(sep="|"), with_file=True)
    assert sorted(map(tuple, got.select("a", "b", "c", "_file").collect()), key=str) == [
        ("1", "2", None, "a.csv"), ("1", "2", None, "b.csv"), ("5", None, "6", "c.csv")]


def test_yearly_column_is_exact_and_files_without_it_are_skipped(spark, tmpdir_fresh):
    paths = []
    for name, text in [("r_2018.csv", "IRIS;DISP_MED18;DISP_MED18_X\nz;10;99\n"), ("r_2019.csv", "IRIS;OTHER\nz;1\n"),
                       ("r_2020.csv", "IRIS;X_DISP_MED20;DISP_MED20\nz;98;20\n")]:
        paths.append(os.path.join(tmpdir_fresh, name))
        with open(paths[-1], "w") as f:
            f.write(text)
    got = R.read_yearly(spark, paths, R.ReaderSpec(sep=";"), "DISP_MED", "IRIS")
    assert sorted(map(tuple, got.collect())) == [("z", 2018, "10"), ("z", 2020, "20")]


def test_unknown_operator_codes_stand_for_themselves():
    known = {"OF": "Orange"}
    assert R.coverage_layer("/x/2025_T4_couv_Metropole_OF_4G_data.geojson", known) == ("Orange", "4G")
    assert R.coverage_layer("2025_T4_couv_Metropole_NEW_5G_data.geojson", known) == ("NEW", "5G")


def test_short_lines_with_separators_in_quotes_are_kept(spark, tmpdir_fresh):
    text = 'a;b;c\n"x;y;z;""q"";w";1\n1;2;3\n1;2;3;4\n"1;2";3;4;"5;6"\n"open;to;the;end\nm"id;7;8\n'
    p = write(os.path.join(tmpdir_fresh, "q.csv"), text, encoding="latin-1")
    df = R.read_delimited(spark, p, R.ReaderSpec(sep=";", encoding="ISO-8859-1", drop_long_lines=True))
    assert sorted(map(tuple, df.select("a", "b", "c").collect()), key=str) == sorted(
        [('x;y;z;"q";w', "1", None), ("1", "2", "3"), ("open;to;the;end", None, None), ('m"id', "7", "8")], key=str)


def blocks(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)


def whole_files(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_that_span_lines_are_read_in_blocks(spark, tmpdir_fresh):
    import random
    r = random.Random(4)
    paths = []
    for k in range(3):
        rows = []
        for i in range(400):
            shape = json.dumps({"type": "Polygon", "id": f"{k}-{i}", "coordinates": [[r.random() for _ in range(r.randrange(9))]]},
                               indent=r.choice([None, None, 2]))
            note = r.choice(["", "plain", 'say ""hi""', "a;b", "two\nlines", "x\n\n\ny"])
            rows.append(f'{i};"{shape.replace(chr(34), chr(34) * 2)}";"{note}"' if r.random() < 0.9 else f"{i};none;")
            if r.random() < 0.02:
                rows.append("")
        paths.append(write(os.path.join(tmpdir_fresh, f"g{k}.csv"), "﻿id;geo_shape;note\n" + "\n".join(rows) + "\n"))
    spec = R.ReaderSpec(sep=";", multiline=True)
    whole = (spark.read.option("sep", ";").option("header", "true").option("quote", '"').option("escape", '"')
             .option("multiLine", "true").schema("id string, geo_shape string, note string").csv(paths))
    want = sorted(map(tuple, whole.collect()), key=str)
    assert len(want) == 1200
    blocks(spark, 2000)
    try:
        got = R.read_delimited(spark, paths, spec, with_position=True, with_file=True)
        assert spark.read.text(paths).rdd.getNumPartitions() > 20
        assert sorted((r.id, r.geo_shape, r.note) for r in got.collect()) == sorted(want) if None not in [x for w in want for x in w] \
            else sorted(((r.id, r.geo_shape, r.note) for r in got.collect()), key=str) == want
        for k in range(3):  # in order of position, a file's rows are in its own order
            ids = [int(r.id) for r in got.filter(F.col("_file") == f"g{k}.csv").orderBy("_pos").collect()]
            assert ids == list(range(400))
    finally:
        whole_files(spark)
    assert R.read_delimited(spark, write(os.path.join(tmpdir_fresh, "e.csv"), "a;b\n"), spec).collect() == []


def test_position_orders_rows_as_in_the_files(spark, tmpdir_fresh):
    from zonage.operators import score as S
    for name in ("b", "a"):
        write(os.path.join(tmpdir_fresh, f"{name}.csv"), "k;v\n" + "".join(f"{i % 50};{name}{i:05d}\n" for i in range(2000)))
    paths = [os.path.join(tmpdir_fresh, f"{n}.csv") for n in ("b", "a")]
    blocks(spark, 1000)
    try:
        df = R.read_delimited(spark, paths, R.ReaderSpec(sep=";"), with_position=True)
        first = S.keep_first(df, ["k"], ["_pos"]).drop("_pos")
        assert df.rdd.getNumPartitions() > 10
        assert sorted(map(tuple, first.collect())) == sorted((str(i), f"a{i:05d}") for i in range(50))
    finally:
        whole_files(spark)


def layer(n, spaced=False, order=("type", "properties", "geometry")):
    feats = [{"type": "Feature", "properties": {"niveau": f"N{i}", "n": i, "s": "a \"Feature of\" it"},
              "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]}} for i in range(n)]
    doc = {"type": "FeatureCollection", "name": "x", "features": [{k: f[k] for k in order} for f in feats], "crs": {"type": "name"}}
    return json.dumps(doc, indent=1 if spaced else None, separators=None if spaced else (",", ":"))


def test_layers_are_read_in_blocks(spark, tmpdir_fresh):
    tight = write(os.path.join(tmpdir_fresh, "2025_T4_couv_Metropole_OF_4G_data.geojson"), layer(300))
    spaced = write(os.path.join(tmpdir_fresh, "2025_T4_couv_Metropole_SFR_5G_data.geojson"), layer(200, spaced=True))
    other = write(os.path.join(tmpdir_fresh, "2025_T4_couv_Metropole_BOUY_5G_data.geojson"),
                  layer(7, order=("geometry", "properties", "type")))
    one = write(os.path.join(tmpdir_fresh, "2025_T4_couv_Metropole_FREE_5G_data.geojson"), layer(1))
    blocks(spark, 4000)
    try:
        got = GJ.read_coverage_layers(spark, [tight, spaced, other, one])
        assert got.rdd.getNumPartitions() > 8
        rows = got.collect()
        assert sorted((r.op_code, r.techno, r.niveau, r.coords[0][0][0][0]) for r in rows) == sorted(
            (op, t, f"N{i}", float(i)) for op, t, n in (("OF", "4G", 300), ("SFR", "5G", 200), ("BOUY", "5G", 7), ("FREE", "5G", 1))
            for i in range(n))
        assert len({r.id for r in rows}) == 508
    finally:
        whole_files(spark)


def test_a_value_that_looks_like_a_feature_is_an_error(spark, tmpdir_fresh):
    import pytest
    text = layer(3).replace('"N1"', '"Feature"')
    p = write(os.path.join(tmpdir_fresh, "x.geojson"), text)
    with pytest.raises(Exception, match="Feature"):
        GJ.read_features(spark, p).collect()


def test_integers_beyond_64_bits_are_null(spark):
    from zonage.functions import clean as C
    texts = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "12.0", "12.5", " 7 ",
             "1e3", "1e19", "9007199254740993", "x", None, "+5"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.to_int("t")).collect()]
    assert got == [2 ** 63 - 1, None, -2 ** 63, None, 12, None, 7, 1000, None, 9007199254740993, None, None, 5]
