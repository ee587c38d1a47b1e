"""A tiny city end to end: landing files -> silver -> gold -> serving, run
through the layered runner in canonical order."""

import json
import os

from pyspark.sql import functions as F

from zonage.plans import environment as ENV
from zonage.plans import mobility as MOB
from zonage.plans import runner as RUN
from zonage.plans import serving as SV
from zonage.sources import geojson as GJ
from zonage.sources import readers as R


def _square(x0, y0, d=0.01):
    return [[[x0, y0], [x0 + d, y0], [x0 + d, y0 + d], [x0, y0 + d], [x0, y0]]]


def write_city(base):
    feats = []
    for i, (x0, y0) in enumerate([(2.30, 48.85), (2.31, 48.85), (2.30, 48.86), (2.31, 48.86)]):
        feats.append({"type": "Feature",
                      "properties": {"code_iris": f"75101010{i}", "nom_iris": f"Z{i}", "insee_com": 75101 + i // 2, "dep": "75"},
                      "geometry": {"type": "Polygon", "coordinates": _square(x0, y0)}})
    with open(os.path.join(base, "iris.geojson"), "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f)
    w = lambda name, text: open(os.path.join(base, name), "w", encoding="utf-8").write(text)
    w("arbres.csv", "IDBASE;ARRONDISSEMENT;geo_point_2d\n1;PARIS 1ER ARRDT;48.855, 2.305\n"
                    "2;PARIS 1ER ARRDT;48.856, 2.306\n3;BOIS DE VINCENNES;48.865, 2.315\n4;PARIS 2E ARRDT;bad\n")
    shape = json.dumps({"type": "Polygon", "coordinates": _square(2.3095, 48.8545, 0.001)}).replace('"', '""')
    w("espaces_verts.csv", "Identifiant espace vert;Nom de l'espace vert;Code postal;Superficie totale réelle;"
                           "Année de l'ouverture;Geo Shape\n"
                           f'10;Square;75001;1200.5;9999;"{shape}"\n')
    w("arrets.csv", "﻿ArRId;ArRName;ArRType;ArRGeopoint\n1;A;bus;48.855, 2.305\n2;B;bus;48.865, 2.315\n"
                    "2;B bis;bus;48.865, 2.315\n3;C;metro;48.855, 2.315\n")
    w("gares.csv", "﻿gares_id;nom_long;mode;res_com;exploitant;idf;Geo Point\n"
                   "7;Gare;METRO;M1;RATP;1;48.855, 2.315\n8;Loin;RER;A;RATP;0;48.0, 2.0\n")
    w("velib.csv", "﻿Identifiant station;Nom de la station;Capacité de la station;Coordonnées géographiques\n"
                   "s1;V1;30;48.865, 2.305\n")


def test_city_end_to_end(spark, tmpdir_fresh):
    base = tmpdir_fresh
    write_city(base)
    ctx = {}

    def silver(spark, c):
        zones = GJ.read_zones(spark, os.path.join(base, "iris.geojson"))
        c["zones"] = zones.drop("coords")
        # lon/lat zone edges; cell of ~ one zone
        c["edges"] = GJ.zone_edges(zones)
        c["trees"] = ENV.trees_silver(R.read_source(spark, "trees", os.path.join(base, "arbres.csv")),
                                      c["edges"], c["zones"])
        c["green"] = ENV.green_spaces_silver(R.read_source(spark, "green_spaces",
                                                           os.path.join(base, "espaces_verts.csv")), c["edges"], 0.01)
        c["stops"] = MOB.stops_silver(R.read_source(spark, "stops", os.path.join(base, "arrets.csv")),
                                      c["edges"], c["zones"])
        c["stations"] = MOB.stations_silver(R.read_source(spark, "rail_stations", os.path.join(base, "gares.csv")),
                                            c["edges"], c["zones"])
        c["bikes"] = MOB.bikes_silver(R.read_source(spark, "bike_stations", os.path.join(base, "velib.csv")),
                                      c["edges"], c["zones"])

    def gold(spark, c):
        empty = spark.createDataFrame([], "id string, code_iris string")
        c["env"] = ENV.environment_score(c["zones"], c["trees"], c["green"], empty, empty)
        c["mob"] = MOB.mobility_score(c["zones"], c["stops"], c["stations"], c["bikes"])

    def serving(spark, c):
        y = spark.createDataFrame([], "code_iris string, annee int, nb_logements_sociaux_finances int")
        s = spark.createDataFrame([], "code_iris string, annee int, revenu_median double, prix_m2_median double, iai double")
        n = spark.createDataFrame([], "code_iris string, score_final_stocke double, meilleur_operateur_mobile string, "
                                      "meilleur_operateur_fibre string")
        c["wide"] = SV.zone_indicators(c["zones"], y, s, c["env"], n, c["mob"], 2025)

    done = RUN.run(spark, ["serving", "silver", "gold"],
                   {"silver": [("all", silver)], "gold": [("scores", gold)], "serving": [("zones", serving)]}, ctx)
    assert done == ["silver.all", "gold.scores", "serving.zones"]

    trees = {r.id: (r.code_iris, r.arrondissement) for r in ctx["trees"].collect()}
    assert trees[1] == ("751010100", 1) and 3 not in trees and trees[4] == (None, 2)   # 3: no city tree
    green = ctx["green"].collect()
    # the square straddles zones 0 and 1: intersects attaches it to both; the
    # 9999 opening year is unknown and there is no other year to impute from
    assert sorted((r.id, r.code_iris, r.annee) for r in green) == [(10, "751010100", None), (10, "751010101", None)]
    assert ctx["stops"].filter(F.col("arret_id") == 2).count() == 1     # duplicate stop collapsed
    assert ctx["stations"].count() == 1                                 # outside the region filtered
    wide = {r.code_iris: r for r in ctx["wide"].collect()}
    assert len(wide) == 4 and wide["751010100"].score_environnemental > wide["751010102"].score_environnemental
    assert wide["751010100"].nb_logements_sociaux_finances == 0
    ranks = sorted(r.rang_mobilite for r in ctx["mob"].collect())
    assert ranks[0] == 1 and len(ranks) == 4


def test_default_wiring_idempotent(spark, tmpdir_fresh):
    base = tmpdir_fresh
    write_city(base)
    paths = {"zones": os.path.join(base, "iris.geojson"), "trees": os.path.join(base, "arbres.csv"),
             "green_spaces": os.path.join(base, "espaces_verts.csv"), "stops": os.path.join(base, "arrets.csv"),
             "rail_stations": os.path.join(base, "gares.csv"), "bike_stations": os.path.join(base, "velib.csv")}
    wh = os.path.join(base, "warehouse")
    steps = RUN.default_steps(paths, wh, 0.01)
    first = {}
    RUN.run(spark, ["silver", "gold", "serving"], steps, first)
    snap1 = sorted(tuple(r) for r in first["zone_indicators"].collect())
    trees1 = first["trees"].count()
    second = {}
    RUN.run(spark, ["silver", "gold", "serving"], RUN.default_steps(paths, wh, 0.01), second)
    assert second["trees"].count() == trees1 == 3            # re-run appends nothing
    assert second["stops"].count() == 2                      # insert-ignore keeps one row per stop
    assert sorted(tuple(r) for r in second["zone_indicators"].collect()) == snap1
    from zonage.plans import contracts
    broken = {(r.table, r.rule) for r in contracts.report(spark, wh).collect()}
    assert not {(t, r) for t, r in broken if r in ("primary_key", "unique", "not_null", "type")}, broken


def write_housing(base):
    from zonage.plans import housing as H
    header = "|".join(H.SALES_COLUMNS)
    rows = [["1", "03/01/2022", "Vente", "500000,00", "3", "RUE", "DE RIVOLI", "75001", "PARIS 01", "75", "101", "AB",
             "12", "2", "Appartement", "50", "2", ""],
            ["1", "04/05/2022", "Vente", "330000,00", "5", "RUE", "DU LOUVRE", "75001", "PARIS 01", "75", "101", "AB",
             "13", "2", "Appartement", "30", "1", ""]]
    with open(os.path.join(base, "ValeursFoncieres-2022.txt"), "w") as f:
        f.write(header + "\n" + "\n".join("|".join(r) for r in rows) + "\n")
    with open(os.path.join(base, "adresses.csv"), "w") as f:
        f.write("adresse;postcode;latitude;longitude\n3 RUE DE RIVOLI;75001;48.855;2.305\n5 RUE DU LOUVRE;75001;48.856;2.306\n")
    with open(os.path.join(base, "BASE_TD_FILO_IRIS_2022.csv"), "w") as f:
        f.write("IRIS;DISP_MED22\n751010100;24000\n751010101;ns\n")
    with open(os.path.join(base, "logements_sociaux.csv"), "w", encoding="utf-8") as f:
        f.write("﻿Identifiant livraison;Année du financement - agrément;Nombre total de logements financés;"
                "Dont nombre de logements PLA I;Arrondissement;geo_point_2d\nL1;2022;12;4;1;48.855, 2.305\n")


def test_default_wiring_housing(spark, tmpdir_fresh):
    base = tmpdir_fresh
    write_city(base)
    write_housing(base)
    paths = {"zones": os.path.join(base, "iris.geojson"),
             "sales": os.path.join(base, "ValeursFoncieres-2022.txt"),
             "addresses": os.path.join(base, "adresses.csv"),
             "income": os.path.join(base, "BASE_TD_FILO_IRIS_2022.csv"),
             "social_housing": os.path.join(base, "logements_sociaux.csv"),
             "trees": os.path.join(base, "arbres.csv")}
    ctx = {"year": 2022}
    RUN.run(spark, ["silver", "gold", "serving"], RUN.default_steps(paths, os.path.join(base, "wh"), 0.01), ctx)
    prices = {(r.code_iris, r.annee): r for r in ctx["prices"].collect()}
    assert prices[("751010100", 2022)].prix_m2_median == 10500.0 and prices[("751010100", 2022)].nb_transactions == 2
    socio = {r.code_iris: r for r in ctx["socio"].collect()}
    assert socio["751010100"].iai == round(10500.0 / (24000 / 12), 4)
    z = {r.code_iris: r for r in ctx["zone_indicators"].collect()}
    assert z["751010100"].nb_logements_sociaux_finances == 12 and z["751010100"].iai == socio["751010100"].iai
    assert z["751010101"].revenu_median is None


def write_education(base):
    w = lambda name, text: open(os.path.join(base, name), "w", encoding="utf-8").write(text)
    w("effectifs.csv", "﻿Code département;Rentrée scolaire;Code Postal;Numéro de l'école;Patronyme;"
                       "Dénomination principale;Secteur;Nombre total d'élèves\n"
                       "75;2024;75001;E1;A;Elem;Public;200\n75;2024;75002;E2;B;Elem;Public;100\n")
    w("colleges.csv", "﻿Année scolaire;Libellé établissement;Adresse;Type établissement;Arrondissement;geo_point_2d\n"
                      "2024;C1;1 rue A;College;1er;48.855, 2.305\n2024;C2;2 rue B;College;2e;48.865, 2.305\n"
                      "2024;C3;3 rue C;College;2e;48.866, 2.306\n")
    w("hopitaux.csv", "﻿FINESS_ET;RAISON_SOCIALE;ADRESSE_COMPLETE;NUM_TEL;CATEGORIE_DE_L_ETABLISSEMENT;"
                      "TYPE_ETABLISSEMENT;CP_VILLE;lat;lng\nF1;H1;x;0;c;t;75001 PARIS;48.855;2.305\n")
    w("population.csv", "Arrondissement,Population\nParis 1er Arrondissement,10000\nParis 2e Arrondissement,20000\nTOTAL,30000\n")
    w("ages.csv", "INSEE;F3-5;F6-10;F11-17;H3-5;H6-10;H11-17\n75101;100;200;150;100;200;150\n75102;50;50;100;50;50;100\n")
    cells = [["Titre"] + [""] * 55, ["codgeo"] + ["x"] * 55,
             ["75101"] + ["1"] * 8 + ["2"] + ["1"] * 24 + ["30"] + ["1"] * 15 + ["20"] + ["1"] * 4 + ["5"],
             ["75102"] + ["1"] * 8 + ["1"] + ["1"] * 24 + ["10"] + ["1"] * 15 + ["10"] + ["1"] * 4 + ["5"]]
    w("bpe.csv", "\n".join(";".join(r) for r in cells) + "\n")


def test_default_wiring_education(spark, tmpdir_fresh):
    base = tmpdir_fresh
    write_city(base)
    write_education(base)
    paths = {"zones": os.path.join(base, "iris.geojson"), "trees": os.path.join(base, "arbres.csv"),
             "school_headcounts": os.path.join(base, "effectifs.csv"), "colleges": os.path.join(base, "colleges.csv"),
             "hospitals": os.path.join(base, "hopitaux.csv"), "district_population": os.path.join(base, "population.csv"),
             "age_structure": os.path.join(base, "ages.csv"), "health_equipment": os.path.join(base, "bpe.csv")}
    ctx = {}
    RUN.run(spark, ["silver", "gold", "serving"], RUN.default_steps(paths, os.path.join(base, "wh"), 0.01), ctx)
    aes = {r.arrondissement: r for r in ctx["aes"].collect()}
    assert set(aes) == {1, 2}
    # E1: 200/600 vs 100/200 -> district 2 best; E2: 1/300 vs 2/200 -> district 2 best
    assert aes[2].score_education == 1.0 and aes[1].score_education == 0.0
    d = {r.arrondissement: r for r in ctx["district_indicators"].collect()}
    assert set(d) == {1, 2} and d[1].score_aes == aes[1].score_aes
    assert ctx["population"].count() == 2                  # TOTAL row dropped


def write_network(base):
    def layer(name, polys):
        fc = {"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"niveau": lvl}, "geometry": {"type": "Polygon", "coordinates": c}}
            for lvl, c in polys]}
        with open(os.path.join(base, name), "w") as f:
            json.dump(fc, f)
        return os.path.join(base, name)
    full0 = [[[2.2999, 48.8499], [2.3101, 48.8499], [2.3101, 48.8601], [2.2999, 48.8601], [2.2999, 48.8499]]]
    half1 = [[[2.31, 48.85], [2.315, 48.85], [2.315, 48.86], [2.31, 48.86], [2.31, 48.85]]]
    a = layer("2025_T4_couv_Metropole_OF_4G_data.geojson", [("TBC", full0)])
    b = layer("2025_T4_couv_Metropole_SFR0_5G_data.geojson", [("BC", half1)])
    with open(os.path.join(base, "antennes.csv"), "w", encoding="cp1252") as f:
        f.write("Opérateur;Arrondissement\nOrange;75101\nSFR;75101\nSFR;75102\nInconnu;75101\n")
    with open(os.path.join(base, "fibre.csv"), "w") as f:
        f.write("x,y,code_poste,imb_etat,pm_etat,code_l331\n2.305,48.855,75001,deploye,deploye,FRTE\n"
                "2.315,48.855,75001,en cours,deploye,SFR0\n")
    with open(os.path.join(base, "qos.csv"), "w", encoding="latin-1") as f:
        f.write("insee_com;operator;bitrate_dl;Result;latitude_start;longitude_start\n"
                "75056;Orange;80,5;Success;48.855;2.305\n75056;orange;20;Failure;48.855;2.306\n"
                "92012;SFR;10;Success;48.855;2.305\n")
    return ",".join([a, b])


def test_default_wiring_network(spark, tmpdir_fresh):
    base = tmpdir_fresh
    write_city(base)
    cov = write_network(base)
    paths = {"zones": os.path.join(base, "iris.geojson"), "trees": os.path.join(base, "arbres.csv"),
             "coverage": cov, "antennas": os.path.join(base, "antennes.csv"),
             "fibre": os.path.join(base, "fibre.csv"), "qos": os.path.join(base, "qos.csv")}
    ctx = {}
    RUN.run(spark, ["silver", "gold", "serving"], RUN.default_steps(paths, os.path.join(base, "wh"), 0.01), ctx)
    mob = {(r.code_iris, r.operateur): r for r in ctx["mobile"].collect()}
    assert mob[("751010100", "Orange")].couv_4g == 100.0 and mob[("751010100", "Orange")].score_niveau == 100
    assert abs(mob[("751010101", "SFR")].couv_5g - 50.0) < 0.5 and mob[("751010101", "SFR")].score_niveau == 60
    assert mob[("751010103", "Orange")].couv_4g == 0.01                 # genuine 0.0001° x 0.0001° corner overhang
    assert mob[("751010100", "SFR")].couv_5g == 0.0                     # shares only an edge: every zone gets every layer
    q = {r.code_iris: r for r in ctx["quality"].collect()}
    assert set(q) == {"751010100"} and q["751010100"].score_fiabilite == 50.0
    net = {r.code_iris: r for r in ctx["net"].collect()}
    assert len(net) == 4 and net["751010100"].rang_reseau == 1
    assert net["751010101"].score_qualite == q["751010100"].score_qualite   # filled from its neighbour
    z = {r.code_iris: r for r in ctx["zone_indicators"].collect()}
    assert z["751010100"].score_reseau == net["751010100"].score_final_stocke


def test_school_map_zone_population_and_documents(spark, tmpdir_fresh):
    base = tmpdir_fresh
    write_city(base)
    write_education(base)
    w = lambda name, text: open(os.path.join(base, name), "w", encoding="utf-8").write(text)
    w("ecoles.csv", "Année scolaire;Libellé établissement;Adresse;Type établissement;Arrondissement;geo_point_2d\n"
                    "2024;Z first;9 rue E;Elementaire;1er;48.855, 2.305\n2024;A second;9 rue E;Elementaire;1er;48.856, 2.305\n"
                    "2023;Old;8 rue E;Elementaire;1er;48.855, 2.305\n")
    w("pop_iris.csv", "IRIS;P22_POP;P22_POP0305;P22_POP0610;P22_POP1117\n751010100;1000;50;60;80\n751010101;x;1;1;1\n920010101;9;9;9;9\n")
    with open(os.path.join(base, "arr.geojson"), "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"c_arinsee": 75101, "l_ar": "1er"}, "geometry": {"type": "Polygon", "coordinates": _square(2.3, 48.85)}}]}, f)
    paths = {"zones": os.path.join(base, "iris.geojson"), "schools": os.path.join(base, "ecoles.csv"),
             "colleges": os.path.join(base, "colleges.csv"), "zone_population": os.path.join(base, "pop_iris.csv")}
    wh = os.path.join(base, "wh")

    def silver():
        ctx = {}
        steps = [s for s in RUN.default_steps(paths, wh, 0.01)["silver"] if s[0] in ("zones", "education")]
        RUN.run(spark, ["silver"], {"silver": steps}, ctx)
        return ctx
    ctx = silver()
    schools = {r.nom: r for r in ctx["schools"].collect()}
    assert set(schools) == {"Z first", "C1", "C2", "C3"}          # the first of the file per address, the latest year only
    assert schools["Z first"].nom_iris == "Z0" and schools["C1"].arrondissement == 1
    assert [(r.code_iris, r.pop_3_10) for r in ctx["zone_population"].collect()] == [("751010100", 110.0)]
    assert ctx["metrics"]["silver/map_scolaire"]["loaded"] == 4
    again = silver()
    assert {k: m["loaded"] for k, m in again["metrics"].items()} == {k: 0 for k in again["metrics"]}   # a second run writes nothing
    docs = {r._id: json.loads(r.feature) for r in SV.features(again["zones"]).collect()}
    assert docs["751010100"]["geometry"]["coordinates"] == _square(2.30, 48.85) and docs["751010100"]["properties"]["name"] == "Z0"
    (d,) = SV.district_features(GJ.read_districts(spark, os.path.join(base, "arr.geojson"))).collect()
    assert d._id == "75101" and json.loads(d.feature)["properties"] == {"c_arinsee": 75101, "l_ar": "1er"}


def test_rows_that_share_an_id_keep_their_own_shapes(spark):
    from zonage.operators import spatial as G
    coords = spark.createDataFrame([("zA", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]]),
                                    ("zB", [[[[5.0, 0.0], [6.0, 0.0], [6.0, 1.0], [5.0, 1.0]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    ze = G.polygon_edges(coords, "zone", "coords")
    box = lambda x: json.dumps({"type": "Polygon", "coordinates": _square(x + 0.2, 0.2, 0.3)})
    raw = spark.createDataFrame([(1, "a", box(0)), (1, "b", box(5)), (2, "c", box(0)), (3, "d", None)], "id int, nom string, geo_shape string")
    for predicate in ("intersects", "within"):
        got = sorted((r.nom, r.code_iris) for r in ENV.polygons_in_zones(raw, ze, predicate, 1.0).collect())
        assert got == [("a", "zA"), ("b", "zB"), ("c", "zA")], predicate


def test_stops_without_a_number_are_dropped(spark):
    from zonage.operators import spatial as G
    zones = spark.createDataFrame([("z1", "Z1", 1)], "zone string, name string, district int")
    coords = spark.createDataFrame([("z1", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    raw = spark.createDataFrame([(i, "n", "bus", "0.5, 0.5") for i in ("1", "x", "y")],
                                "ArRId string, ArRName string, ArRType string, ArRGeopoint string")
    edges = G.polygon_edges(coords, "zone", "coords")
    assert [r.arret_id for r in MOB.stops_silver(raw, edges, zones).collect()] == [1]
    seen = spark.createDataFrame([(1,)], "arret_id long")
    assert MOB.stops_silver(raw, edges, zones, seen).count() == 0
