import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonage.operators import load as L
from zonage.plans import environment as ENV
from zonage.plans import mobility as MOB
from zonage.plans import network as NET
from zonage.plans import runner as RUN
from zonage.streaming import ingest as ST


def zones(spark):
    return spark.createDataFrame([("751010101", "A", 1), ("751010102", "B", 1), ("751020101", "C", 2)],
                                 "zone string, name string, district int")


def test_environment_score(spark):
    z = zones(spark)
    trees = spark.createDataFrame([(1, "751010101"), (2, "751010101"), (3, None)], "id int, code_iris string")
    green = spark.createDataFrame([(1, "751010102", 100.0)], "id int, code_iris string, superficie double")
    isl = spark.createDataFrame([("x", "751010101"), ("x", "751010101")], "id string, code_iris string")
    st = spark.createDataFrame([(9, "751020101")], "id int, code_iris string")
    got = {r.code_iris: r.score for r in ENV.environment_score(z, trees, green, isl, st).collect()}
    # pct ranks: trees (2,0,0) -> A 1.0, B/C 0.5; green (0,100,0) -> B 1.0; islands (1,0,0); stations (0,0,1)
    # A = .3*1 + .4*.5 + .2*1 + .1*.5; B = .3*.5 + .4*1 + .2*.5 + .1*.5; C = .3*.5 + .4*.5 + .2*.5 + .1*1
    assert got == {"751010101": 0.75, "751010102": 0.7, "751020101": 0.55}


def test_mobility_score_rank(spark):
    z = zones(spark)
    stops = spark.createDataFrame([("751010101", "bus"), ("751010101", "cableway")], "code_iris string, type string")
    stations = spark.createDataFrame([("751010102", "METRO")], "code_iris string, mode string")
    bikes = spark.createDataFrame([("751020101", 30)], "code_iris string, capacite int")
    r = {x.code_iris: (x.score_mobilite, x.rang_mobilite)
         for x in MOB.mobility_score(z, stops, stations, bikes).collect()}
    assert r["751020101"][1] == 3 or r["751020101"][0] <= max(v[0] for v in r.values())
    assert sorted(v[1] for v in r.values()) == [1, 2, 3]


def test_fibre_and_quality(spark):
    b = spark.createDataFrame([
        ("z1", 1, "deploye", "deploye", "FRTE"), ("z1", 1, "deploye", "deploye", "SFR0"),
        ("z1", 1, "en cours", "deploye", "FRTE"), ("z1", 1, "deploye", "deploye", "FRTE")],
        "code_iris string, arrondissement int, imb_etat string, pm_etat string, code_l331 string")
    f = NET.fibre_silver(b).first()
    assert (f.total_imb, f.imb_deployes, f.pm_actifs) == (4, 3, 4)
    assert (f.taux_deploiement, f.taux_pm_actif, f.score_fibre) == (75.0, 100.0, 85.0)
    assert f.meilleur_operateur_fibre == "Orange"
    m = spark.createDataFrame([("z1", 1, "orange sa", "45,3", "Success"), ("z1", 1, "Orange", "120", "Failure")],
                              "code_iris string, arrondissement int, operator string, bitrate_dl string, Result string")
    q = NET.quality_silver(m).first()
    assert (q.operateur, q.score_debit, q.score_fiabilite, q.score_qualite) == ("Orange", 82.65, 50.0, 66.33)
    assert q.score_latence is None


def test_network_score_no_quality(spark):
    z = zones(spark)
    mobile = spark.createDataFrame([("751010101", 1, "Free", 50.0, 10.0, 40.0), ("751010101", 1, "SFR", 60.0, 0.0, 40.0),
                                    ("751010102", 1, "Free", 10.0, 0.0, 10.0)],
                                   "code_iris string, arrondissement int, operateur string, couv_4g double, couv_5g double, score_mobile double")
    quality = spark.createDataFrame([], "code_iris string, score_qualite double")
    fibre = spark.createDataFrame([("751010101", 50.0, 50.0, 50.0, "Orange")],
                                  "code_iris string, taux_deploiement double, taux_pm_actif double, score_fibre double, meilleur_operateur_fibre string")
    neigh = spark.createDataFrame([("751010101", "751010102"), ("751010102", "751010101")], "zone string, nzone string")
    r = {x.code_iris: x for x in NET.network_score(mobile, quality, fibre, z, neigh).collect()}
    assert r["751010101"].meilleur_operateur_mobile == "Free"      # tie 40/40 -> alphabetical
    assert r["751010101"].score_final == round((0.45 * 40 + 0.20 * 50) / 100, 4)
    assert r["751010101"].score_qualite == 0.0 and r["751010101"].rang_reseau == 1


def test_runner_canonical_order(spark):
    calls = []
    steps = {"gold": [("dfv", lambda s, c: calls.append("dfv")), ("filosofi", lambda s, c: calls.append("filo"))],
             "silver": [("dvf", lambda s, c: calls.append("dvf"))]}
    assert RUN.run(spark, ["gold", "silver"], steps) == ["silver.dvf", "gold.dfv", "gold.filosofi"]
    assert calls == ["dvf", "dfv", "filo"]


def test_streaming_upsert_runs(spark, tmpdir_fresh):
    land = os.path.join(tmpdir_fresh, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("k,v\n1,a\n2,b\n2,b2\n")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    target = os.path.join(tmpdir_fresh, "target")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    ST.run_available(ST.landing_stream(spark, land, schema, options={"header": "true"}), target, ["k"],
                     checkpoint=ckpt, transform=lambda d: d)
    first = sorted(tuple(r) for r in L.read_current(spark, target).collect())
    assert first in ([("1", "a"), ("2", "b")], [("1", "a"), ("2", "b2")])
    with open(os.path.join(land, "b.csv"), "w") as f:
        f.write("k,v\n2,B\n3,c\n")
    ST.run_available(ST.landing_stream(spark, land, schema, options={"header": "true"}), target, ["k"],
                     checkpoint=ckpt)
    assert sorted(tuple(r) for r in L.read_current(spark, target).collect()) == [("1", "a"), ("2", "B"), ("3", "c")]


def test_sales_silver_and_price_indicators(spark, tmpdir_fresh):
    from zonage.plans import housing as H
    from zonage.sources import readers as R
    from zonage.operators import spatial as G
    header = "|".join(H.SALES_COLUMNS)
    rows = [
        ["1", "03/01/2022", "Vente", "500000,00", "3", "RUE", "DE RIVOLI", "75001", "PARIS 01", "75", "101", "AB", "12", "2", "Appartement", "50", "2", ""],
        ["1", "03/01/2022", "Vente", "500000,00", "3", "RUE", "DE RIVOLI", "75001", "PARIS 01", "75", "101", "AB", "12", "2", "Appartement", "50", "2", ""],
        ["1", "05/02/2022", "Vente", "900000,00", "8", "AV", "FOCH", "75116", "PARIS 16", "75", "116", "CD", "3", "1", "Maison", "100", "5", "200"],
        ["1", "05/02/2022", "Vente", "10,00", "1", "RUE", "X", "92100", "BOULOGNE", "92", "012", "EF", "1", "2", "Appartement", "10", "1", ""],
        ["1", "05/02/2022", "Vente", "10,00", "1", "RUE", "Y", "75002", "PARIS 02", "75", "102", "EF", "1", "3", "Dépendance", "", "", ""],
    ]
    p = os.path.join(tmpdir_fresh, "ValeursFoncieres-2022.txt")
    with open(p, "w") as f:
        f.write(header + "\n" + "\n".join("|".join(r) for r in rows) + "\n")
    raw = R.read_delimited(spark, p, R.ReaderSpec(sep="|"), with_file=True)
    zones = spark.createDataFrame([("751010101", "Z1", 1), ("751160101", "Z2", 16)], "zone string, name string, district int")
    coords = spark.createDataFrame([("751010101", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]]),
                                    ("751160101", [[[[1.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    ze = G.polygon_edges(coords, "zone", "coords")
    addr = spark.createDataFrame([("3 RUE DE RIVOLI", "75001", 0.5, 0.5), ("8 AV FOCH", "75116", 0.5, 1.5)],
                                 "adresse string, postcode string, latitude double, longitude double")
    sales = H.sales_silver(raw, addr, ze, zones)
    got = {r.id_mutation: r for r in sales.collect()}
    assert len(got) == 2                                    # duplicate collapsed, 92 and outbuilding dropped
    by_zone = {r.code_iris: r for r in got.values()}
    assert by_zone["751010101"].valeur_fonciere == 500000.0 and by_zone["751160101"].arrondissement == 116
    ind = {r.code_iris: r for r in H.price_indicators(sales).collect()}
    assert ind["751010101"].prix_m2_median == 10000.0 and ind["751160101"].nb_maisons == 1
    target = sales.limit(1)
    assert H.sales_silver(raw, target=target).count() == 1     # only new ids


def test_aes_scores(spark):
    from zonage.plans import education as E
    pupils = spark.createDataFrame([(1, 100), (2, 300), (3, 200)], "arrondissement int, nb_eleves int")
    colleges = spark.createDataFrame([(1,), (1,), (2,), (3,)], "arrondissement int")
    children = spark.createDataFrame([(1, 1000.0, 500.0), (2, 1000.0, 0.0), (3, 1000.0, 1000.0), (4, 10.0, 10.0), (5, 1.0, 1.0)],
                                     "arrondissement int, pop_3_10 double, pop_11_17 double")
    population = spark.createDataFrame([(1, 10000), (2, 20000), (3, 10000), (4, 10000)], "arrondissement int, population_totale int")
    health = spark.createDataFrame([(1, 10, 5, 2), (2, 10, 5, 2), (3, 10, 5, 2)],
                                   "arrondissement int, nb_medecins int, nb_infirmiers int, nb_pharmacies int")
    hospitals = spark.createDataFrame([(1,)], "arrondissement int")
    r = {x.arrondissement: x for x in E.aes_scores(pupils, colleges, children, population, health, hospitals).collect()}
    assert sorted(r) == [1, 2, 3, 4]                             # district 4 has no pupils, 5 no population
    assert r[1].e1_scolarisation == 0.1 and r[2].e1_scolarisation == 0.3
    assert r[1].e2_couverture_college == 2 / 500 and r[3].e2_couverture_college == 1 / 1000
    assert r[4].e1_scolarisation is None and r[4].e2_couverture_college == 0.0 and r[4].score_education is None
    assert r[2].e2_couverture_college is None and r[2].score_education is None   # 0 children 11-17: NULL stays NULL
    assert r[1].s3_centres_hospitaliers == 1.0 and r[2].s3_centres_hospitaliers == 0.0
    # e1: 0.1 .. 0.3, e2: 0 .. 0.004 -> district 1: (2 * 0 + 1) / 3; s*: 1 has 10, 5, 1, 2 per 10 000
    assert abs(r[1].score_education - 1 / 3) < 1e-12 and r[1].score_sante == 1.0
    assert abs(r[1].score_aes - (1 / 3 + 1) / 2) < 1e-12
    assert r[4].s1_medecins is None and r[4].score_sante == 0.0   # no health row: 0 in the score, NULL stored


def test_serving_plans(spark):
    from zonage.plans import serving as SV
    zones = spark.createDataFrame([("751010101", "Les Halles", 1), ("751010102", "Palais", 1)],
                                  "zone string, name string, district int")
    housing = spark.createDataFrame([("751010101", 2023, 5), ("751010101", 2025, 7)],
                                    "code_iris string, annee int, nb_logements_sociaux_finances int")
    socio = spark.createDataFrame([("751010101", 2021, 20000.0, 10000.0, 6.0), ("751010102", 2021, 30000.0, 9000.0, 3.6)],
                                  "code_iris string, annee int, revenu_median double, prix_m2_median double, iai double")
    env = spark.createDataFrame([("751010101", 0.5)], "code_iris string, score double")
    net = spark.createDataFrame([("751010101", 0.42, "Free", "Orange")],
                                "code_iris string, score_final_stocke double, meilleur_operateur_mobile string, meilleur_operateur_fibre string")
    mob = spark.createDataFrame([("751010101", 0.1, 0.2, float("nan"))],
                                "code_iris string, score_transport_collectif double, score_velib double, score_mobilite double")
    z = SV.zone_indicators(zones, housing, socio, env, net, mob, 2024)
    rows = {r.code_iris: r for r in z.collect()}
    assert rows["751010101"].nb_logements_sociaux_finances == 7      # 2024 -> 2025 (tie rule: later)
    assert rows["751010102"].nb_logements_sociaux_finances == 0 and rows["751010101"].score_mobilite is None
    cmp = {r.indicateur: r.gagnant for r in SV.compare(z, "751010101", "751010102", ["iai", "revenu_median"]).collect()}
    assert cmp == {"iai": "751010102", "revenu_median": "751010102"}
    assert [r.zone for r in SV.search(zones, "pal").collect()] == ["751010102"]
    aes = spark.createDataFrame([(1, 0.5, 0.5, 0.5)], "arrondissement int, score_education double, score_sante double, score_aes double")
    d = SV.district_indicators(z, aes).first()
    assert d.nb_logements_sociaux_finances == 7 and d.meilleur_operateur_mobile == "Free"


def test_fibre_buildings_projected(spark):
    from zonage.functions.geo import lambert93
    from zonage.operators import spatial as G
    coords = spark.createDataFrame(
        [("751010101", [[[[2.30, 48.85], [2.31, 48.85], [2.31, 48.86], [2.30, 48.86]]]]),
         ("751020101", [[[[2.31, 48.85], [2.32, 48.85], [2.32, 48.86], [2.31, 48.86]]]])],
        "zone string, coords array<array<array<array<double>>>>")
    e = G.polygon_edges(coords, "zone", "coords")
    x1, y1 = lambert93(F.col("x1"), F.col("y1"))
    x2, y2 = lambert93(F.col("x2"), F.col("y2"))
    e93 = e.select("id", "part", "ring", "seq", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    zones = spark.createDataFrame([("751010101", "A", 1), ("751020101", "B", 2)], "zone string, name string, district int")
    raw = spark.createDataFrame([
        ("2.305", "48.855", "75001.0", "deploye", "deploye", "FRTE"),
        ("2.315", "48.855", "75002", "deploye", "en cours", "XXXX"),
        ("2.315", "48.855", "75116", "deploye", "deploye", "SFR0"),    # outside the pattern: dropped
        ("2.5", "48.9", "75003", "deploye", "deploye", "FREE"),         # outside every zone: dropped
    ], "x string, y string, code_poste string, imb_etat string, pm_etat string, code_l331 string")
    b = {r.code_iris: r for r in NET.fibre_buildings(raw, e93, zones, cell=1000.0).collect()}
    assert set(b) == {"751010101", "751020101"}
    assert b["751010101"].operateur == "Orange" and b["751020101"].operateur == "XXXX"
    f = {r.code_iris: r for r in NET.fibre_silver(NET.fibre_buildings(raw, e93, zones, cell=1000.0)).collect()}
    assert f["751020101"].taux_pm_actif == 0.0 and f["751020101"].meilleur_operateur_fibre is None


def test_social_housing_silver_and_gold(spark):
    from zonage.plans import housing as H
    from zonage.operators import spatial as G
    coords = spark.createDataFrame([("751010101", [[[[2.30, 48.85], [2.31, 48.85], [2.31, 48.86], [2.30, 48.86]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    ze = G.polygon_edges(coords, "zone", "coords")
    zones = spark.createDataFrame([("751010101", "A", 1)], "zone string, name string, district int")
    cols = ["Identifiant livraison", "Année du financement - agrément", "Nombre total de logements financés",
            "Dont nombre de logements PLA I", "Arrondissement", "geo_point_2d"]
    raw = spark.createDataFrame([
        ("L1", "2020", "10", "4", "1", "48.855, 2.305"),
        ("L1", "2020", "10", "4", "1", "48.855, 2.305"),
        ("L2", "2020", "5", None, "1", "48.855,2.305"),      # no space after the comma: unlocated
        ("L3", "2021", "ns", "1", "1", "48.855, 2.305"),
    ], ", ".join(f"`{c}` string" for c in cols))
    s = H.social_housing_silver(raw, ze, zones)
    got = {r.identifiant_livraison: r for r in s.collect()}
    assert set(got) == {"L1", "L2", "L3"} and got["L2"].code_iris is None and got["L3"].nb_logements_finances is None
    full = s.withColumns({c: F.lit(None).cast("int") for c in ["nb_plus", "nb_plus_cd", "nb_pls"]})
    g = {(r.code_iris, r.annee): r for r in H.social_housing_gold(full).collect()}
    assert g[("751010101", 2020)].nb_logements_sociaux_finances == 10 and g[("751010101", 2021)].nb_logements_sociaux_finances == 0
    assert H.social_housing_silver(raw, ze, zones, target=s.filter(F.col("identifiant_livraison") == "L1")).count() == 2


def test_education_health_silver(spark):
    from zonage.plans import education as E
    from zonage.operators import spatial as G
    coords = spark.createDataFrame([("751010101", [[[[2.30, 48.85], [2.31, 48.85], [2.31, 48.86], [2.30, 48.86]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    ze = G.polygon_edges(coords, "zone", "coords")
    zones = spark.createDataFrame([("751010101", "A", 1)], "zone string, name string, district int")
    hc = spark.createDataFrame([
        ("75", "2023", "75116", "E1", "A", "Elem", "Public", "120"),
        ("75", "2024", "75116", "E1", "A", "Elem", "Public", "130"),
        ("75", "2024", "75002", "E2", "B", "Mat", "Prive", "40"),
        ("92", "2024", "92100", "E3", "C", "Elem", "Public", "50")],
        "`Code département` string, `Rentrée scolaire` string, `Code Postal` string, `Numéro de l'école` string, "
        "Patronyme string, `Dénomination principale` string, Secteur string, `Nombre total d'élèves` string")
    h = {r.numero_ecole: r for r in E.headcounts_silver(hc).collect()}
    assert set(h) == {"E1", "E2"} and h["E1"].nb_eleves == 130 and h["E1"].arrondissement == 16
    assert E.headcounts_silver(hc, keep_116=True).filter("numero_ecole = 'E1'").first().arrondissement == 116
    hosp = spark.createDataFrame([("F1", "H", "addr", "01", "cat", "t", "75001 PARIS", "48.855", "2.305"),
                                  ("F2", "H2", "addr", "01", "cat", "t", "75001 PARIS", None, "2.305"),
                                  ("F3", "H3", "addr", "01", "cat", "t", "92100 BOULOGNE", "48.855", "2.305")],
                                 "FINESS_ET string, RAISON_SOCIALE string, ADRESSE_COMPLETE string, NUM_TEL string, "
                                 "CATEGORIE_DE_L_ETABLISSEMENT string, TYPE_ETABLISSEMENT string, CP_VILLE string, lat string, lng string")
    hs = E.hospitals_silver(hosp, ze, zones).collect()
    assert [(r.finess, r.code_iris, r.arrondissement) for r in hs] == [("F1", "751010101", 1)]
    cols = ", ".join(f"_c{i} string" for i in range(56))
    sheet = spark.createDataFrame([tuple(["Titre"] + [None] * 55), tuple(["codgeo"] + ["x"] * 55),
                                   tuple(["75101"] + ["2"] * 8 + ["3.4"] + ["1"] * 46),
                                   tuple(["92001"] + ["9"] * 55)], cols)
    he = E.health_equipment(sheet).collect()
    assert [(r.arrondissement, r.nb_centres_sante, r.nb_medecins) for r in he] == [(1, 3, 1)]
    pop = spark.createDataFrame([("751010101", "1000", "50", None, "80"), ("751010102", "900", "10", "20", None),
                                 ("920010101", "1", "1", "1", "1")],
                                "IRIS string, P22_POP string, P22_POP0305 string, P22_POP0610 string, P22_POP1117 string")
    zp = E.zone_population(pop).collect()
    assert [(r.code_iris, r.pop_3_10, r.arrondissement) for r in zp] == [("751010101", 50.0, 1)]


def test_cool_islands_within(spark):
    import json as _json
    from zonage.operators import spatial as G
    coords = spark.createDataFrame([("z1", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]]),
                                    ("z2", [[[[1.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    ze = G.polygon_edges(coords, "zone", "coords")
    inside = _json.dumps({"type": "Polygon", "coordinates": [[[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]]})
    straddle = _json.dumps({"type": "Polygon", "coordinates": [[[0.8, 0.2], [1.2, 0.2], [1.2, 0.4], [0.8, 0.2]]]})
    raw = spark.createDataFrame([("a", "A", "75001", inside), ("a", "A bis", "75001", inside), ("b", "B", "75001", straddle)],
                                "IDENTIFIANT string, Nom string, `Code postal` string, geo_shape string")
    from zonage.plans import environment as E2
    got = [(r.id, r.nom, r.code_iris) for r in E2.cool_islands_silver(raw, ze, 1.0).collect()]
    assert got == [("a", "A", "z1")]


def test_streaming_batches_are_exactly_once_and_order_free(spark, tmpdir_fresh):
    schema = "k string, v string, _file string"
    one = spark.createDataFrame([("1", "a", "f1"), ("2", "b", "f1")], schema)
    two = spark.createDataFrame([("2", "c", "f2"), ("3", "d", "f2")], schema)
    both = one.unionByName(two)
    for rule, want in [("upsert", [("1", "a"), ("2", "c"), ("3", "d")]), ("insert_ignore", [("1", "a"), ("2", "b"), ("3", "d")]),
                       ("append", [("1", "a"), ("2", "b"), ("2", "c"), ("3", "d")])]:
        for name, batches in [("apart", [one, two]), ("together", [both])]:
            target = os.path.join(tmpdir_fresh, rule, name)
            fn = ST.merge_batch(target, ["k"], rule)
            for epoch, batch in enumerate(batches):
                fn(batch, epoch)
                fn(batch, epoch)                                    # a replay after a failure
            assert sorted(tuple(r) for r in L.read_current(spark, target).collect()) == want, (rule, name)


def test_environment_filters(spark):
    """Trees: city labels only.  Green spaces: id, postal code and shape are
    required, the surface isn't."""
    from zonage.operators import spatial as G
    from zonage.plans import environment as ENV
    zones = spark.createDataFrame([("z1", "Z1", 1)], "zone string, name string, district int")
    coords = spark.createDataFrame([("z1", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    edges = G.polygon_edges(coords, "zone", "coords")
    trees = spark.createDataFrame([("1", "PARIS 1ER ARRDT", "0.5, 0.5"), ("2", "BOIS DE VINCENNES", "0.5, 0.5"),
                                   ("3", "HAUTS-DE-SEINE", "0.5, 0.5"), ("4", None, "0.5, 0.5")],
                                  "IDBASE string, ARRONDISSEMENT string, geo_point_2d string")
    assert [(r.id, r.arrondissement, r.code_iris) for r in ENV.trees_silver(trees, edges, zones).collect()] == [(1, 1, "z1")]
    shape = '{"type": "Polygon", "coordinates": [[[0.1, 0.1], [0.2, 0.1], [0.2, 0.2], [0.1, 0.1]]]}'
    green = spark.createDataFrame([("1", "A", "75001", None, "1990", shape), ("2", "B", None, "5", "1980", shape),
                                   (None, "C", "75001", "5", "1970", shape), ("4", "D", "75001", "5", "9999", shape),
                                   ("5", "E", "75001", "7", "2000", None)],
                                  "`Identifiant espace vert` string, `Nom de l'espace vert` string, `Code postal` string, "
                                  "`Superficie totale réelle` string, `Année de l'ouverture` string, `Geo Shape` string")
    got = {r.id: (r.superficie, r.annee) for r in ENV.green_spaces_silver(green, edges, 0.5).collect()}
    assert got == {1: (None, 1990), 4: (5.0, 1990)}


def test_school_map_drops_rows_without_place_before_keep_first(spark):
    from zonage.operators import spatial as G
    from zonage.plans import education as E
    zones = spark.createDataFrame([("z1", "Z1", 1)], "zone string, name string, district int")
    coords = spark.createDataFrame([("z1", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]])],
                                   "zone string, coords array<array<array<array<double>>>>")
    edges = G.polygon_edges(coords, "zone", "coords")
    cols = ("`Année scolaire` string, geo_point_2d string, `Libellé établissement` string, Adresse string, "
            "`Type établissement` string, Arrondissement string")
    a = spark.createDataFrame([("2024", None, "A", "1 rue X", "Elémentaire", "1er"), ("2024", "0.5, 0.5", "B", "1 rue X", "Elémentaire", "1er"),
                               ("2024", "0.5, 0.5", "P", "2 rue Y", "Elémentaire", "1er"), ("2024", "0.5, 0.5", "N", "3 rue Z", "Elémentaire", None)], cols)
    b = spark.createDataFrame([("2024", "0.5, 0.5", "P", "2 rue Y", "Polyvalent", "1er")], cols)
    got = sorted((r.nom, r.type) for r in E.schools_map(a, b, edges, zones).collect())
    assert got == [("B", "Elémentaire"), ("P", "Polyvalent")]
