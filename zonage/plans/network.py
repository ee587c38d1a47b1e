"""Telecom network (DP10–DP14): mobile coverage, fibre, quality, gap
filling and the network score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import interpolate as I
from ..operators import joins as J
from ..operators import score as S
from ..operators import spatial as G

# Mobile score weights (4G, 5G, level, antenna density),
# fibre (deployment, active points), quality (throughput, reliability),
# final network blend, and the reference throughput for a score of 100.
MOBILE_WEIGHTS = {"couv_4g": 0.10, "couv_5g": 0.25, "score_niveau": 0.25, "score_densite": 0.40}
FIBRE_WEIGHTS = {"taux_deploiement": 0.60, "taux_pm_actif": 0.40}
QUALITY_WEIGHTS = {"score_debit": 0.5, "score_fiabilite": 0.5}
NETWORK_WEIGHTS = {"score_mobile": 0.45, "score_qualite": 0.35, "score_fibre": 0.20}
THROUGHPUT_REF_MBPS = 100.0


def coverage_rates(coverage_edges: DataFrame, coverage_attrs: DataFrame, zone_edges: DataFrame,
                   zones: DataFrame, cell: float,
                   layers: list[tuple[str, str]] | None = None) -> DataFrame:
    """JN5 per (zone, operator, tech): covered share ×100 clipped and rounded
    2 (0 when nothing), dominant level of the largest fragment, level score.
    ``coverage_attrs``: ``(id, operateur, techno, niveau)`` per polygon;
    geometries in a metric projection."""
    ov = G.overlay_area(coverage_edges, zone_edges, cell).join(
        coverage_attrs.withColumnRenamed("id", "fid"), "fid")
    ov = ov.withColumn("_ar", C.round_dec("area", 9))
    per = ov.groupBy("zone", "operateur", "techno").agg(
        F.sum("area").alias("_a"), F.max_by("niveau", F.struct("_ar", "niveau")).alias("niveau_dominant"))
    za = G.polygon_area(zone_edges).select(F.col("id").alias("zone"), F.col("area").alias("_za"))
    per = per.join(za, "zone")
    if layers:
        # every zone gets a row per (operator, technology) layer: 0 when uncovered
        grid = zones.select("zone", F.explode(F.array(*[
            F.struct(F.lit(o).alias("operateur"), F.lit(t).alias("techno")) for o, t in layers])).alias("_l")) \
            .select("zone", "_l.operateur", "_l.techno")
        per = grid.join(za, "zone").join(per.drop("_za"), ["zone", "operateur", "techno"], "left") \
            .fillna({"_a": 0.0})
    return per.select(
        F.col("zone").alias("code_iris"), "operateur", "techno",
        C.round_dec(C.clip(F.col("_a") / F.col("_za") * 100.0), 2).alias("taux_couverture"),
        "niveau_dominant",
        F.coalesce(C.map_values("niveau_dominant", C.LEVEL_SCORES), F.lit(0)).cast("int").alias("score_niveau"))


def antenna_density(antennas: DataFrame, zones: DataFrame, zone_area_m2: DataFrame) -> DataFrame:
    """JN20 + WN5: antennas per (district, operator) spread evenly over the
    district's zones (1 decimal), density per km² (3 decimals), min-max ×100."""
    op = C.map_values(F.col(_like(antennas, "rateur")), C.ANTENNA_OPERATORS, normalise=True)
    arr = C.to_int(F.substring(F.col(_like(antennas, "rondissement")).cast("string"), -2, 2)).cast("int")
    a = antennas.select(op.alias("operateur"), arr.alias("arrondissement")) \
        .filter(F.col("operateur").isNotNull() & F.col("arrondissement").between(1, 20))
    totals = a.groupBy("arrondissement", "operateur").agg(F.count("*").alias("n"))
    members = zones.select(F.col("zone").alias("code_iris"), F.col("district").alias("arrondissement"))
    d = J.spread_evenly(totals, members, "arrondissement", "n", "nb_antennes", digits=1)
    d = d.join(zone_area_m2.select(F.col("zone").alias("code_iris"), F.col("area").alias("_m2")), "code_iris")
    d = d.withColumn("densite_antennes_km2", C.round_dec(F.col("nb_antennes") / (F.col("_m2") / 1e6), 3))
    return S.minmax(d, {"densite_antennes_km2": "score_densite"}, scale=100.0, digits=2).drop("_m2")


def _like(df: DataFrame, needle: str) -> str:
    from ..sources.readers import resolve_column
    return resolve_column(df, [], contains=needle)


def mobile_silver(coverage: DataFrame, density: DataFrame, zones: DataFrame) -> DataFrame:
    """DP10: 4G ⟗ 5G per (zone, operator), best level of both, the zone's
    district, density left-joined, weighted mobile score round 2."""
    side = lambda techno, rate, level: coverage.filter(F.col("techno") == techno).select(
        "code_iris", "operateur", F.col("taux_couverture").alias(rate), F.col("score_niveau").alias(level))
    m = J.full_outer(side("4G", "couv_4g", "sn4"), side("5G", "couv_5g", "sn5"), ["code_iris", "operateur"])
    m = m.withColumn("score_niveau", F.coalesce(C.row_max("sn4", "sn5"), F.lit(0))).drop("sn4", "sn5") \
         .fillna({"couv_4g": 0.0, "couv_5g": 0.0})
    m = m.join(zones.select(F.col("zone").alias("code_iris"), F.col("district").alias("arrondissement")), "code_iris")
    m = m.join(density.select("code_iris", "operateur", "nb_antennes", "densite_antennes_km2", "score_densite"),
               ["code_iris", "operateur"], "left").fillna({"score_densite": 0.0})
    return S.weighted_score(m, MOBILE_WEIGHTS, "score_mobile", digits=2)


# Postal-code pattern of the city's buildings, and the commune
# code of measurements taken in the city.
POSTAL_PATTERN = r"^750\d\d$"
CITY_INSEE = 75056


def fibre_buildings(raw: DataFrame, zone_edges_l93: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """DP11 input: buildings of the city (postal code ``750dd``; a float-typed
    ``75001.0`` is normalised first), operator from the infrastructure code
    (unmapped codes pass through), district from the postal code, located in
    Lambert-93 (JN2); buildings without a zone are dropped."""
    postal = F.regexp_replace(F.trim(F.col("code_poste").cast("string")), r"\.0$", "")
    b = raw.withColumn("code_poste", postal).filter(F.col("code_poste").rlike(POSTAL_PATTERN)).select(
        C.to_number("x").alias("lon"), C.to_number("y").alias("lat"), "imb_etat", "pm_etat",
        C.map_values("code_l331", C.FIBRE_OPERATOR_CODES, passthrough=True).alias("operateur"),
        C.code_to_district("code_poste", "postal").alias("arr_postal"))
    b = C.drop_missing(b, ["lon", "lat"])
    from .common import attach_zone
    located = attach_zone(b, zone_edges_l93, zones, "lat", "lon", how="inner", cell=cell, projected=True)
    return located.withColumn("arrondissement", F.coalesce("arrondissement", "arr_postal")).drop("arr_postal")


def qos_measures(raw: DataFrame, zone_edges_l93: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """DP12 input: city measurements, canonical operator, decimal-comma
    throughput, success flag, located in Lambert-93; zone-less rows dropped."""
    m = raw.filter(C.to_int("insee_com") == CITY_INSEE).select(
        C.canonical("operator").alias("operateur"), C.comma_decimal("bitrate_dl").alias("debit"),
        (F.col("Result") == "Success").cast("int").alias("ok"),
        C.to_number("latitude_start").alias("lat"), C.to_number("longitude_start").alias("lon"))
    m = C.drop_missing(m, ["lat", "lon"])
    from .common import attach_zone
    return attach_zone(m, zone_edges_l93, zones, "lat", "lon", how="inner", cell=cell, projected=True)


def fibre_silver(buildings: DataFrame) -> DataFrame:
    """DP11: per zone, one pass of conditional counts: total, deployed,
    active points, rates, weighted score, best operator among buildings with
    both deployed (argmax, ties alphabetical)."""
    dep = F.col("imb_etat") == "deploye"
    act = F.col("pm_etat") == "deploye"
    buildings = A.drop_null_keys(buildings, ["code_iris"])
    if "operateur" not in buildings.columns:
        buildings = buildings.withColumn(
            "operateur", C.map_values("code_l331", C.FIBRE_OPERATOR_CODES, passthrough=True))
    r = buildings.groupBy("code_iris").agg(
        F.count("*").alias("total_imb"), A.count_filter(dep).alias("imb_deployes"),
        A.count_filter(act).alias("pm_actifs"), F.min("arrondissement").alias("arrondissement"))
    r = r.withColumn("taux_deploiement", C.round_dec(A.rate_of("imb_deployes", "total_imb"), 2)) \
         .withColumn("taux_pm_actif", C.round_dec(A.rate_of("pm_actifs", "total_imb"), 2))
    r = S.weighted_score(r, FIBRE_WEIGHTS, "score_fibre", digits=2)
    ops = buildings.filter(dep & act).withColumnRenamed("operateur", "op") \
        .groupBy("code_iris", "op").agg(F.count("*").alias("n"))
    best = A.argmax(ops, "code_iris", "n", "op", "meilleur_operateur_fibre")
    return r.join(best, "code_iris", "left")


def quality_silver(measures: DataFrame) -> DataFrame:
    """DP12: per (zone, operator): median throughput scaled to the reference
    (clip 0–100, round 2), success rate ×100, quality = ½/½ with NULL → 0;
    latency not measured (NULL)."""
    m = measures
    if "debit" not in m.columns:   # raw measurement columns: normalise here
        m = m.withColumn("operateur", C.canonical("operator")) \
             .withColumn("debit", C.comma_decimal("bitrate_dl")) \
             .withColumn("ok", (F.col("Result") == "Success").cast("int"))
    keys = ["code_iris", "operateur"]
    m = A.drop_null_keys(m, keys)
    med = A.exact_median(m, keys, "debit", "_med")
    ok = m.groupBy(*keys).agg((F.avg("ok") * 100.0).alias("_ok"), F.min("arrondissement").alias("arrondissement"))
    q = ok.join(med, keys, "left")
    q = q.withColumn("score_debit", C.round_dec(C.clip(F.col("_med") / THROUGHPUT_REF_MBPS * 100.0), 2)) \
         .withColumn("score_fiabilite", C.round_dec("_ok", 2)) \
         .withColumn("score_latence", F.lit(None).cast("double"))
    q = S.weighted_score(q, QUALITY_WEIGHTS, "score_qualite", digits=2, null_as_zero=True)
    return q.drop("_med", "_ok")


def network_score(mobile: DataFrame, quality: DataFrame, fibre: DataFrame, zones: DataFrame,
                  neighbours: DataFrame) -> DataFrame:
    """DP13 + DP14: best operator per zone, quality gap-filled from
    neighbours (0 everywhere when no quality measure exists), fibre; NULL → 0;
    score = (.45·mobile + .35·quality + .20·fibre) / 100 round 4; rank on the
    4-decimal score (the 2-decimal stored value is ``score_final_stocke``)."""
    # one row per zone; the district is a dependent attribute (it is NULL on
    # rows of operators present in the 5G layers only, which a group key on
    # the district would split off or — with pandas semantics — drop)
    mi = mobile.groupBy("code_iris").agg(
        F.max("arrondissement").alias("arrondissement"),
        F.max("couv_4g").alias("couv_4g_max"), F.max("couv_5g").alias("couv_5g_max"),
        F.max("score_mobile").alias("score_mobile"))
    best = A.argmax(mobile, "code_iris", "score_mobile", "operateur", "meilleur_operateur_mobile")
    qz = quality.groupBy("code_iris").agg(F.max("score_qualite").alias("v"))
    ref = zones.select(F.col("zone").alias("code_iris"), *(["position"] if "position" in zones.columns else []))
    has_q = quality.select(F.count(F.lit(1))).scalar() > 0
    filled = I.fill_from_neighbours(ref.join(qz, "code_iris", "left"),
                                    neighbours.withColumnRenamed("zone", "code_iris"),
                                    "code_iris", "v", order="position" if "position" in zones.columns else None)
    q = filled.select("code_iris", F.when(has_q, F.col("v")).otherwise(F.lit(0.0)).alias("score_qualite"))
    r = mi.join(q, "code_iris", "left").join(
        fibre.select("code_iris", F.col("taux_deploiement").alias("taux_deploiement_fibre"), "taux_pm_actif",
                     "score_fibre", "meilleur_operateur_fibre"), "code_iris", "left").join(best, "code_iris", "left")
    r = r.fillna({"score_mobile": 0.0, "score_qualite": 0.0, "score_fibre": 0.0})
    raw = (F.lit(0.45) * F.col("score_mobile") + F.lit(0.35) * F.col("score_qualite")
           + F.lit(0.20) * F.col("score_fibre")) / 100.0
    r = r.withColumn("score_final", C.round_dec(raw, 4))
    r = S.rank_desc(r, "score_final", "rang_reseau")
    return r.withColumn("score_final_stocke", C.round_dec("score_final", 2))
