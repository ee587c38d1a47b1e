"""Education and health (DP15, DP16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import joins as J
from ..operators import score as S
from ..operators import temporal as TM
from .common import attach_zone, carried, first_in_file

# Age bands summed into the 3–10 and 11–17 populations.
AGES_3_10 = ["F3-5", "F6-10", "H3-5", "H6-10"]
AGES_11_17 = ["F11-17", "H11-17"]


def schools_map(schools: DataFrame, colleges_like: DataFrame, zone_edges: DataFrame,
                zones: DataFrame) -> DataFrame:
    """DP15 school map: latest school year of each file (FLT9), elementary rows
    also listed as 'Polyvalent' dropped by (name, address) — NULL-safe (JN15) —
    union, district from the ordinal label, rows without point or district
    dropped, address key, first row per key (the schools' file first), zone
    attached."""
    def prep(df, place):
        d = TM.latest_snapshot(df, "Année scolaire")
        lat, lon = C.lat_lon("geo_point_2d")
        return d.select(F.col("Libellé établissement").alias("nom"), F.col("Adresse").alias("adresse"),
                        F.col("Type établissement").alias("type"), C.ordinal("Arrondissement").alias("arrondissement"),
                        lat.alias("lat"), lon.alias("lon"), F.lit(place).alias("_place"), *carried(df))
    a, b = prep(schools, 0), prep(colleges_like, 1)
    poly = b.filter(F.col("type") == "Polyvalent")
    a = J.anti_join(a, poly, ["nom", "adresse"], null_safe=True)
    u = C.drop_missing(a.unionByName(b), ["lat", "lon", "arrondissement"])
    u = u.withColumn("id", C.address_key("adresse", "arrondissement"))
    placed = carried(u)
    u = S.keep_first(u, ["id"], ["_place", *(placed or ["nom", "type"])]).drop("_place", *placed)
    located = attach_zone(u.withColumnRenamed("arrondissement", "_arr"), zone_edges, zones)
    return located.drop("arrondissement").withColumnRenamed("_arr", "arrondissement")


def district_population(raw: DataFrame) -> DataFrame:
    """DP15: ``Paris 1er Arrondissement`` -> 1; the TOTAL row drops."""
    return raw.select(C.first_number("Arrondissement").alias("arrondissement"),
                      C.to_int("Population").alias("population_totale")) \
              .filter(F.col("arrondissement").isNotNull())


def age_population(raw: DataFrame) -> DataFrame:
    """DP15: children 3–10 and 11–17 per district (SF24)."""
    d = raw.select(C.code_to_district("INSEE", "insee").alias("arrondissement"),
                   *[C.to_number(F.col(c)).alias(c) for c in AGES_3_10 + AGES_11_17])
    d = d.filter(F.col("arrondissement").between(1, 20))
    return d.groupBy("arrondissement").agg(
        F.round(F.sum(C.sum_columns(AGES_3_10)), 0).alias("pop_3_10"),
        F.round(F.sum(C.sum_columns(AGES_11_17)), 0).alias("pop_11_17"))


def aes_scores(pupils: DataFrame, colleges: DataFrame, children: DataFrame, population: DataFrame,
               health: DataFrame, hospitals: DataFrame) -> DataFrame:
    """DP16 per district that has children and a population: E1 = pupils /
    children 3–10, E2 = colleges / children 11–17; S1..S4 = doctors, nurses,
    hospitals, pharmacies per 10 000 (no college or hospital row counts as 0);
    the scores use min-max values (E* keep NULLs, S* NULL → 0): education =
    (2·E1 + E2) / 3, health = mean S1..S4, overall = mean of both.  The table
    holds the raw indicators and the scores."""
    e = children.join(population, "arrondissement") \
        .join(pupils.groupBy("arrondissement").agg(F.sum("nb_eleves").alias("eleves")), "arrondissement", "left") \
        .join(colleges.groupBy("arrondissement").agg(F.count("*").alias("nb_colleges")), "arrondissement", "left") \
        .join(health, "arrondissement", "left") \
        .join(hospitals.groupBy("arrondissement").agg(F.count("*").alias("nb_hopitaux")), "arrondissement", "left") \
        .fillna({"nb_colleges": 0, "nb_hopitaux": 0})
    d = e.select("arrondissement",
                 C.safe_div("eleves", "pop_3_10").alias("e1"), C.safe_div("nb_colleges", "pop_11_17").alias("e2"),
                 C.per_10k("nb_medecins", "population_totale").alias("s1"),
                 C.per_10k("nb_infirmiers", "population_totale").alias("s2"),
                 C.per_10k("nb_hopitaux", "population_totale").alias("s3"),
                 C.per_10k("nb_pharmacies", "population_totale").alias("s4"))
    d = S.minmax(d, {"e1": "ne1", "e2": "ne2"})
    d = S.minmax(d, {"s1": "ns1", "s2": "ns2", "s3": "ns3", "s4": "ns4"}, fill=0)
    edu = (2.0 * F.col("ne1") + F.col("ne2")) / 3.0
    health_s = (F.col("ns1") + F.col("ns2") + F.col("ns3") + F.col("ns4")) / 4.0
    return C.sanitize(d.select("arrondissement", F.col("e1").alias("e1_scolarisation"),
                               F.col("e2").alias("e2_couverture_college"), F.col("s1").alias("s1_medecins"),
                               F.col("s2").alias("s2_infirmiers"), F.col("s3").alias("s3_centres_hospitaliers"),
                               F.col("s4").alias("s4_pharmacies"),
                               edu.alias("score_education"), health_s.alias("score_sante"),
                               ((edu + health_s) / 2.0).alias("score_aes")))


def headcounts_silver(raw: DataFrame, keep_116: bool = False) -> DataFrame:
    """DP15 school headcounts: the city's department, latest school year
    (FLT9), district from the postal code (SF8; ``keep_116`` reproduces the
    75116 -> 116 quirk), pupils as integers, one row per school number."""
    d = raw.filter(F.trim(F.col("Code département").cast("string")) == "75")
    d = TM.latest_snapshot(d, "Rentrée scolaire")
    out = d.select(F.col("Numéro de l'école").alias("numero_ecole"), F.col("Patronyme").alias("nom"),
                   F.col("Dénomination principale").alias("type"), F.col("Secteur").alias("secteur"),
                   C.code_to_district("Code Postal", "postal", keep_116=keep_116).alias("arrondissement"),
                   C.to_int("Nombre total d'élèves").cast("int").alias("nb_eleves"), *carried(raw))
    return first_in_file(out, ["numero_ecole"], ["nom"])


def hospitals_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame,
                     keep_116: bool = False) -> DataFrame:
    """DP15 hospitals: city postcodes (``75…``), district from ``CP_VILLE``,
    rows without coordinates dropped, zone attached, one row per FINESS."""
    d = raw.filter(F.col("CP_VILLE").cast("string").startswith("75")).select(
        F.col("FINESS_ET").alias("finess"), F.col("RAISON_SOCIALE").alias("nom"),
        F.col("ADRESSE_COMPLETE").alias("adresse"), F.col("NUM_TEL").alias("telephone"),
        F.col("CATEGORIE_DE_L_ETABLISSEMENT").alias("categorie"),
        F.col("TYPE_ETABLISSEMENT").alias("type_etablissement"), F.col("CP_VILLE").alias("cp_ville"),
        C.code_to_district(F.substring(F.col("CP_VILLE").cast("string"), 1, 5), "postal", keep_116=keep_116)
        .alias("_arr"),
        C.to_number("lat").alias("lat"), C.to_number("lng").alias("lon"), *carried(raw))
    d = C.drop_missing(d, ["lat", "lon"])
    located = attach_zone(d, zone_edges, zones).drop("arrondissement").withColumnRenamed("_arr", "arrondissement")
    return first_in_file(located, ["finess"], ["nom"])


def colleges_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame) -> DataFrame:
    """DP15 colleges: latest school year, district from the ordinal label,
    address key id, rows without coordinates dropped, one row per id, zone."""
    d = TM.latest_snapshot(raw, "Année scolaire")
    lat, lon = C.lat_lon("geo_point_2d")
    d = d.select(F.col("Libellé établissement").alias("nom"), F.col("Adresse").alias("adresse"),
                 C.ordinal("Arrondissement").alias("_arr"), lat.alias("lat"), lon.alias("lon"), *carried(raw))
    d = C.drop_missing(d.withColumn("id", C.address_key("adresse", "_arr")), ["id", "lat", "lon"])
    d = first_in_file(d, ["id"], ["nom"])
    return attach_zone(d, zone_edges, zones).drop("arrondissement").withColumnRenamed("_arr", "arrondissement")


# Positions of the health-equipment sheet export columns.
HEALTH_POSITIONS = {0: "codgeo", 9: "nb_centres_sante", 34: "nb_medecins", 50: "nb_infirmiers",
                    55: "nb_pharmacies"}


def health_equipment(sheet: DataFrame) -> DataFrame:
    """DP15 health equipment per district from the sheet's CSV export:
    positional columns (SRC11), data rows of the city's districts only
    (``751dd``), counts rounded to integers with NULL -> 0."""
    from ..sources.readers import data_rows, positional
    d = data_rows(positional(sheet, HEALTH_POSITIONS), "codgeo", r"^751\d\d$")
    counts = [c for c in HEALTH_POSITIONS.values() if c != "codgeo"]
    return d.select(C.code_to_district("codgeo", "insee").alias("arrondissement"),
                    *[F.coalesce(F.round(C.to_number(c), 0), F.lit(0.0)).cast("int").alias(c) for c in counts])


def zone_population(raw: DataFrame) -> DataFrame:
    """DP15 population per zone: city zones, numeric totals, 3–10 with NULL
    bands as 0, 11–17 as is; rows with any NULL dropped (FLT7)."""
    d = raw.filter(F.col("IRIS").startswith("751")).select(
        F.col("IRIS").alias("code_iris"), C.code_to_district("IRIS", "zone").alias("arrondissement"),
        C.to_number("P22_POP").alias("pop_totale"),
        C.sum_columns([C.to_number("P22_POP0305"), C.to_number("P22_POP0610")]).alias("pop_3_10"),
        C.to_number("P22_POP1117").alias("pop_11_17"))
    return d.dropna()
