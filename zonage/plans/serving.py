"""Serving (DP17–DP20): wide indicator tables, map layers, search, compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import load as L
from ..operators import temporal as TM

# Zone-table indicators averaged per district and the labels
# whose mode is taken.
MEANS = ["revenu_median", "prix_m2_median", "iai", "score_environnemental", "score_reseau",
         "score_transport_collectif", "score_velib", "score_mobilite"]
MODES = ["meilleur_operateur_mobile", "meilleur_operateur_fibre"]
LOWER_IS_BETTER = {"prix_m2_median", "iai"}


def at_year(table: DataFrame, year: int, col: str = "annee") -> DataFrame:
    """JN9 then FLT11: the rows of the available year nearest to ``year``
    (tie → later).  The year is a scalar subquery, so that of a table stored by
    year only its partition is read, and the years are its partitions' values."""
    return table.filter(F.col(col) == TM.resolve_year(table, col, year, tie="later").select("year").scalar())


def zone_indicators(zones: DataFrame, housing: DataFrame, socio: DataFrame, environment: DataFrame,
                    network: DataFrame, mobility: DataFrame, year: int) -> DataFrame:
    """DP17: one row per zone — yearly tables at their nearest year, key-unique
    left joins on the zone reference, housing 0 when absent, NaN → NULL."""
    h = at_year(housing, year).groupBy("code_iris").agg(
        F.sum("nb_logements_sociaux_finances").alias("nb_logements_sociaux_finances"))
    s = at_year(socio, year).select("code_iris", "revenu_median", "prix_m2_median", "iai")
    out = zones.select(F.col("zone").alias("code_iris"), F.col("district").alias("arrondissement"),
                       F.col("name").alias("nom_iris"))
    out = out.join(h, "code_iris", "left").fillna({"nb_logements_sociaux_finances": 0})
    for t in (s, environment.select("code_iris", F.col("score").alias("score_environnemental")),
              network.select("code_iris", F.col("score_final_stocke").alias("score_reseau"),
                             "meilleur_operateur_mobile", "meilleur_operateur_fibre"),
              mobility.select("code_iris", "score_transport_collectif", "score_velib", "score_mobilite")):
        out = out.join(t, "code_iris", "left")
    return C.sanitize(out)


def district_indicators(zone_table: DataFrame, aes: DataFrame) -> DataFrame:
    """DP18: AG13 roll-up of the zone table + education/health scores."""
    d = A.rollup(zone_table, "arrondissement", sums=["nb_logements_sociaux_finances"], means=MEANS, modes=MODES)
    return C.sanitize(d.join(aes.select("arrondissement", "score_education", "score_sante", "score_aes"),
                             "arrondissement", "left"))


def layer(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """DP19/SNK10: map layers ``(code, nom, geo_shape)``; unknown name -> error."""
    if name == "espaces_verts":
        t = tables[name]
        return t.select(F.col("id").cast("string").alias("code"), "nom", "geo_shape")
    if name == "gares":
        t = tables[name]
        return t.select(F.col("gare_id").cast("string").alias("code"),
                        F.concat(F.col("ligne"), F.lit(" - "), F.col("nom")).alias("nom"),
                        C.point_geojson("lon", "lat").alias("geo_shape"))
    if name == "colleges":
        t = tables[name]
        return t.select(F.col("id").cast("string").alias("code"), "nom",
                        C.point_geojson("lon", "lat").alias("geo_shape"))
    raise KeyError(f"unknown layer {name!r}")


def features(zones: DataFrame) -> DataFrame:
    """DP19/SNK9: zone documents as GeoJSON Features, from the geometry that the
    zone table keeps."""
    return L.to_features(zones, "zone", "geometry", ["zone", "name", "district"])


def district_features(districts: DataFrame) -> DataFrame:
    """DP19/SNK9: district documents with all properties of the source, the
    district's code as ``_id``."""
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.coalesce("properties_json", F.lit("{}")),
                    F.lit(',"geometry":'), F.coalesce("geometry", F.lit("null")), F.lit("}"))
    return districts.select(F.col("code").cast("string").alias("_id"), text.alias("feature"))


def search(zones: DataFrame, text: str, k: int = 6) -> DataFrame:
    """DP20/ST3: first ``k`` zones (by code) whose name or code contains the text."""
    t = text.lower()
    hit = F.lower(F.col("name")).contains(t) | F.col("zone").cast("string").contains(t)
    return zones.filter(hit).orderBy("zone").limit(k)


def compare(zone_table: DataFrame, a: str, b: str, cols: list[str]) -> DataFrame:
    """DP20: two zones per indicator; lower is better for price and
    affordability; ties → the second zone."""
    long = zone_table.filter(F.col("code_iris").isin(a, b)).unpivot(
        "code_iris", [F.col(c).cast("double").alias(c) for c in cols], "indicateur", "valeur")
    za = long.filter(F.col("code_iris") == a).select("indicateur", F.col("valeur").alias("zone_a"))
    zb = long.filter(F.col("code_iris") == b).select("indicateur", F.col("valeur").alias("zone_b"))
    lower = F.col("indicateur").isin(*sorted(LOWER_IS_BETTER))
    a_wins = F.when(lower, F.col("zone_a") < F.col("zone_b")).otherwise(F.col("zone_a") > F.col("zone_b"))
    return za.join(zb, "indicateur", "full").withColumn(
        "gagnant", F.when(F.col("zone_a").isNull() | F.col("zone_b").isNull(), F.lit(None))
        .when(a_wins, F.lit(a)).otherwise(F.lit(b)))
