"""Environment (DP6, DP7): trees, green spaces, cool islands, sorting
stations attached to zones, and the environment score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import score as S
from ..operators import spatial as G
from ..sources.geojson import geometry_coords
from .common import attach_zone, carried, first_in_file, unseen

# Environment score weights.
WEIGHTS = {"arbres": 0.30, "espaces_verts": 0.40, "ilots_fraicheur": 0.20, "trilib": 0.10}


def trees_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame,
                 target: DataFrame | None = None) -> DataFrame:
    """DP6 trees: city trees only (label ``PARIS …``, FLT2), point parse,
    district from the label, zone attached (trees without a zone are kept)."""
    lat, lon = C.lat_lon("geo_point_2d")
    df = C.starts_with(raw, "ARRONDISSEMENT", "PARIS").select(C.to_int("IDBASE").alias("id"), C.first_number("ARRONDISSEMENT").alias("arr_label"),
                    lat.alias("latitude"), lon.alias("longitude"))
    df = attach_zone(unseen(df, target, ["id"]), zone_edges, zones, "latitude", "longitude").drop("nom_iris", "arrondissement")
    return df.withColumnRenamed("arr_label", "arrondissement")


def polygons_in_zones(raw: DataFrame, zone_edges: DataFrame, predicate: str, cell: float,
                      shape: str = "geo_shape") -> DataFrame:
    """DP6 green spaces (``intersects``: one row per touched zone) and cool
    islands / sorting stations (``within``: straddling features dropped).  Zones
    are found for each distinct shape and joined back by it, so rows that share
    an id keep their own."""
    keyed = raw.withColumn("_shape", F.sha2(shape, 256))
    shapes = keyed.select("_shape", shape).dropDuplicates(["_shape"]) \
                  .select(F.col("_shape").alias("fid"), geometry_coords(shape).alias("coords")).filter(F.col("coords").isNotNull())
    pairs = G.features_in_zones(G.polygon_edges(shapes, "fid", "coords"), zone_edges, predicate, cell)
    return keyed.join(pairs.select(F.col("fid").alias("_shape"), F.col("zone").alias("code_iris")), "_shape").drop("_shape")


def green_spaces_silver(raw: DataFrame, zone_edges: DataFrame, cell: float,
                        target: DataFrame | None = None) -> DataFrame:
    """DP6 green spaces: rows without id, postal code or shape dropped (FLT7),
    opening year sentinel 9999 -> NULL -> median (FLT12), intersecting zones
    attached."""
    df = raw.select(C.to_int("Identifiant espace vert").alias("id"), F.col("Nom de l'espace vert").alias("nom"),
                    C.to_int("Code postal").alias("code_postal"),
                    C.to_number("Superficie totale réelle").alias("superficie"),
                    C.to_int("Année de l'ouverture").alias("annee"), F.col("Geo Shape").alias("geo_shape"))
    df = C.drop_missing(df, ["id", "code_postal", "geo_shape"])
    df = A.impute_median(df, "annee", sentinel=9999)
    return polygons_in_zones(unseen(df, target, ["id"]), zone_edges, "intersects", cell)


def environment_score(zones: DataFrame, trees: DataFrame, green: DataFrame, islands: DataFrame,
                      stations: DataFrame) -> DataFrame:
    """DP7: counts / surface / distinct islands / stations per zone, densified
    over every zone (0), average-tie percentile ranks, weighted, round 4."""
    z = A.drop_null_keys
    facts = [
        z(trees, ["code_iris"]).groupBy("code_iris").agg(F.count("*").alias("arbres")),
        z(green, ["code_iris"]).groupBy("code_iris").agg(F.sum("superficie").alias("espaces_verts")),
        z(islands, ["code_iris"]).groupBy("code_iris").agg(F.count_distinct("id").alias("ilots_fraicheur")),
        z(stations, ["code_iris"]).groupBy("code_iris").agg(F.count("*").alias("trilib")),
    ]
    ref = zones.select(F.col("zone").alias("code_iris"), F.col("district").alias("arrondissement"))
    d = S.densify(ref, facts, "code_iris", fill=0)
    d = S.pct_rank_many(d, "code_iris", {c: f"pr_{c}" for c in WEIGHTS})
    d = S.weighted_score(d, {f"pr_{c}": w for c, w in WEIGHTS.items()}, "score", digits=4)
    return d.select("code_iris", "arrondissement", "score")


def cool_islands_silver(raw: DataFrame, zone_edges: DataFrame, cell: float,
                        target: DataFrame | None = None) -> DataFrame:
    """DP6 cool islands: shapes strictly within one zone (straddling ones
    dropped, JN3); the (id, postal code) key is de-duplicated inside the
    batch (the source file repeats identifiers)."""
    df = raw.select(F.col("IDENTIFIANT").alias("id"), F.col("Nom").alias("nom"),
                    C.to_int("Code postal").cast("int").alias("code_postal"), F.col("geo_shape"),
                    *carried(raw))
    df = unseen(C.drop_missing(df, ["geo_shape"]), target, ["id", "code_postal"])
    return polygons_in_zones(first_in_file(df, ["id", "code_postal"], ["nom"]), zone_edges, "within", cell)


def sorting_stations_silver(raw: DataFrame, zone_edges: DataFrame, cell: float,
                            target: DataFrame | None = None) -> DataFrame:
    """DP6 sorting stations: district from the label, shape within one zone."""
    df = raw.select(C.to_int("Identifiant").cast("int").alias("id"),
                    C.first_number("Arrondissement").alias("arrondissement"), F.col("geo_shape"))
    df = unseen(C.drop_missing(df, ["geo_shape"]), target, ["id"])
    return polygons_in_zones(df, zone_edges, "within", cell)
