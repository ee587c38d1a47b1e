"""Mobility (DP8, DP9): stops, stations and bike stations attached to zones,
and the mobility score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import score as S
from ..session import materialize
from .common import attach_zone, carried, first_in_file, unseen

# Stop types loaded, transit / bike weights and blend.
STOP_TYPES = ["bus", "cableway"]
TRANSIT = {"nb_arrets_bus": 0.30, "nb_gares_metro": 0.35, "nb_gares_rer": 0.15,
           "nb_gares_tramway": 0.12, "nb_gares_train": 0.05}
BIKES = {"nb_stations_velib": 0.40, "capacite_velib": 0.60}
BLEND = {"score_transport_collectif": 0.75, "score_velib": 0.25}


def stops_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame,
                 target: DataFrame | None = None) -> DataFrame:
    """DP8 stops: retained types, coordinates parsed, rows without a number as id
    dropped, Paris zones only, first row of the file per stop id, new ids only."""
    lat, lon = C.lat_lon("ArRGeopoint")
    df = raw.filter(F.col("ArRType").isin(*STOP_TYPES)).select(
        C.to_int("ArRId").alias("arret_id"), F.col("ArRName").alias("nom"), F.col("ArRType").alias("type"),
        lat.alias("lat"), lon.alias("lon"), *carried(raw))
    df = unseen(C.drop_missing(df, ["arret_id", "lat", "lon"]), target, ["arret_id"])
    return first_in_file(attach_zone(df, zone_edges, zones, how="inner"), ["arret_id"], ["nom", "lat", "lon"])


def stations_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame,
                    target: DataFrame | None = None) -> DataFrame:
    """DP8 rail stations of the region (``idf = 1``), as :func:`stops_silver`."""
    lat, lon = C.lat_lon("Geo Point")
    df = raw.filter(C.to_int("idf") == 1).select(
        C.to_int("gares_id").alias("gare_id"), F.col("nom_long").alias("nom"), F.col("mode"),
        F.col("res_com").alias("ligne"), F.col("exploitant"), lat.alias("lat"), lon.alias("lon"),
        *carried(raw))
    df = unseen(C.drop_missing(df, ["gare_id", "lat", "lon"]), target, ["gare_id"])
    return first_in_file(attach_zone(df, zone_edges, zones, how="inner"), ["gare_id"], ["nom", "ligne"])


def bikes_silver(raw: DataFrame, zone_edges: DataFrame, zones: DataFrame,
                 target: DataFrame | None = None) -> DataFrame:
    """DP8 bike stations with their capacity."""
    lat, lon = C.lat_lon("Coordonnées géographiques")
    df = raw.select(F.col("Identifiant station").alias("station_id"), F.col("Nom de la station").alias("nom"),
                    C.to_int("Capacité de la station").cast("int").alias("capacite"),
                    lat.alias("lat"), lon.alias("lon"), *carried(raw))
    df = unseen(C.drop_missing(df, ["lat", "lon"]), target, ["station_id"])
    return first_in_file(attach_zone(df, zone_edges, zones, how="inner"), ["station_id"], ["nom"])


def mobility_score(zones: DataFrame, stops: DataFrame, stations: DataFrame, bikes: DataFrame) -> DataFrame:
    """DP9: 7 counts per zone (FILTER pivots), min-max each (NULL -> 0),
    weighted transit and bike sub-scores min-maxed, blended, all ten measures
    rounded to 4 at the end, rank of the rounded score."""
    mode = F.col("mode")
    facts = [
        A.drop_null_keys(stops, ["code_iris"]).filter(F.col("type") == "bus")
        .groupBy("code_iris").agg(F.count("*").alias("nb_arrets_bus")),
        A.drop_null_keys(stations, ["code_iris"]).groupBy("code_iris").agg(
            A.count_filter(mode == "METRO").alias("nb_gares_metro"),
            A.count_filter(mode == "RER").alias("nb_gares_rer"),
            A.count_filter(mode == "TRAIN").alias("nb_gares_train"),
            A.count_filter(mode == "TRAMWAY").alias("nb_gares_tramway")),
        A.drop_null_keys(bikes, ["code_iris"]).groupBy("code_iris").agg(
            F.count("*").alias("nb_stations_velib"), A.sum_or_zero("capacite").alias("capacite_velib")),
    ]
    ref = zones.select(F.col("zone").alias("code_iris"), F.col("district").alias("arrondissement"))
    d = S.densify(ref, facts, "code_iris", fill=0)
    cols = list(TRANSIT) + list(BIKES)
    d = S.minmax(d, {c: f"norm_{c}" for c in cols}, fill=0)
    d = S.weighted_score(d, {f"norm_{c}": w for c, w in TRANSIT.items()}, "_t")
    d = S.weighted_score(d, {f"norm_{c}": w for c, w in BIKES.items()}, "_b")
    d = S.minmax(d, {"_t": "score_transport_collectif", "_b": "score_velib"}).drop("_t", "_b")
    d = S.weighted_score(d, BLEND, "score_mobilite")
    # One row per zone: the rank reads it several times.
    d = materialize(d.withColumns({c: C.round_dec(c, 4) for c in [*(f"norm_{c}" for c in cols), *BLEND, "score_mobilite"]}))
    return S.rank_desc(d, "score_mobilite", "rang_mobilite")
