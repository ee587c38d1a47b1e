"""Shared plan helpers: zone attachment of located facts, first rows, new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import score as S
from ..operators import spatial as G
from ..operators.load import new_rows
from ..session import bounded_broadcast
from ..sources.readers import POSITION


def first_in_file(df: DataFrame, keys: list[str], otherwise: list) -> DataFrame:
    """WN6: the first row per key as the rows stand in the files, if the scan
    carried their position, else by the order ``otherwise``; without position."""
    order = [POSITION] if POSITION in df.columns else otherwise
    return S.keep_first(df, keys, order).drop(POSITION)


def carried(raw: DataFrame) -> list[str]:
    """The position column, where a scan carries one."""
    return [POSITION] if POSITION in raw.columns else []


def unseen(df: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key the target doesn't have; done before costly joins."""
    return df if target is None else new_rows(target, df, keys, null_safe=len(keys) > 1)


def attach_zone(df: DataFrame, zone_edges: DataFrame, zones: DataFrame, lat: str = "lat",
                lon: str = "lon", how: str = "left", cell: float | None = None,
                projected: bool = False) -> DataFrame:
    """JN1/JN2: attach ``code_iris``, ``nom_iris`` and ``arrondissement`` to
    located rows.  ``zones`` is the zone table ``(zone, name, district)``;
    ``zone_edges`` its edge table in the same coordinate system as the
    points (lon/lat, or Lambert-93 when ``projected``)."""
    from ..functions.geo import lambert93
    pts = df
    x, y = lon, lat
    if projected:
        px, py = lambert93(F.col(lon), F.col(lat))
        pts = pts.withColumn("_px", px).withColumn("_py", py)
        x, y = "_px", "_py"
    j = G.points_in_zones(pts, zone_edges, x, y, cell, "code_iris", how=how)
    ref = bounded_broadcast(zones.select(F.col("zone").alias("code_iris"), F.col("name").alias("nom_iris"),
                                         F.col("district").alias("arrondissement")))
    out = j.join(ref, "code_iris", "left")
    return out.drop("_px", "_py") if projected else out
