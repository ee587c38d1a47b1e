"""Geographic column functions: WGS84 → Lambert-93 projection (SF16).

The projection is the closed-form Lambert conformal conic with two standard
parallels, written as JVM-side Column math (no geometry library).  The
ellipsoid and projection parameters are the public EPSG:2154 definition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# EPSG:2154 (RGF93 / Lambert-93) on the GRS80 ellipsoid.
A = 6378137.0
FLATTENING = 1 / 298.257222101
LON0_DEG = 3.0
LAT0_DEG = 46.5
LAT1_DEG = 44.0
LAT2_DEG = 49.0
X0 = 700000.0
Y0 = 6600000.0

E = math.sqrt(FLATTENING * (2 - FLATTENING))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (E * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    s = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - E * s) / (1 + E * s)) ** (E / 2)


_p0, _p1, _p2 = (math.radians(v) for v in (LAT0_DEG, LAT1_DEG, LAT2_DEG))
N = (math.log(_m(_p1)) - math.log(_m(_p2))) / (math.log(_t(_p1)) - math.log(_t(_p2)))
AF = A * _m(_p1) / (N * _t(_p1) ** N)
RHO0 = AF * _t(_p0) ** N
LON0 = math.radians(LON0_DEG)


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(lon°, lat°) → (x, y) metres in Lambert-93."""
    phi = F.radians(lat)
    s = F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2.0) / F.pow((1.0 - F.lit(E) * s) / (1.0 + F.lit(E) * s), E / 2)
    rho = F.lit(AF) * F.pow(t, N)
    theta = F.lit(N) * (F.radians(lon) - F.lit(LON0))
    return F.lit(X0) + rho * F.sin(theta), F.lit(Y0) + F.lit(RHO0) - rho * F.cos(theta)


def lambert93_sql(lon: str, lat: str) -> tuple[str, str]:
    """SQL twin of :func:`lambert93` (constants as exact double literals)."""
    def d(v: float) -> str:
        return f"cast('{v!r}' as double)"
    phi = f"radians({lat})"
    s = f"sin({phi})"
    t = (f"(tan({d(math.pi / 4)} - {phi} / 2.0) / "
         f"pow((1.0 - {d(E)} * {s}) / (1.0 + {d(E)} * {s}), {d(E / 2)}))")
    rho = f"({d(AF)} * pow({t}, {d(N)}))"
    theta = f"({d(N)} * (radians({lon}) - {d(LON0)}))"
    return (f"({d(X0)} + {rho} * sin({theta}))", f"({d(Y0)} + {d(RHO0)} - {rho} * cos({theta}))")


def project_edges(edges):
    """Edge table in lon/lat -> the same edges in Lambert-93 metres."""
    x1, y1 = lambert93(F.col("x1"), F.col("y1"))
    x2, y2 = lambert93(F.col("x2"), F.col("y2"))
    keep = [c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")]
    return edges.select(*keep, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
