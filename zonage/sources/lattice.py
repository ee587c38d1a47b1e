"""Synthetic geography over the driver's TPC-H-style tables.

The test tables carry no coordinates, so the geography is *derived by Spark
from the tables themselves*: every ``nation`` row is a zone (a quadrilateral
of a perturbed 5 × 5 lattice over [0, 5]²), every ``region`` a district, and
facts (customers, suppliers, parts) get coordinates from key arithmetic.
The zone layer therefore grows with the ``nation`` table and the point layers
with their fact tables.

Fixed values (shared with the SQL oracles in ``zonage.queries``):

* point:  ``x = ((key*7919) % 10007) / 10007 * 5``,
  ``y = ((key*104729) % 10009) / 10009 * 5``;
* lattice corner ``(i, j)``: on the border ``(i, j)``; inside
  ``x = (10*i + ((i*7 + j*13) % 5) - 2) / 10``,
  ``y = (10*j + ((i*11 + j*3) % 5) - 2) / 10``;
* zone ``z``: counter-clockwise quad with lower-left corner ``(z % 5, z div 5)``;
* box of part ``p``: lower-left ``(((p*3571) % 9973) / 9973 * 5.6 - 0.3,
  ((p*4099) % 9967) / 9967 * 5.6 - 0.3)``, width ``(5 + (p % 10) * 6) / 100``,
  height ``(5 + (p % 7) * 7) / 100``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID = 5


def key_x(key: Column) -> Column:
    return ((key * 7919) % 10007).cast("double") / 10007.0 * 5.0


def key_y(key: Column) -> Column:
    return ((key * 104729) % 10009).cast("double") / 10009.0 * 5.0


def _corner(i: Column, j: Column) -> tuple[Column, Column]:
    border = (i == 0) | (i == GRID) | (j == 0) | (j == GRID)
    xi = (i * 10 + (i * 7 + j * 13) % 5 - 2).cast("double") / 10.0
    yj = (j * 10 + (i * 11 + j * 3) % 5 - 2).cast("double") / 10.0
    return (F.when(border, i.cast("double")).otherwise(xi),
            F.when(border, j.cast("double")).otherwise(yj))


# Counter-clockwise corner offsets of a lattice cell.
_DI = [0, 1, 1, 0]
_DJ = [0, 0, 1, 1]


def zone_edges(nation: DataFrame, zone_col: str = "n_nationkey") -> DataFrame:
    """Edge table ``(id, part, ring, seq, x1, y1, x2, y2)`` of the nation zones."""
    z = F.col(zone_col).cast("long")
    base = nation.select(z.alias("id"), (z % GRID).alias("i0"),
                         ((z - z % GRID) / GRID).cast("long").alias("j0"))
    e = base.select("id", "i0", "j0", F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("seq"))
    di = F.array(*[F.lit(v) for v in _DI])
    dj = F.array(*[F.lit(v) for v in _DJ])
    k1 = F.col("seq") + 1
    k2 = (F.col("seq") + 1) % 4 + 1
    x1, y1 = _corner(F.col("i0") + F.element_at(di, k1), F.col("j0") + F.element_at(dj, k1))
    x2, y2 = _corner(F.col("i0") + F.element_at(di, k2), F.col("j0") + F.element_at(dj, k2))
    return e.select("id", F.lit(0).alias("part"), F.lit(0).alias("ring"), F.col("seq").cast("int"),
                    x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def with_point(df: DataFrame, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """Attach key-derived coordinates to a fact table."""
    k = F.col(key).cast("long")
    return df.withColumn(x, key_x(k)).withColumn(y, key_y(k))


def part_boxes(part: DataFrame) -> DataFrame:
    """``(id, box_x, box_y, box_w, box_h)`` boxes, one per part."""
    p = F.col("p_partkey").cast("long")
    return part.select(
        p.alias("id"),
        (((p * 3571) % 9973).cast("double") / 9973.0 * 5.6 - 0.3).alias("box_x"),
        (((p * 4099) % 9967).cast("double") / 9967.0 * 5.6 - 0.3).alias("box_y"),
        ((p % 10 * 6 + 5).cast("double") / 100.0).alias("box_w"),
        ((p % 7 * 7 + 5).cast("double") / 100.0).alias("box_h"),
    )


# --------------------------------------------------------------------------
# The same geography as SQL text for the DuckDB oracles.
# --------------------------------------------------------------------------

def sql_point(key: str, axis: str) -> str:
    if axis == "x":
        return f"(cast(({key}*7919) % 10007 as double) / 10007.0 * 5.0)"
    return f"(cast(({key}*104729) % 10009 as double) / 10009.0 * 5.0)"


def _sql_corner(i: str, j: str) -> tuple[str, str]:
    border = f"({i} = 0 or {i} = 5 or {j} = 0 or {j} = 5)"
    x = (f"(case when {border} then cast({i} as double) else "
         f"cast({i}*10 + ({i}*7 + {j}*13) % 5 - 2 as double) / 10.0 end)")
    y = (f"(case when {border} then cast({j} as double) else "
         f"cast({j}*10 + ({i}*11 + {j}*3) % 5 - 2 as double) / 10.0 end)")
    return x, y


def sql_zone_edges() -> str:
    """SQL producing ``(id, seq, x1, y1, x2, y2)`` from ``nation``."""
    ax, ay = _sql_corner("(i0 + [0,1,1,0][seq+1])", "(j0 + [0,0,1,1][seq+1])")
    bx2, by2 = _sql_corner("(i0 + [0,1,1,0][(seq+1)%4+1])", "(j0 + [0,0,1,1][(seq+1)%4+1])")
    return (
        "select id, seq, "
        f"{ax} as x1, {ay} as y1, {bx2} as x2, {by2} as y2 "
        "from (select cast(n_nationkey as bigint) as id, cast(n_nationkey as bigint) % 5 as i0, "
        "cast(n_nationkey as bigint) // 5 as j0, seq "
        "from nation, (select unnest([0,1,2,3]) as seq) s)"
    )


def sql_part_boxes() -> str:
    return (
        "select cast(p_partkey as bigint) as id, "
        "cast((p_partkey*3571) % 9973 as double) / 9973.0 * 5.6 - 0.3 as box_x, "
        "cast((p_partkey*4099) % 9967 as double) / 9967.0 * 5.6 - 0.3 as box_y, "
        "cast(p_partkey % 10 * 6 + 5 as double) / 100.0 as box_w, "
        "cast(p_partkey % 7 * 7 + 5 as double) / 100.0 as box_h from part"
    )


def sql_box_edges(boxes: str = "boxes") -> str:
    return (
        f"select id, seq, "
        "case seq when 0 then box_x when 1 then box_x+box_w when 2 then box_x+box_w else box_x end as x1, "
        "case seq when 0 then box_y when 1 then box_y when 2 then box_y+box_h else box_y+box_h end as y1, "
        "case seq when 0 then box_x+box_w when 1 then box_x+box_w when 2 then box_x else box_x end as x2, "
        "case seq when 0 then box_y when 1 then box_y+box_h when 2 then box_y+box_h else box_y end as y2 "
        f"from {boxes}, (select unnest([0,1,2,3]) as seq) s"
    )
