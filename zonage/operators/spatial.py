"""Spatial joins as relational Spark plans (JN1–JN6, SF16 area).

Geometry model
--------------
A polygon layer is an **edge table** ``(id, part, ring, seq, x1, y1, x2, y2)``:
one row per directed boundary segment, ``part`` = polygon of a multipolygon,
``ring`` 0 = shell, >0 = holes.  Points are two double columns.

Index
-----
The plane is cut into square cells, by a quadtree of levels: cells of level 0
have the side ``cell``, those of each further level twice the side of the one
before.  A box lies on the first level where it spans no more than a few cells,
so what covers a country takes as many cells as what covers a street.

For point-in-polygon a point only needs, for each zone whose bounding box covers
its cell, the zone edges that cross the point's horizontal band (the ray cast to
+x meets only those).  :func:`zone_index` materialises that as one row per cell
holding an array of ``(zone, edges)``; it is dimension-sized (zones × cells, the
cells of a zone being no more than its edges, a few at least), built with
ordinary ``groupBy``/``collect_list`` and broadcast only after a row-count
check.  Points then need one equi-join on ``(cx, cy)`` for each level that the
layer has (one, where zones are of like size) and a JVM-side higher-order-function
parity test: no shuffle of the point side and no ``groupBy`` over points, so a
hot cell holding a third of all points is just a long map-side stream.

Polygon/polygon predicates join boxes (segments, polygons, points) level by
level (:func:`boxes_sharing_cells`): a pair meets on the higher one of its two
levels only, and there in one cell.  Segments are tested by orientation signs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bounded_broadcast, broadcast_fits, materialize, side_by_side

EDGE_COLS = ["x1", "y1", "x2", "y2"]


# --------------------------------------------------------------------------
# building edge tables
# --------------------------------------------------------------------------

def polygon_edges(df: DataFrame, id_col: str, coords_col: str,
                  multi: bool = True, orient: bool = True) -> DataFrame:
    """Explode polygon coordinates into the edge table.

    ``coords_col`` is ``array<array<array<array<double>>>>`` (part → ring →
    vertex → [x, y]) when ``multi`` else ``array<array<array<double>>>``.
    Rings may be closed (last vertex = first) or open; closing edges are
    generated from consecutive vertices modulo the ring length.  With
    ``orient`` shells come out counter-clockwise and holes clockwise (the
    ring's vertex array is reversed when its signed area has the wrong sign,
    computed per row with a higher-order function — no shuffle).
    """
    parts = F.col(coords_col) if multi else F.array(F.col(coords_col))
    p = df.select(F.col(id_col).alias("id"), F.posexplode(parts).alias("part", "rings"))
    r = p.select("id", "part", F.posexplode("rings").alias("ring", "verts"))
    # drop an explicit closing vertex so every ring is a cycle of distinct positions
    r = r.withColumn(
        "verts",
        F.when((F.size("verts") > 1) & (F.element_at("verts", 1) == F.element_at("verts", -1)),
               F.slice("verts", 1, F.size("verts") - 1)).otherwise(F.col("verts")),
    )
    if orient:
        n = F.size("verts")
        signed = F.aggregate(
            F.sequence(F.lit(1), n), F.lit(0.0),
            lambda acc, i: acc + (F.element_at("verts", i)[0] * F.element_at("verts", i % n + 1)[1]
                                  - F.element_at("verts", i % n + 1)[0] * F.element_at("verts", i)[1]))
        flip = ((F.col("ring") == 0) & (signed < 0)) | ((F.col("ring") > 0) & (signed > 0))
        r = r.withColumn("verts", F.when(flip, F.reverse("verts")).otherwise(F.col("verts")))
    v = r.select("id", "part", "ring", "verts",
                 F.posexplode("verts").alias("seq", "a"))
    nxt = F.element_at("verts", ((F.col("seq") + 1) % F.size("verts")) + 1)
    return v.select(
        "id", "part", "ring", "seq",
        F.col("a")[0].cast("double").alias("x1"), F.col("a")[1].cast("double").alias("y1"),
        nxt[0].cast("double").alias("x2"), nxt[1].cast("double").alias("y2"),
    )


def box_edges(df: DataFrame, id_col: str, x0: str, y0: str, w: str, h: str) -> DataFrame:
    """Edge table of axis-aligned boxes, counter-clockwise."""
    corners = F.array(
        F.struct(F.col(x0).alias("x"), F.col(y0).alias("y")),
        F.struct((F.col(x0) + F.col(w)).alias("x"), F.col(y0).alias("y")),
        F.struct((F.col(x0) + F.col(w)).alias("x"), (F.col(y0) + F.col(h)).alias("y")),
        F.struct(F.col(x0).alias("x"), (F.col(y0) + F.col(h)).alias("y")),
    )
    b = df.select(F.col(id_col).alias("id"), corners.alias("c"))
    b = b.select("id", "c", F.posexplode("c").alias("seq", "a"))
    nxt = F.element_at("c", ((F.col("seq") + 1) % 4) + 1)
    return b.select("id", F.lit(0).alias("part"), F.lit(0).alias("ring"), "seq",
                    F.col("a.x").alias("x1"), F.col("a.y").alias("y1"),
                    nxt["x"].alias("x2"), nxt["y"].alias("y2"))


# --------------------------------------------------------------------------
# cells
# --------------------------------------------------------------------------

def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(float(cell))).cast("long")


def _cells(lo: Column, hi: Column, cell: float) -> Column:
    return F.sequence(_cell(lo, cell), _cell(hi, cell))


# A box spans at most this many cells of its level along an axis, and one more
# where it isn't aligned with them.
SPAN = 4
# The last level: a join handles at most LEVELS + 1 of them.
LEVELS = 40


def _level(extent: Column, cell: float, span: Column | None = None) -> Column:
    """First level on which ``extent`` spans at most ``span`` cells."""
    times = extent / (F.lit(float(cell)) * (F.lit(float(SPAN)) if span is None else span))
    # log2 is NULL where the extent is 0, which the two bounds skip.
    return F.least(F.lit(LEVELS), F.greatest(F.lit(0), F.ceil(F.log2(times)).cast("int")))


def _side(level: Column, cell: float) -> Column:
    """Side of the cells of a level (a power of two times ``cell``)."""
    return F.lit(float(cell)) * F.pow(F.lit(2.0), level)


def _cell_at(v: Column, level: Column, cell: float) -> Column:
    return F.floor(v / _side(level, cell)).cast("long")


def edge_box() -> tuple[Column, Column, Column, Column]:
    """Bounding box of a row of an edge table."""
    return F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2")


def polygon_box() -> tuple[Column, Column, Column, Column]:
    """Box of a row of :func:`bboxes`."""
    return F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy")


def _box_level(box: tuple[Column, ...], cell: float) -> Column:
    return _level(F.greatest(box[2] - box[0], box[3] - box[1]), cell)


def box_levels(cell: float, **layers: tuple[DataFrame, tuple[Column, ...]]) -> dict[str, list[int]]:
    """The levels of each layer's boxes, by one aggregate that returns at most
    ``LEVELS`` + 1 rows a layer."""
    rows = [df.select(F.lit(name).alias("layer"), _box_level(box, cell).alias("level")) for name, (df, box) in layers.items()]
    found = reduce(DataFrame.unionByName, rows).distinct().collect()
    return {name: sorted(r["level"] for r in found if r["layer"] == name) for name in layers}


def _boxed(df: DataFrame, box: tuple[Column, ...], cell: float, side: str) -> DataFrame:
    """Columns as ``<side>_<name>``, with the box and its level; rows without a box go."""
    names = [f"{side}{c}" for c in ("minx", "miny", "maxx", "maxy")]
    b = df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns], *[v.alias(n) for v, n in zip(box, names)])
    return b.filter(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull()) \
            .withColumn(f"{side}level", _box_level(tuple(F.col(n) for n in names), cell))


def _on_levels(boxes: DataFrame, own: list[int], other: list[int], cell: float, side: str) -> DataFrame:
    """One row per cell that a box covers on its own level and on every higher
    level of the other side's boxes."""
    level = F.col(f"{side}level")
    higher = [n for n in other if n > min(own, default=0)]
    if not higher:
        b = boxes.withColumn("level", F.lit(own[0]) if len(own) == 1 else level)
    else:
        levels = F.array_union(F.array(level), F.array(*[F.lit(n) for n in higher]))
        b = boxes.withColumn("level", F.explode(levels)).filter(F.col("level") >= level)
    for axis, cells in (("x", "cx"), ("y", "cy")):
        lo, hi = (_cell_at(F.col(f"{side}{end}{axis}"), F.col("level"), cell) for end in ("min", "max"))
        b = b.withColumn(cells, F.explode(F.sequence(lo, hi)))
    return b


def boxes_sharing_cells(a: DataFrame, a_box: tuple[Column, ...], b: DataFrame, b_box: tuple[Column, ...],
                        cell: float, levels: tuple[list[int], list[int]] | None = None, small: bool = False) -> DataFrame:
    """Pairs of rows, as columns ``a_*`` and ``b_*``, whose boxes ``(minx, miny,
    maxx, maxy)`` share a cell of the higher one of their levels, each pair once;
    all pairs whose boxes overlap are among them.

    Every row is put on its own level and on the other side's higher ones, so
    two boxes meet on the higher one of their levels, whatever their sizes; a
    pair that shares several cells is kept in the first of them, so no
    ``distinct`` shuffle is needed.  ``levels``: those of both sides, if known
    (:func:`box_levels`).  ``small``: ``b`` is broadcast if it is found to be small
    enough.  Rows without coordinates meet nothing."""
    if levels is None:
        levels = tuple(box_levels(cell, a=(a, a_box), b=(b, b_box)).values())
    left, right = _boxed(a, a_box, cell, "a"), _boxed(b, b_box, cell, "b")
    on_left = _on_levels(left, levels[0], levels[1], cell, "a")
    on_right = _on_levels(right, levels[1], levels[0], cell, "b")
    j = on_left.join(bounded_broadcast(on_right) if small else on_right, ["level", "cx", "cy"])
    meet = F.col("level") == F.greatest("alevel", "blevel")
    for axis, cells in (("x", "cx"), ("y", "cy")):
        meet &= F.col(cells) == _cell_at(F.greatest(f"amin{axis}", f"bmin{axis}"), F.col("level"), cell)
    return j.filter(meet).select(*[F.col(f"a_{c}") for c in a.columns], *[F.col(f"b_{c}") for c in b.columns])


def bboxes(edges: DataFrame, *more: Column) -> DataFrame:
    """Per-id bounding box ``(id, minx, miny, maxx, maxy)`` and ``more`` aggregates."""
    return edges.groupBy("id").agg(
        F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"),
        F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"), *more,
    )


def auto_cell_size(edges: DataFrame) -> float:
    """Median bounding-box side of the layer — a cell about one zone wide keeps
    both the candidate zones per point and the edges per band small.  One
    aggregate over a dimension-sized table."""
    b = bboxes(edges)
    side = b.select(F.median(F.greatest(F.col("maxx") - F.col("minx"),
                                        F.col("maxy") - F.col("miny")))).first()[0]
    return float(side) if side and side > 0 else 1.0


# --------------------------------------------------------------------------
# point in polygon
# --------------------------------------------------------------------------

def zone_index(edges: DataFrame, cell: float, persist: bool = True) -> DataFrame:
    """Grid index ``(level, cx, cy, zones: array<struct<zone, edges>>)`` (see
    module doc).  A zone lies on the first level where it covers no more cells
    than it has edges (``SPAN`` squared at least).

    The index is layer-sized; with ``persist`` it is written once to the shared
    checkpoint folder so that the size check of
    :func:`zonage.session.bounded_broadcast` and the join reuse it instead of
    recomputing it."""
    span = F.greatest(F.lit(float(SPAN)), F.floor(F.sqrt(F.size("edges"))).cast("double"))
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    zones = bboxes(edges, F.collect_list(F.struct(*EDGE_COLS)).alias("edges")).withColumnRenamed("id", "zone") \
        .withColumn("level", _level(extent, cell, span))
    level = F.col("level")
    zone_cells = zones.select("zone", "level", "miny", "maxy", F.explode(
        F.sequence(_cell_at(F.col("minx"), level, cell), _cell_at(F.col("maxx"), level, cell))).alias("cx"))
    zone_cells = zone_cells.select("zone", "level", "cx", F.explode(
        F.sequence(_cell_at(F.col("miny"), level, cell), _cell_at(F.col("maxy"), level, cell))).alias("cy"))
    bands = zones.select("zone", "level", F.explode("edges").alias("e")).select("zone", "level", "e.*").select(
        "zone", *EDGE_COLS,
        F.explode(F.sequence(_cell_at(F.least("y1", "y2"), level, cell),
                             _cell_at(F.greatest("y1", "y2"), level, cell))).alias("cy"))
    per_band = bands.groupBy("zone", "cy").agg(
        F.collect_list(F.struct(*EDGE_COLS)).alias("edges"))
    idx = (zone_cells.join(per_band, ["zone", "cy"])
           .groupBy("level", "cx", "cy")
           .agg(F.collect_list(F.struct("zone", "edges")).alias("zones")))
    return materialize(idx) if persist else idx


def _index_items(zones: str) -> Column:
    """Number of edges held by one grid-index row (broadcast size bound)."""
    return F.aggregate(F.col(zones), F.lit(0), lambda acc, z: acc + F.size(z["edges"]))


def _crosses(e: Column, px: Column, py: Column) -> Column:
    """Half-open even–odd rule: the +x ray from (px, py) crosses edge ``e``."""
    straddles = (e["y1"] > py) != (e["y2"] > py)
    x_at = F.try_divide((e["x2"] - e["x1"]) * (py - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
    return straddles & (px < x_at)


def _on_edge(e: Column, px: Column, py: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
    return ((cross == 0)
            & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))


def containing_zones(zones: Column, px: Column, py: Column, strict: bool = False) -> Column:
    """Array of zone ids whose boundary the point is inside (parity odd).
    ``strict`` also drops points lying exactly on a boundary (``within``)."""
    def inside(z):
        n = F.aggregate(z["edges"], F.lit(0),
                        lambda acc, e: acc + F.when(_crosses(e, px, py), 1).otherwise(0))
        ok = (n % 2) == 1
        if strict:
            ok = ok & ~F.exists(z["edges"], lambda e: _on_edge(e, px, py))
        return ok
    return F.transform(F.filter(zones, inside), lambda z: z["zone"])


def _with_hits(points: DataFrame, index: DataFrame, x: str, y: str, cell: float, strict: bool) -> DataFrame:
    """``points`` with ``_hits``, the zones that each lies in: one join per level
    of the index, of which there are at most ``LEVELS`` + 1."""
    sizes = index.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum(_index_items("zones")).alias("k")).collect()
    levels = sorted((r["level"], broadcast_fits(r["n"], r["k"])) for r in sizes)
    out, hits = points, F.array().cast(T.ArrayType(index.schema["zones"].dataType.elementType["zone"].dataType))
    for n, small in levels:
        # The cell as an expression of the point: points go through every join as they are.
        of_level = index.filter(F.col("level") == n) \
            .select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("zones").alias("_zones"))
        side = cell * 2.0 ** n
        out = out.join(F.broadcast(of_level) if small else of_level, (_cell(F.col(x), side) == F.col("_cx")) & (_cell(F.col(y), side) == F.col("_cy")), "left")
        found = F.coalesce(containing_zones(F.col("_zones"), F.col(x), F.col(y), strict), F.array())
        earlier = [F.col("_hits")] if "_hits" in out.columns else []
        out = out.withColumn("_hits", F.concat(*earlier, found) if earlier else found).drop("_cx", "_cy", "_zones")
    return out if levels else out.withColumn("_hits", hits)


def points_in_zones(points: DataFrame, zone_edges: DataFrame, x: str, y: str,
                    cell: float | None = None, zone_col: str = "zone",
                    how: str = "left", strict: bool = False,
                    index: DataFrame | None = None) -> DataFrame:
    """JN1/JN2: attach the containing zone to every point.

    ``how='left'`` keeps unmatched points with a NULL zone, ``'inner'`` drops
    them.  Zones are assumed to form a partition (a point is inside at most
    one zone); if they overlap the smallest zone id wins.  Points with a NULL
    coordinate never match.  An ``index`` goes with the ``cell`` it was built for.
    """
    if index is None:
        cell = cell or auto_cell_size(zone_edges)
        index = zone_index(zone_edges, cell)
    out = _with_hits(points, index, x, y, cell, strict).withColumn(zone_col, F.array_min("_hits")).drop("_hits")
    if how == "inner":
        out = out.filter(F.col(zone_col).isNotNull())
    return out


def points_in_zones_all(points: DataFrame, index: DataFrame, x: str, y: str, cell: float,
                        zone_col: str = "zone", strict: bool = False) -> DataFrame:
    """Like :func:`points_in_zones` but one output row per containing zone
    (for overlapping layers, e.g. polygons tested against vertices)."""
    return _with_hits(points, index, x, y, cell, strict).withColumn(zone_col, F.explode("_hits")).drop("_hits")


# --------------------------------------------------------------------------
# tests against a *named* polygon: per-polygon band tables
# --------------------------------------------------------------------------

def band_edges(edges: DataFrame, cell: float, persist: bool = True) -> DataFrame:
    """``(id, cy, edges)``: for every polygon, the edges crossing each
    horizontal band of height ``cell``.  A point inside a polygon has the
    boundary crossing its +x ray, and that edge spans the point's band, so a
    parity test needs only ``(polygon, band)``'s edges — whatever the number
    of other polygons around."""
    b = edges.select("id", *EDGE_COLS,
                     F.explode(_cells(F.least("y1", "y2"), F.greatest("y1", "y2"), cell)).alias("cy"))
    out = b.groupBy("id", "cy").agg(F.collect_list(F.struct(*EDGE_COLS)).alias("edges"))
    return materialize(out) if persist else out


def _parity(edges: Column, px: Column, py: Column) -> Column:
    n = F.aggregate(edges, F.lit(0), lambda acc, e: acc + F.when(_crosses(e, px, py), 1).otherwise(0))
    return (n % 2) == 1


def inside_named(points: DataFrame, poly_col: str, x: str, y: str, bands: DataFrame,
                 cell: float) -> DataFrame:
    """Rows of ``points`` lying inside the polygon named in ``poly_col``
    (equi-join on ``(polygon, band)`` + JVM-side parity)."""
    b = bounded_broadcast(bands.select(F.col("id").alias("_bid"), F.col("cy").alias("_bcy"), "edges"),
                          items=F.size("edges"))
    j = points.withColumn("_cy", _cell(F.col(y), cell)).join(
        b, (F.col(poly_col) == F.col("_bid")) & (F.col("_cy") == F.col("_bcy")))
    return j.filter(_parity(F.col("edges"), F.col(x), F.col(y))).drop("_cy", "_bid", "_bcy", "edges")


def vertices_in_polygons(vertices: DataFrame, polys: DataFrame, bands: DataFrame,
                         cell: float, levels: list[int]) -> DataFrame:
    """``(id, poly)``: vertex owners ``id`` whose point ``(px, py)`` lies in
    polygon ``poly``.  Candidates are the polygons whose bounding box, on one of
    ``levels``, shares a cell with the point, then :func:`inside_named`."""
    point = (F.col("px"), F.col("py"), F.col("px"), F.col("py"))
    cand = boxes_sharing_cells(vertices, point, bboxes(polys), polygon_box(), cell, ([0], levels)) \
        .select(F.col("a_id").alias("id"), F.col("a_px").alias("px"), F.col("a_py").alias("py"), F.col("b_id").alias("poly"))
    return inside_named(cand, "poly", "px", "py", bands, cell).select("id", "poly")


# --------------------------------------------------------------------------
# polygon / polygon predicates
# --------------------------------------------------------------------------

def _orient(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def layer_levels(features: DataFrame, zones: DataFrame, cell: float) -> dict[str, list[int]]:
    """Levels of the edges and of the polygons of two layers."""
    return box_levels(cell, f_edges=(features, edge_box()), z_edges=(zones, edge_box()),
                      f=(bboxes(features), polygon_box()), z=(bboxes(zones), polygon_box()))


def _prepared(features: DataFrame, zones: DataFrame, cell: float) -> tuple[dict[str, list[int]], DataFrame, DataFrame]:
    """Levels and band tables of two layers, by jobs that run at the same time."""
    return side_by_side(features.sparkSession, lambda: layer_levels(features, zones, cell),
                        lambda: band_edges(features, cell), lambda: band_edges(zones, cell))


def segment_pairs(features: DataFrame, zones: DataFrame, cell: float,
                  levels: tuple[list[int], list[int]] | None = None) -> DataFrame:
    """Candidate segment pairs ``(fid, zid, f*, z*, o1..o4)`` whose bounding
    boxes overlap, each pair once, with the four orientation values.  Candidates
    share a cell (:func:`boxes_sharing_cells`)."""
    j = boxes_sharing_cells(features, edge_box(), zones, edge_box(), cell, levels, small=True)
    j = j.select(*[F.col(f"{side}_{c}").alias(f"{to}{c}") for side, to in (("a", "f"), ("b", "z"))
                   for c in ("id", "part", "ring", "seq", *EDGE_COLS) if f"{side}_{c}" in j.columns])
    lox = F.greatest(F.least("fx1", "fx2"), F.least("zx1", "zx2"))
    loy = F.greatest(F.least("fy1", "fy2"), F.least("zy1", "zy2"))
    j = j.filter((lox <= F.least(F.greatest("fx1", "fx2"), F.greatest("zx1", "zx2")))
                 & (loy <= F.least(F.greatest("fy1", "fy2"), F.greatest("zy1", "zy2"))))
    f = {c: F.col(f"f{c}") for c in EDGE_COLS}
    z = {c: F.col(f"z{c}") for c in EDGE_COLS}
    ids = [c for c in j.columns if c[1:] in ("part", "ring", "seq")]
    return j.select(
        "fid", "zid", *ids, *[F.col(f"f{c}") for c in EDGE_COLS], *[F.col(f"z{c}") for c in EDGE_COLS],
        _orient(f["x1"], f["y1"], f["x2"], f["y2"], z["x1"], z["y1"]).alias("o1"),
        _orient(f["x1"], f["y1"], f["x2"], f["y2"], z["x2"], z["y2"]).alias("o2"),
        _orient(z["x1"], z["y1"], z["x2"], z["y2"], f["x1"], f["y1"]).alias("o3"),
        _orient(z["x1"], z["y1"], z["x2"], z["y2"], f["x2"], f["y2"]).alias("o4"),
    )


def _proper(p: DataFrame) -> Column:
    return ((F.col("o1") * F.col("o2")) < 0) & ((F.col("o3") * F.col("o4")) < 0)


def _touching(p: DataFrame) -> Column:
    overlap = ((F.least("fx1", "fx2") <= F.greatest("zx1", "zx2"))
               & (F.least("zx1", "zx2") <= F.greatest("fx1", "fx2"))
               & (F.least("fy1", "fy2") <= F.greatest("zy1", "zy2"))
               & (F.least("zy1", "zy2") <= F.greatest("fy1", "fy2")))
    return (((F.col("o1") * F.col("o2")) <= 0) & ((F.col("o3") * F.col("o4")) <= 0) & overlap)


def _first_vertices(edges: DataFrame) -> DataFrame:
    """First shell vertex of every part: parts may lie far apart."""
    return edges.filter((F.col("ring") == 0) & (F.col("seq") == 0)) \
                .select("id", F.col("x1").alias("px"), F.col("y1").alias("py"))


def _meeting(f: DataFrame, z: DataFrame, fb: DataFrame, zb: DataFrame, hit: DataFrame, cell: float,
             levels: dict[str, list[int]]) -> DataFrame:
    """``(fid, zone)`` pairs that share a point: their boundaries meet (``hit``),
    or a part of one lies inside the other."""
    f_in_z = vertices_in_polygons(_first_vertices(f), z, zb, cell, levels["z"]) \
        .select(F.col("id").alias("fid"), F.col("poly").alias("zone"))
    z_in_f = vertices_in_polygons(_first_vertices(z), f, fb, cell, levels["f"]) \
        .select(F.col("poly").alias("fid"), F.col("id").alias("zone"))
    return hit.select("fid", F.col("zid").alias("zone")).unionByName(f_in_z).unionByName(z_in_f).distinct()


def _cuts(hit: DataFrame, side: str) -> DataFrame:
    """Where the edges of one side (``f`` or ``z``) are cut by the other's:
    positions from 0 to 1 per edge and pair."""
    a, b = ("o3", "o4") if side == "f" else ("o1", "o2")
    return (hit.filter(F.col(a) != F.col(b))
            .groupBy("fid", F.col("zid").alias("zone"), *[F.col(f"{side}{c}").alias(c) for c in ("part", "ring", "seq")])
            .agg(F.collect_list(F.col(a) / (F.col(a) - F.col(b))).alias("ts")))


def features_in_zones(features: DataFrame, zones: DataFrame, predicate: str = "within",
                      cell: float | None = None) -> DataFrame:
    """JN3/JN4: ``(fid, zone)`` pairs of a polygon layer against the zones.

    * ``within``: the zone covers the feature, contact with its boundary
      allowed: every piece of the feature's edges, split where the zone's edges
      meet them, lies inside the zone or on its boundary, and no piece of the
      zone's edges lies inside the feature (as a hole of the zone would).  A
      feature straddling two zones matches none.
    * ``intersects``: boundaries meet (closed segment test), or the first vertex
      of a part of one polygon lies inside the other.

    ``cell`` is derived from the zones' sizes if not given.
    """
    if predicate not in ("within", "intersects"):
        raise ValueError(f"unknown predicate {predicate!r}")
    cell = cell or auto_cell_size(zones)
    levels, fb, zb = _prepared(features, zones, cell)
    segs = segment_pairs(features, zones, cell, (levels["f_edges"], levels["z_edges"]))
    hit = materialize(segs.filter(_touching(segs)))
    pairs = _meeting(features, zones, fb, zb, hit, cell, levels)
    if predicate == "intersects":
        return pairs
    fbox, zbox = bboxes(features), bboxes(zones)
    f, z = fbox.alias("f"), zbox.alias("z")
    inside_box = (pairs.join(f, pairs["fid"] == F.col("f.id")).join(z, pairs["zone"] == F.col("z.id"))
                  .filter((F.col("f.minx") >= F.col("z.minx")) & (F.col("f.maxx") <= F.col("z.maxx"))
                          & (F.col("f.miny") >= F.col("z.miny")) & (F.col("f.maxy") <= F.col("z.maxy")))
                  .select("fid", "zone"))
    inside_box = materialize(inside_box)
    out = _pieces(features, inside_box, "fid", "zone", _cuts(hit, "f"), zb, zbox, cell, (levels["f_edges"], levels["z"])) \
        .filter(~F.col("on") & ~F.col("inside"))
    held = _pieces(zones, inside_box, "zone", "fid", _cuts(hit, "z"), fb, fbox, cell, (levels["z_edges"], levels["f"])) \
        .filter(~F.col("on") & F.col("inside"))
    bad = out.select("fid", "zone").unionByName(held.select("fid", "zone")).distinct()
    return inside_box.join(bad, ["fid", "zone"], "left_anti")


# --------------------------------------------------------------------------
# adjacency and area
# --------------------------------------------------------------------------

def adjacency(edges: DataFrame, cell: float | None = None, digits: int = 9) -> DataFrame:
    """JN6: ordered neighbour pairs ``(zone, nzone)``, zone ≠ nzone.

    Zones are neighbours when their boundaries meet: a shared vertex (equi-
    join on the rounded vertex key), or two edges that touch or cross (closed
    segment test on shared cells; a vertex on the other's edge is one case).
    """
    cell = cell or auto_cell_size(edges)
    v = edges.select(F.col("id").alias("zone"),
                     F.round("x1", digits).alias("kx"), F.round("y1", digits).alias("ky")).distinct()
    shared = (v.alias("a").join(v.alias("b"), ["kx", "ky"])
              .filter(F.col("a.zone") != F.col("b.zone"))
              .select(F.col("a.zone").alias("zone"), F.col("b.zone").alias("nzone")))
    segs = segment_pairs(edges, edges, cell)
    met = segs.filter((F.col("fid") != F.col("zid")) & _touching(segs)) \
              .select(F.col("fid").alias("zone"), F.col("zid").alias("nzone"))
    return shared.unionByName(met).distinct()


def polygon_area(edges: DataFrame) -> DataFrame:
    """SF16: area per id by the shoelace formula; shells count positive and
    holes negative whatever their orientation."""
    rings = edges.groupBy("id", "part", "ring").agg(
        (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2.0).alias("signed"))
    ring_area = F.when(F.col("ring") == 0, F.abs("signed")).otherwise(-F.abs(F.col("signed")))
    return rings.groupBy("id").agg(F.sum(ring_area).alias("area"))


# --------------------------------------------------------------------------
# overlay area (JN5)
# --------------------------------------------------------------------------

def orient_rings(edges: DataFrame) -> DataFrame:
    """Orient shells counter-clockwise and holes clockwise (swap endpoints of
    rings whose signed area has the wrong sign) so boundary integrals add up."""
    signed = edges.groupBy("id", "part", "ring").agg(
        F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("_s"))
    j = edges.join(signed, ["id", "part", "ring"])
    flip = ((F.col("ring") == 0) & (F.col("_s") < 0)) | ((F.col("ring") > 0) & (F.col("_s") > 0))
    return j.select("id", "part", "ring", "seq",
                    F.when(flip, F.col("x2")).otherwise(F.col("x1")).alias("x1"),
                    F.when(flip, F.col("y2")).otherwise(F.col("y1")).alias("y1"),
                    F.when(flip, F.col("x1")).otherwise(F.col("x2")).alias("x2"),
                    F.when(flip, F.col("y1")).otherwise(F.col("y2")).alias("y2"))


def _near_edge(e: Column, px: Column, py: Column, rel_tol: float = 1e-9) -> Column:
    """Point on segment ``e`` up to a relative tolerance (midpoints of pieces
    are computed values, so exact zero cross products cannot be relied on)."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    cross = dx * (py - e["y1"]) - dy * (px - e["x1"])
    len2 = dx * dx + dy * dy
    t = F.try_divide(dx * (px - e["x1"]) + dy * (py - e["y1"]), len2)
    return (F.abs(cross) <= F.lit(rel_tol) * len2) & (t >= -rel_tol) & (t <= 1 + rel_tol)


def _edges_near(own: DataFrame, boxes: DataFrame, cell: float, levels: tuple[list[int], list[int]]) -> DataFrame:
    """``own``'s edges with each polygon (``poly``) whose bounding box shares a
    cell with the edge's; an edge far from a polygon is never paired with it."""
    j = boxes_sharing_cells(own, edge_box(), boxes, polygon_box(), cell, levels)
    return j.select(*[F.col(f"a_{c}").alias(c) for c in own.columns], F.col("b_id").alias("poly"))


def _pieces(own_edges: DataFrame, pairs: DataFrame, own_key: str, other_key: str, cuts: DataFrame,
            other_bands: DataFrame, other_boxes: DataFrame, cell: float,
            levels: tuple[list[int], list[int]]) -> DataFrame:
    """Pieces of ``own`` edges (split at the cut positions) near the paired
    polygon: end points, and whether the middle lies ``on`` the other's boundary
    (``same``: along an edge that runs the same way) or ``inside`` it by the
    even–odd rule (half-open; meaningful where it isn't ``on``)."""
    e = _edges_near(own_edges.withColumnRenamed("id", own_key), other_boxes, cell, levels) \
        .withColumnRenamed("poly", other_key)
    e = e.join(pairs, [own_key, other_key])
    e = e.join(cuts, [own_key, other_key, "part", "ring", "seq"], "left")
    ts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)),
                                                F.coalesce(F.col("ts"), F.array().cast("array<double>")))))
    e = e.withColumn("ts", ts)
    piece = F.explode(F.transform(F.sequence(F.lit(2), F.size("ts")),
                                  lambda i: F.struct(F.element_at("ts", i - 1).alias("ta"),
                                                     F.element_at("ts", i).alias("tb"))))
    p = e.select(own_key, other_key, *EDGE_COLS, piece.alias("pc"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ta, tb = F.col("pc.ta"), F.col("pc.tb")
    tm = (ta + tb) / 2.0
    p = p.select(own_key, other_key,
                 (F.col("x1") + dx * ta).alias("ax"), (F.col("y1") + dy * ta).alias("ay"),
                 (F.col("x1") + dx * tb).alias("bx"), (F.col("y1") + dy * tb).alias("by"),
                 (F.col("x1") + dx * tm).alias("mx"), (F.col("y1") + dy * tm).alias("my"))
    b = bounded_broadcast(other_bands.select(F.col("id").alias("_bid"), F.col("cy").alias("_bcy"), "edges"),
                          items=F.size("edges"))
    # No edge of the other polygon in the band: outside.
    j = p.withColumn("_cy", _cell(F.col("my"), cell)).join(
        b, (F.col(other_key) == F.col("_bid")) & (F.col("_cy") == F.col("_bcy")), "left")
    mx, my = F.col("mx"), F.col("my")
    edges = F.coalesce("edges", F.array().cast(other_bands.schema["edges"].dataType))
    along = lambda ed: ((ed["x2"] - ed["x1"]) * (F.col("bx") - F.col("ax"))
                        + (ed["y2"] - ed["y1"]) * (F.col("by") - F.col("ay")) > 0)
    return j.select(own_key, other_key, "ax", "ay", "bx", "by",
                    F.exists(edges, lambda ed: _near_edge(ed, mx, my)).alias("on"),
                    F.exists(edges, lambda ed: _near_edge(ed, mx, my) & along(ed)).alias("same"),
                    _parity(edges, mx, my).alias("inside"))


def overlay_area(features: DataFrame, zones: DataFrame, cell: float | None = None,
                 orient: bool = False) -> DataFrame:
    """JN5: ``(fid, zone, area)`` = area of feature ∩ zone for every
    intersecting pair, by Green's theorem over the boundary of the
    intersection: feature edges inside the zone plus zone edges inside the
    feature, each split at their mutual crossings.  Work is per candidate
    pair (found through shared grid cells) and per edge near the other polygon.

    Edge tables from :func:`polygon_edges` / :func:`box_edges` are already
    oriented (shells counter-clockwise); pass ``orient=True`` for others.
    Coincident stretches of boundary are counted once (from the feature side)
    when both edges run the same way and dropped when they run opposite ways.
    ``cell`` is derived from the zones' sizes if not given."""
    f, z = (orient_rings(features), orient_rings(zones)) if orient else (features, zones)
    cell = cell or auto_cell_size(zones)
    levels, fb, zb = _prepared(f, z, cell)
    segs = segment_pairs(f, z, cell, (levels["f_edges"], levels["z_edges"]))
    hit = materialize(segs.filter(_touching(segs)))
    pairs = materialize(_meeting(f, z, fb, zb, hit, cell, levels))
    term = (F.lit(0.5) * (F.col("ax") * F.col("by") - F.col("bx") * F.col("ay"))).alias("term")
    inside = ~F.col("on") & F.col("inside")
    f_in = _pieces(f, pairs, "fid", "zone", _cuts(hit, "f"), zb, bboxes(z), cell,
                   (levels["f_edges"], levels["z"])).filter(inside | F.col("same"))
    z_in = _pieces(z, pairs, "zone", "fid", _cuts(hit, "z"), fb, bboxes(f), cell,
                   (levels["z_edges"], levels["f"])).filter(inside)
    return f_in.select("fid", "zone", term).unionByName(z_in.select("fid", "zone", term)) \
               .groupBy("fid", "zone").agg(F.sum("term").alias("area"))
