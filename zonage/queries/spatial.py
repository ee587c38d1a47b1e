"""Spatial queries over the lattice geography derived from the tables
(see :mod:`zonage.sources.lattice`)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.geo import lambert93, lambert93_sql
from ..operators import agg as A
from ..operators import score as S
from ..operators import spatial as G
from ..sources import lattice as LT
from . import register
from ._common import rd, tables

CELL = 1.0


def _zones(spark, sf):
    (nation,) = tables(spark, sf, "nation")
    return LT.zone_edges(nation)


ZE = LT.sql_zone_edges()


def _pip_sql(points: str, edges: str = "ze") -> str:
    """``(id, zone)`` for points strictly inside a zone by even–odd parity."""
    return (f"select p.id, min(h.zone) as zone from {points} p join ("
            f"select p2.id, e.id as zone from {points} p2 join {edges} e "
            f"on ((e.y1 > p2.y) <> (e.y2 > p2.y)) and p2.x < (e.x2 - e.x1) * (p2.y - e.y1) / (e.y2 - e.y1) + e.x1 "
            f"group by p2.id, e.id having count(*) % 2 = 1) h on p.id = h.id group by p.id")


# ---------------------------------------------------------------- JN1 / JN2

def point_in_zone(spark, sf):
    """JN1: every customer located in its zone (left join: unmatched → NULL),
    with the zone's district attached; ``zone_strict`` excludes boundary
    points (``within`` semantics)."""
    customer, nation = tables(spark, sf, "customer", "nation")
    pts = LT.with_point(customer.select("c_custkey"), "c_custkey")
    ze = _zones(spark, sf)
    idx = G.zone_index(ze, CELL)
    j = G.points_in_zones(pts, ze, "x", "y", CELL, "zone", index=idx)
    j = G.points_in_zones(j, ze, "x", "y", CELL, "zone_strict", strict=True, index=idx)
    dist = nation.select(F.col("n_nationkey").cast("long").alias("zone"),
                         F.col("n_regionkey").alias("district"))
    return j.join(dist, "zone", "left").select("c_custkey", "x", "y", "zone", "zone_strict", "district")


register("point_in_zone", f"""
with ze as ({ZE}),
pts as (select c_custkey as id, {LT.sql_point('c_custkey', 'x')} as x, {LT.sql_point('c_custkey', 'y')} as y from customer),
z as ({_pip_sql('pts')}),
onb as (select distinct p.id from pts p join ze e on (e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0
        and p.x between least(e.x1, e.x2) and greatest(e.x1, e.x2) and p.y between least(e.y1, e.y2) and greatest(e.y1, e.y2))
select pts.id as c_custkey, pts.x, pts.y, z.zone,
       case when onb.id is null then z.zone end as zone_strict, n.n_regionkey as district
from pts left join z on pts.id = z.id left join onb on pts.id = onb.id
left join nation n on cast(n.n_nationkey as bigint) = z.zone
""")(point_in_zone)


def point_in_zone_aggregate(spark, sf):
    """DP8 + AG1/AG3 + JN10: customers and suppliers located by the spatial
    join, counted per zone, densified over all zones, with the share of
    zone-less points."""
    customer, supplier, nation = tables(spark, sf, "customer", "supplier", "nation")
    ze = _zones(spark, sf)
    idx = G.zone_index(ze, CELL)
    cust = G.points_in_zones(LT.with_point(customer.select("c_custkey", "c_acctbal"), "c_custkey"),
                             ze, "x", "y", CELL, "zone", index=idx)
    supp = G.points_in_zones(LT.with_point(supplier.select("s_suppkey"), "s_suppkey"),
                             ze, "x", "y", CELL, "zone", how="inner", index=idx)
    c_agg = cust.filter(F.col("zone").isNotNull()).groupBy("zone").agg(
        F.count("*").alias("n_customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
    s_agg = supp.groupBy("zone").agg(F.count("*").alias("n_suppliers"))
    ref = nation.select(F.col("n_nationkey").cast("long").alias("zone"))
    d = S.densify(ref, [c_agg, s_agg], "zone", fill=0)
    return d.select("zone", "n_customers", "balance", "n_suppliers")


register("point_in_zone_aggregate", f"""
with ze as ({ZE}),
cp as (select c_custkey as id, c_acctbal, {LT.sql_point('c_custkey', 'x')} as x, {LT.sql_point('c_custkey', 'y')} as y from customer),
sp as (select s_suppkey as id, {LT.sql_point('s_suppkey', 'x')} as x, {LT.sql_point('s_suppkey', 'y')} as y from supplier),
cz as ({_pip_sql('cp')}), sz as ({_pip_sql('sp')}),
ca as (select cz.zone, count(*) as n_customers, cast(sum(cast(cp.c_acctbal as decimal(18,2))) as double) as balance
       from cp join cz on cp.id = cz.id group by 1),
sa as (select zone, count(*) as n_suppliers from sz group by 1)
select cast(n.n_nationkey as bigint) as zone, coalesce(ca.n_customers, 0) as n_customers,
       coalesce(ca.balance, 0) as balance, coalesce(sa.n_suppliers, 0) as n_suppliers
from nation n left join ca on ca.zone = n.n_nationkey left join sa on sa.zone = n.n_nationkey
""")(point_in_zone_aggregate)


# ---------------------------------------------------------------- JN3 / JN4

def _boxes(spark, sf):
    (part,) = tables(spark, sf, "part")
    b = LT.part_boxes(part)
    return b, G.box_edges(b, "id", "box_x", "box_y", "box_w", "box_h")


BOXES = LT.sql_part_boxes()
BE = LT.sql_box_edges("boxes")


def feature_within_zone(spark, sf):
    """JN3: boxes lying inside exactly one zone (straddling boxes dropped)."""
    _, be = _boxes(spark, sf)
    return G.features_in_zones(be, _zones(spark, sf), "within", CELL)


def _orient(a: str, b: str, c: str) -> str:
    return f"(({b}x - {a}x) * ({c}y - {a}y) - ({b}y - {a}y) * ({c}x - {a}x))"


_SEG = ("f.x1 as f1x, f.y1 as f1y, f.x2 as f2x, f.y2 as f2y, z.x1 as z1x, z.y1 as z1y, z.x2 as z2x, z.y2 as z2y")
_O = (f"{_orient('f1', 'f2', 'z1')} as o1, {_orient('f1', 'f2', 'z2')} as o2, "
      f"{_orient('z1', 'z2', 'f1')} as o3, {_orient('z1', 'z2', 'f2')} as o4")

register("feature_within_zone", f"""
with ze as ({ZE}), boxes as ({BOXES}), be as ({BE}),
v as (select id, x1 as x, y1 as y from be),
vin as (select v.id, e.id as zone, v.x, v.y from v join ze e
        on ((e.y1 > v.y) <> (e.y2 > v.y)) and v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
        group by v.id, e.id, v.x, v.y having count(*) % 2 = 1),
full_in as (select id, zone from vin group by id, zone having count(*) = 4),
seg as (select f.id as fid, z.id as zone, {_SEG} from be f, ze z),
o as (select *, {_O} from seg),
crossing as (select distinct fid, zone from o where o1 * o2 < 0 and o3 * o4 < 0)
select id as fid, zone from full_in
where not exists (select 1 from crossing c where c.fid = full_in.id and c.zone = full_in.zone)
""")(feature_within_zone)


def feature_intersects_zone(spark, sf):
    """JN4 + AG3: boxes × zones whose geometries intersect (1-to-many), and
    the full box surface counted in every touched zone (reference rule)."""
    boxes, be = _boxes(spark, sf)
    pairs = G.features_in_zones(be, _zones(spark, sf), "intersects", CELL)
    area = boxes.select(F.col("id").alias("fid"), (F.col("box_w") * F.col("box_h")).alias("surface"))
    per_zone = pairs.join(area, "fid").groupBy("zone").agg(
        F.count("*").alias("n_features"), C.round_dec(F.sum("surface"), 6).alias("surface_totale"))
    return per_zone


register("feature_intersects_zone", f"""
with ze as ({ZE}), boxes as ({BOXES}), be as ({BE}),
seg as (select f.id as fid, z.id as zone, {_SEG} from be f, ze z),
o as (select *, {_O} from seg),
touch as (select distinct fid, zone from o where o1 * o2 <= 0 and o3 * o4 <= 0
          and least(f1x, f2x) <= greatest(z1x, z2x) and least(z1x, z2x) <= greatest(f1x, f2x)
          and least(f1y, f2y) <= greatest(z1y, z2y) and least(z1y, z2y) <= greatest(f1y, f2y)),
fv as (select id, x1 as x, y1 as y from be where seq = 0),
zv as (select id, x1 as x, y1 as y from ze where seq = 0),
f_in_z as (select v.id as fid, e.id as zone from fv v join ze e
           on ((e.y1 > v.y) <> (e.y2 > v.y)) and v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
           group by v.id, e.id having count(*) % 2 = 1),
z_in_f as (select e.id as fid, v.id as zone from zv v join be e
           on ((e.y1 > v.y) <> (e.y2 > v.y)) and v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
           group by v.id, e.id having count(*) % 2 = 1),
pairs as (select fid, zone from touch union select fid, zone from f_in_z union select fid, zone from z_in_f)
select zone, count(*) as n_features, {rd('sum(b.box_w * b.box_h)', 6)} as surface_totale
from pairs join boxes b on pairs.fid = b.id group by zone
""")(feature_intersects_zone)


# ------------------------------------------------------------------ JN6

def zone_adjacency(spark, sf):
    """JN6: ordered neighbour pairs (shared vertex or vertex on an edge)."""
    return G.adjacency(_zones(spark, sf), CELL)


register("zone_adjacency", f"""
with ze as ({ZE}),
v as (select distinct id as zone, round(x1, 9) as kx, round(y1, 9) as ky from ze),
shared as (select a.zone, b.zone as nzone from v a join v b on a.kx = b.kx and a.ky = b.ky and a.zone <> b.zone),
onb as (select p.id as zone, e.id as nzone from ze p join ze e on p.id <> e.id
        and (e.x2 - e.x1) * (p.y1 - e.y1) - (e.y2 - e.y1) * (p.x1 - e.x1) = 0
        and p.x1 between least(e.x1, e.x2) and greatest(e.x1, e.x2)
        and p.y1 between least(e.y1, e.y2) and greatest(e.y1, e.y2))
select zone, nzone from shared union select zone, nzone from onb union select nzone, zone from onb
""")(zone_adjacency)


# ------------------------------------------------------------------ SF16

LON_ORIGIN, LON_STEP, LAT_ORIGIN, LAT_STEP = 2.25, 0.025, 48.815, 0.018


def zone_area_projected(spark, sf):
    """SF16: zone areas by the shoelace formula in lattice units and, after
    projecting the vertices (lattice read as lon/lat offsets around Paris)
    to Lambert-93, in square metres."""
    ze = _zones(spark, sf)
    lattice_area = G.polygon_area(ze).select(F.col("id").alias("zone"),
                                             C.round_dec("area", 9).alias("area"))
    x1, y1 = lambert93(LON_ORIGIN + F.col("x1") * LON_STEP, LAT_ORIGIN + F.col("y1") * LAT_STEP)
    x2, y2 = lambert93(LON_ORIGIN + F.col("x2") * LON_STEP, LAT_ORIGIN + F.col("y2") * LAT_STEP)
    pe = ze.select("id", "part", "ring", "seq", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    m2 = G.polygon_area(pe).select(F.col("id").alias("zone"), C.round_dec("area", 0).alias("area_m2"))
    first = pe.filter(F.col("seq") == 0).select(F.col("id").alias("zone"),
                                                 C.round_dec("x1", 3).alias("x_l93"),
                                                 C.round_dec("y1", 3).alias("y_l93"))
    return lattice_area.join(m2, "zone").join(first, "zone")


def _proj_edges_sql() -> str:
    ax, ay = lambert93_sql(f"({LON_ORIGIN} + x1 * {LON_STEP})", f"({LAT_ORIGIN} + y1 * {LAT_STEP})")
    box_x, box_y = lambert93_sql(f"({LON_ORIGIN} + x2 * {LON_STEP})", f"({LAT_ORIGIN} + y2 * {LAT_STEP})")
    return f"select id, seq, {ax} as x1, {ay} as y1, {box_x} as x2, {box_y} as y2 from ze"


register("zone_area_projected", f"""
with ze as ({ZE}), pe as ({_proj_edges_sql()}),
a as (select id as zone, {rd('abs(sum(x1 * y2 - x2 * y1) / 2.0)', 9)} as area from ze group by id),
m as (select id as zone, {rd('abs(sum(x1 * y2 - x2 * y1) / 2.0)', 0)} as area_m2 from pe group by id),
f as (select id as zone, {rd('x1', 3)} as x_l93, {rd('y1', 3)} as y_l93 from pe where seq = 0)
select a.zone, a.area, m.area_m2, f.x_l93, f.y_l93 from a join m using (zone) join f using (zone)
""")(zone_area_projected)


# ------------------------------------------------------------------ JN5

# Coverage operator codes assigned to the boxes, and levels.
_OP_CODES = ["BOUY", "FREE", "OF", "SFR0"]
_LEVELS = ["TBC", "BC", "CL"]


def coverage_overlay_rate(spark, sf):
    """JN5 + DP10 + SF15 + AG11: coverage boxes (operator code, technology and
    level derived from the part) overlaid on the zones; per (zone, operator,
    technology): covered share of the zone area ×100 (overlaps counted twice,
    then clipped to 100, round 2) and the level of the largest fragment."""
    (part,) = tables(spark, sf, "part")
    boxes, be = _boxes(spark, sf)
    ze = _zones(spark, sf)
    attrs = part.select(
        F.col("p_partkey").cast("long").alias("fid"),
        C.map_values(F.element_at(F.array(*[F.lit(c) for c in _OP_CODES]),
                                  (F.col("p_partkey") % 4 + 1).cast("int")), C.COVERAGE_OPERATOR_CODES)
        .alias("operateur"),
        F.when(F.col("p_size") % 2 == 0, F.lit("4G")).otherwise(F.lit("5G")).alias("tech"),
        F.element_at(F.array(*[F.lit(c) for c in _LEVELS]), (F.col("p_size") % 3 + 1).cast("int")).alias("niveau"))
    ov = G.overlay_area(be, ze, CELL)
    za = G.polygon_area(ze).select(F.col("id").alias("zone"), F.col("area").alias("zone_area"))
    frag = ov.join(attrs, "fid").withColumn("area_r", C.round_dec("area", 9))
    # AG11: one pass — total area and the level of the single largest fragment
    per = frag.groupBy("zone", "operateur", "tech").agg(
        F.sum("area").alias("a"), F.max_by("niveau", F.struct("area_r", "niveau")).alias("niveau"))
    per = per.join(za, "zone")
    cov = C.round_dec(C.clip(F.col("a") / F.col("zone_area") * 100.0), 2)
    lvl = F.coalesce(C.map_values("niveau", C.LEVEL_SCORES), F.lit(0))
    return per.select("zone", "operateur", "tech", cov.alias("couverture"), "niveau",
                      lvl.cast("int").alias("score_niveau"))


def _overlay_sql() -> str:
    pip = ("(select count(*) from {edges} e where e.id = m.{other} and ((e.y1 > m.my) <> (e.y2 > m.my)) "
           "and m.mx < (e.x2 - e.x1) * (m.my - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1")
    return f"""
ze as ({ZE}), boxes as ({BOXES}), be as ({BE}),
seg as (select f.id as fid, f.seq as fseq, z.id as zone, z.seq as zseq, {_SEG} from be f, ze z),
o as (select *, {_O} from seg),
hit as (select * from o where o1 * o2 <= 0 and o3 * o4 <= 0
          and least(f1x, f2x) <= greatest(z1x, z2x) and least(z1x, z2x) <= greatest(f1x, f2x)
          and least(f1y, f2y) <= greatest(z1y, z2y) and least(z1y, z2y) <= greatest(f1y, f2y)),
fv as (select id, x1 as x, y1 as y from be where seq = 0),
zv as (select id, x1 as x, y1 as y from ze where seq = 0),
f_in_z as (select v.id as fid, e.id as zone from fv v join ze e
           on ((e.y1 > v.y) <> (e.y2 > v.y)) and v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
           group by v.id, e.id having count(*) % 2 = 1),
z_in_f as (select e.id as fid, v.id as zone from zv v join be e
           on ((e.y1 > v.y) <> (e.y2 > v.y)) and v.x < (e.x2 - e.x1) * (v.y - e.y1) / (e.y2 - e.y1) + e.x1
           group by v.id, e.id having count(*) % 2 = 1),
pairs as (select fid, zone from hit union select fid, zone from f_in_z union select fid, zone from z_in_f),
fcut as (select fid, zone, fseq as seq, list(o3 / (o3 - o4)) as ts from hit where o3 <> o4 group by all),
zcut as (select fid, zone, zseq as seq, list(o1 / (o1 - o2)) as ts from hit where o1 <> o2 group by all),
fe as (select p.fid, p.zone, e.x1, e.y1, e.x2, e.y2,
              list_sort(list_distinct(list_concat([0.0::double, 1.0::double], coalesce(c.ts, []::double[])))) as ts
       from pairs p join be e on e.id = p.fid left join fcut c on c.fid = p.fid and c.zone = p.zone and c.seq = e.seq),
zz as (select p.fid, p.zone, e.x1, e.y1, e.x2, e.y2,
              list_sort(list_distinct(list_concat([0.0::double, 1.0::double], coalesce(c.ts, []::double[])))) as ts
       from pairs p join ze e on e.id = p.zone left join zcut c on c.fid = p.fid and c.zone = p.zone and c.seq = e.seq),
fp as (select fid, zone, x1, y1, x2, y2, ts, unnest(range(1, len(ts))) as i from fe),
zp as (select fid, zone, x1, y1, x2, y2, ts, unnest(range(1, len(ts))) as i from zz),
fm as (select fid, zone, x1 + (x2 - x1) * ts[i] as ax, y1 + (y2 - y1) * ts[i] as ay,
              x1 + (x2 - x1) * ts[i + 1] as bx, y1 + (y2 - y1) * ts[i + 1] as by_,
              x1 + (x2 - x1) * ((ts[i] + ts[i + 1]) / 2.0) as mx, y1 + (y2 - y1) * ((ts[i] + ts[i + 1]) / 2.0) as my from fp),
zm as (select fid, zone, x1 + (x2 - x1) * ts[i] as ax, y1 + (y2 - y1) * ts[i] as ay,
              x1 + (x2 - x1) * ts[i + 1] as bx, y1 + (y2 - y1) * ts[i + 1] as by_,
              x1 + (x2 - x1) * ((ts[i] + ts[i + 1]) / 2.0) as mx, y1 + (y2 - y1) * ((ts[i] + ts[i + 1]) / 2.0) as my from zp),
terms as (select fid, zone, 0.5 * (ax * by_ - bx * ay) as term from fm m where {pip.format(edges='ze', other='zone')}
          union all
          select fid, zone, 0.5 * (ax * by_ - bx * ay) as term from zm m where {pip.format(edges='be', other='fid')}),
ov as (select fid, zone, sum(term) as area from terms group by fid, zone)
"""


def _coverage_sql() -> str:
    ops = ", ".join(f"'{c}'" for c in _OP_CODES)
    lv = ", ".join(f"'{c}'" for c in _LEVELS)
    opmap = " ".join(f"when '{k}' then '{v}'" for k, v in C.COVERAGE_OPERATOR_CODES.items())
    lvmap = " ".join(f"when '{k}' then {v}" for k, v in C.LEVEL_SCORES.items())
    return f"""
with {_overlay_sql()},
za as (select id as zone, abs(sum(x1 * y2 - x2 * y1) / 2.0) as zone_area from ze group by id),
attrs as (select cast(p_partkey as bigint) as fid,
                 case ([{ops}])[p_partkey % 4 + 1] {opmap} end as operateur,
                 case when p_size % 2 = 0 then '4G' else '5G' end as tech,
                 ([{lv}])[p_size % 3 + 1] as niveau from part),
frag as (select ov.zone, a.operateur, a.tech, a.niveau, ov.area, {rd('ov.area', 9)} as area_r
         from ov join attrs a on a.fid = ov.fid),
dom as (select zone, operateur, tech, niveau from (select *, row_number() over (
          partition by zone, operateur, tech order by area_r desc, niveau desc) as rn from frag) where rn = 1),
per as (select zone, operateur, tech, sum(area) as a from frag group by all)
select per.zone, per.operateur, per.tech,
       {rd('greatest(0.0, least(100.0, per.a / za.zone_area * 100.0))', 2)} as couverture,
       dom.niveau, cast(coalesce(case dom.niveau {lvmap} end, 0) as integer) as score_niveau
from per join za using (zone) join dom using (zone, operateur, tech)
"""


register("coverage_overlay_rate", _coverage_sql())(coverage_overlay_rate)


# ---------------------------------------------------------------- JN2

def point_in_zone_projected(spark, sf):
    """JN2: customers and zones projected from degrees to metres, then located.
    Points are set off the lattice lines, where rounding would decide."""
    (customer,) = tables(spark, sf, "customer")
    pts = LT.with_point(customer.select("c_custkey"), "c_custkey")
    to_l93 = lambda x, y: lambert93(LON_ORIGIN + x * LON_STEP, LAT_ORIGIN + y * LAT_STEP)
    px, py = to_l93(F.col("x") + 0.0137, F.col("y") + 0.0091)
    x1, y1 = to_l93(F.col("x1"), F.col("y1"))
    x2, y2 = to_l93(F.col("x2"), F.col("y2"))
    edges = _zones(spark, sf).withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2})
    located = G.points_in_zones(pts.select("c_custkey", px.alias("px"), py.alias("py")), edges, "px", "py")
    return located.select("c_custkey", C.round_dec("px", 2).alias("x_l93"), C.round_dec("py", 2).alias("y_l93"), "zone")


def _projected_sql() -> str:
    def l93(x: str, y: str) -> str:
        a, b = lambert93_sql(f"({LON_ORIGIN} + {x} * {LON_STEP})", f"({LAT_ORIGIN} + {y} * {LAT_STEP})")
        return a, b
    (ax, ay), (bx, by) = l93("x1", "y1"), l93("x2", "y2")
    px, py = l93("(x0 + 0.0137)", "(y0 + 0.0091)")
    return f"""
with z0 as ({ZE}),
ze as (select id, {ax} as x1, {ay} as y1, {bx} as x2, {by} as y2 from z0),
p0 as (select c_custkey as id, {LT.sql_point('c_custkey', 'x')} as x0, {LT.sql_point('c_custkey', 'y')} as y0 from customer),
pts as (select id, {px} as x, {py} as y from p0),
z as ({_pip_sql('pts')})
select pts.id as c_custkey, {rd('pts.x', 2)} as x_l93, {rd('pts.y', 2)} as y_l93, z.zone from pts left join z on pts.id = z.id
"""


register("point_in_zone_projected", _projected_sql())(point_in_zone_projected)
