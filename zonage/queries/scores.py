"""Score queries: densify, percentile ranks, min-max, composites, ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import score as S
from ..session import materialize
from . import register
from ._common import pct_sql, rd, tables

# Environment score weights (trees, green surface, cool
# islands, sorting stations).
ENV_WEIGHTS = {"pr_trees": 0.30, "pr_green": 0.40, "pr_islands": 0.20, "pr_stations": 0.10}
# Mobility weights — transit modes (bus, metro, RER, tram, train;
# they sum to 0.97 in the source), bikes (stations, capacity), final blend.
TRANSIT_WEIGHTS = {"n_bus": 0.30, "n_metro": 0.35, "n_rer": 0.15, "n_tram": 0.12, "n_train": 0.05}
BIKE_WEIGHTS = {"n_bike_stations": 0.40, "bike_capacity": 0.60}
MOBILITY_BLEND = {"score_transport_collectif": 0.75, "score_velib": 0.25}


def _zone_facts(spark, sf):
    nation, customer, orders, lineitem, supplier = tables(
        spark, sf, "nation", "customer", "orders", "lineitem", "supplier")
    cust_zone = customer.select("c_custkey", F.col("c_nationkey").alias("zone"))
    order_zone = orders.select("o_orderkey", "o_custkey", "o_totalprice") \
        .join(cust_zone, F.col("o_custkey") == F.col("c_custkey"))
    trees = customer.groupBy(F.col("c_nationkey").alias("zone")).agg(F.count("*").alias("n_trees"))
    green = order_zone.groupBy("zone").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("green_surface"))
    islands = (lineitem.select("l_orderkey", "l_suppkey")
               .join(order_zone.select("o_orderkey", "zone"), F.col("l_orderkey") == F.col("o_orderkey"))
               .groupBy("zone").agg(F.count_distinct("l_suppkey").alias("n_islands")))
    stations = supplier.groupBy(F.col("s_nationkey").alias("zone")).agg(F.count("*").alias("n_stations"))
    ref = nation.select(F.col("n_nationkey").alias("zone"))
    return S.densify(ref, [trees, green, islands, stations], "zone", fill=0)


def zone_counts_score(spark, sf):
    """DP7 shape: AG1/AG2/AG3 per zone → JN10 densify → WN2 ×4 → weights → WN1."""
    d = materialize(_zone_facts(spark, sf))
    d = S.pct_rank_many(d, "zone", {"n_trees": "pr_trees", "green_surface": "pr_green",
                                    "n_islands": "pr_islands", "n_stations": "pr_stations"})
    d = S.weighted_score(d, ENV_WEIGHTS, "score", digits=4)
    d = S.rank_desc(d, "score", "rank")
    return d.select("zone", "n_trees", "green_surface", "n_islands", "n_stations", "score", "rank")


ZONE_FACTS_SQL = """
with zones as (select n_nationkey as zone from nation),
cz as (select c_custkey, c_nationkey as zone from customer),
oz as (select o.o_orderkey, o.o_totalprice, cz.zone from orders o join cz on o.o_custkey = cz.c_custkey),
t as (select c_nationkey as zone, count(*) as n_trees from customer group by 1),
g as (select zone, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as green_surface from oz group by 1),
i as (select oz.zone, count(distinct l.l_suppkey) as n_islands from lineitem l join oz on l.l_orderkey = oz.o_orderkey group by 1),
s as (select s_nationkey as zone, count(*) as n_stations from supplier group by 1),
d as (select z.zone, coalesce(t.n_trees, 0) as n_trees, coalesce(g.green_surface, 0) as green_surface,
             coalesce(i.n_islands, 0) as n_islands, coalesce(s.n_stations, 0) as n_stations
      from zones z left join t using (zone) left join g using (zone) left join i using (zone) left join s using (zone))
"""

register("zone_counts_score", ZONE_FACTS_SQL + f""",
p as (select *, {pct_sql('n_trees')} as pr_trees, {pct_sql('green_surface')} as pr_green,
             {pct_sql('n_islands')} as pr_islands, {pct_sql('n_stations')} as pr_stations from d),
sc as (select *, {rd('cast(0.30 as double) * pr_trees + cast(0.40 as double) * pr_green + cast(0.20 as double) * pr_islands + cast(0.10 as double) * pr_stations', 4)} as score from p)
select zone, n_trees, green_surface, n_islands, n_stations, score,
       cast(rank() over (order by score desc) as bigint) as rank
from sc
""")(zone_counts_score)


def pct_rank_average(spark, sf):
    """WN2 on a fact-sized column with many ties: parts by size, globally and
    within each brand."""
    (part,) = tables(spark, sf, "part")
    p = part.select("p_partkey", "p_brand", "p_size", "p_retailprice")
    p = S.pct_rank_avg(p, "p_size", "pct_size")
    p = S.pct_rank_avg(p, "p_retailprice", "pct_price_in_brand", by=["p_brand"])
    return p.select("p_partkey", "p_brand", "p_size",
                    F.col("pct_size"), F.col("pct_price_in_brand"))


register("pct_rank_average", f"""
select p_partkey, p_brand, p_size, {pct_sql('p_size')} as pct_size,
       {pct_sql('p_retailprice', 'p_brand')} as pct_price_in_brand
from part
""")(pct_rank_average)


def _mobility_counts(spark, sf):
    nation, customer, supplier = tables(spark, sf, "nation", "customer", "supplier")
    seg = F.col("c_mktsegment")
    counts = customer.groupBy(F.col("c_nationkey").alias("zone")).agg(
        A.count_filter(seg == "AUTOMOBILE").alias("n_bus"),
        A.count_filter(seg == "BUILDING").alias("n_metro"),
        A.count_filter(seg == "FURNITURE").alias("n_rer"),
        A.count_filter(seg == "HOUSEHOLD").alias("n_tram"),
        A.count_filter(seg == "MACHINERY").alias("n_train"),
    )
    bikes = supplier.groupBy(F.col("s_nationkey").alias("zone")).agg(
        F.count("*").alias("n_bike_stations"),
        A.sum_or_zero(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("bike_capacity"))
    ref = nation.select(F.col("n_nationkey").alias("zone"))
    return S.densify(ref, [counts, bikes], "zone", fill=0)


def minmax_composite_rank(spark, sf):
    """DP9 shape: WN4 on 7 counts → weighted transit/bike → WN3 → blend →
    all ten rounded to 4 → WN1."""
    d = materialize(_mobility_counts(spark, sf))
    cols = list(TRANSIT_WEIGHTS) + list(BIKE_WEIGHTS)
    d = S.minmax(d, {c: f"norm_{c}" for c in cols}, fill=0)
    d = S.weighted_score(d, {f"norm_{c}": w for c, w in TRANSIT_WEIGHTS.items()}, "_transit")
    d = S.weighted_score(d, {f"norm_{c}": w for c, w in BIKE_WEIGHTS.items()}, "_bikes")
    d = S.minmax(d, {"_transit": "score_transport_collectif", "_bikes": "score_velib"})
    d = S.weighted_score(d, MOBILITY_BLEND, "score_mobilite")
    rounded = [*(f"norm_{c}" for c in cols), "score_transport_collectif", "score_velib", "score_mobilite"]
    # One row per zone: the rank reads it several times.
    d = materialize(d.withColumns({c: C.round_dec(c, 4) for c in rounded}))
    d = S.rank_desc(d, "score_mobilite", "rang_mobilite")
    return d.select("zone", *cols, *[f"norm_{c}" for c in cols],
                    "score_transport_collectif", "score_velib", "score_mobilite", "rang_mobilite")


def _mm_sql(c: str, src: str) -> str:
    return (f"case when (select max({c}) from {src}) = (select min({c}) from {src}) then 0.0 "
            f"else (cast({c} as double) - (select min({c}) from {src})) / "
            f"(cast((select max({c}) from {src}) as double) - (select min({c}) from {src})) end")


_MOB_COLS = list(TRANSIT_WEIGHTS) + list(BIKE_WEIGHTS)
register("minmax_composite_rank", f"""
with zones as (select n_nationkey as zone from nation),
c as (select c_nationkey as zone,
        count(*) filter (where c_mktsegment = 'AUTOMOBILE') as n_bus,
        count(*) filter (where c_mktsegment = 'BUILDING') as n_metro,
        count(*) filter (where c_mktsegment = 'FURNITURE') as n_rer,
        count(*) filter (where c_mktsegment = 'HOUSEHOLD') as n_tram,
        count(*) filter (where c_mktsegment = 'MACHINERY') as n_train
      from customer group by 1),
b as (select s_nationkey as zone, count(*) as n_bike_stations,
             cast(coalesce(sum(cast(s_acctbal as decimal(18,2))), 0) as double) as bike_capacity
      from supplier group by 1),
d as (select z.zone, {', '.join(f'coalesce({c}, 0) as {c}' for c in _MOB_COLS)}
      from zones z left join c using (zone) left join b using (zone)),
n as (select *, {', '.join(f'{_mm_sql(c, "d")} as norm_{c}' for c in _MOB_COLS)} from d),
w as (select *,
        {' + '.join(f'cast({w} as double) * norm_{c}' for c, w in TRANSIT_WEIGHTS.items())} as t_raw,
        {' + '.join(f'cast({w} as double) * norm_{c}' for c, w in BIKE_WEIGHTS.items())} as b_raw
      from n),
m as (select *, {_mm_sql('t_raw', 'w')} as score_transport_collectif,
                {_mm_sql('b_raw', 'w')} as score_velib from w),
s as (select *, {rd('cast(0.75 as double) * score_transport_collectif + cast(0.25 as double) * score_velib', 4)} as score_mobilite from m)
select zone, {', '.join(_MOB_COLS)}, {', '.join(rd('norm_' + c, 4) + ' as norm_' + c for c in _MOB_COLS)},
       {rd('score_transport_collectif', 4)} as score_transport_collectif, {rd('score_velib', 4)} as score_velib, score_mobilite,
       cast(rank() over (order by score_mobilite desc) as bigint) as rang_mobilite
from s
""")(minmax_composite_rank)


def minmax_constant_and_null(spark, sf):
    """WN3 / WN7 edge cases: a sparse measure with NULL zones, a constant
    measure that is NULL on some zones (→ 0.0 everywhere), and the WN7
    variant (constant range divides by 1)."""
    nation, customer = tables(spark, sf, "nation", "customer")
    # Every fourth zone has no measure, at any scale.
    known = F.col("c_nationkey") % 4 != 0
    rich = (customer.groupBy(F.col("c_nationkey").alias("zone"))
            .agg(F.sum(F.when(known, 1)).alias("n_rich"), F.max(F.when(known, 1)).alias("flag")))
    ref = nation.select(F.col("n_nationkey").alias("zone"))
    d = materialize(S.densify(ref, [rich], "zone", fill=None))
    d = S.minmax(d, {"n_rich": "mm_rich", "flag": "mm_flag"})
    d = S.minmax(d, {"n_rich": "wn7_rich", "flag": "wn7_flag"}, constant=None)
    return d.select("zone", "n_rich", "flag", "mm_rich", "mm_flag", "wn7_rich", "wn7_flag")


def _wn7_sql(c: str, src: str) -> str:
    return (f"(cast({c} as double) - (select min({c}) from {src})) / "
            f"(case when (select max({c}) from {src}) = (select min({c}) from {src}) then 1.0 "
            f"else cast((select max({c}) from {src}) as double) - (select min({c}) from {src}) end)")


register("minmax_constant_and_null", f"""
with r as (select c_nationkey as zone, cast(sum(case when c_nationkey % 4 <> 0 then 1 end) as bigint) as n_rich,
                  max(case when c_nationkey % 4 <> 0 then 1 end) as flag from customer group by 1),
d as (select n.n_nationkey as zone, r.n_rich, r.flag from nation n left join r on n.n_nationkey = r.zone)
select zone, n_rich, flag, {_mm_sql('n_rich', 'd')} as mm_rich, {_mm_sql('flag', 'd')} as mm_flag,
       {_wn7_sql('n_rich', 'd')} as wn7_rich, {_wn7_sql('flag', 'd')} as wn7_flag
from d
""")(minmax_constant_and_null)
