"""Network domain queries: neighbour interpolation (DP13) and the composed
network score (DP14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import interpolate as I
from ..operators import score as S
from ..operators import spatial as G
from ..session import materialize
from . import register
from ._common import rd, tables
from .aggregates import deployment_rates, success_rate_and_median_quality
from .spatial import CELL, ZE, _zones


def _sparse_values(spark, sf):
    nation, customer = tables(spark, sf, "nation", "customer")
    # Every third zone has no measure, at any scale.
    zone = F.col("c_nationkey").cast("long")
    v = customer.groupBy(zone.alias("zone")).agg(F.avg(F.when(zone % 3 != 0, F.col("c_acctbal"))).alias("valeur"))
    ref = nation.select(F.col("n_nationkey").cast("long").alias("zone"))
    return ref.join(v, "zone", "left")


def neighbour_interpolation(spark, sf):
    """DP13: a sparse per-zone measure (mean balance of the customers) gap-filled
    from lattice neighbours in 3 passes in zone order, then the global median."""
    neigh = materialize(G.adjacency(_zones(spark, sf), CELL))
    return I.fill_from_neighbours(_sparse_values(spark, sf), neigh, "zone", "valeur")


ADJ_SQL = f"""
ze as ({ZE}),
vv as (select distinct id as zone, round(x1, 9) as kx, round(y1, 9) as ky from ze),
adj as (select distinct a.zone, b.zone as nzone from vv a join vv b on a.kx = b.kx and a.ky = b.ky and a.zone <> b.zone)
"""


def _passes_sql(src: str, out: str, passes: int = 3) -> str:
    """Zones one after the other, ``passes`` times over all: the state is the list
    of values in the order of the zones, and a step looks at one of them."""
    mean = rd("list_avg(list_transform(ns, lambda j: vals[j]))", 2)
    return f"""
{out}_o as (select zone, valeur, row_number() over (order by zone) as k from {src}),
{out}_n as (select a.k, list(b.k) as ns from adj join {out}_o a on a.zone = adj.zone join {out}_o b on b.zone = adj.nzone group by a.k),
{out}_t(step, vals) as (
  select 0, list(valeur order by k) from {out}_o
  union all
  select step + 1, list_transform(vals, lambda x, i: case when i = step % len(vals) + 1 and x is null then m else x end)
  from (select step, vals, {mean} as m from {out}_t left join {out}_n on k = step % len(vals) + 1 where step < {passes} * len(vals))),
{out}{passes} as (select zone, v as valeur from (
    select unnest(vals) as v, unnest(range(1, len(vals) + 1)) as k from {out}_t where step = {passes} * len(vals)) join {out}_o using (k))"""


register("neighbour_interpolation", f"""
with recursive {ADJ_SQL},
v as (select c_nationkey as zone, avg(case when c_nationkey % 3 <> 0 then c_acctbal end) as valeur from customer group by 1),
s0 as (select cast(n.n_nationkey as bigint) as zone, cast(v.valeur as double) as valeur from nation n left join v on v.zone = n.n_nationkey),
{_passes_sql('s0', 's')}
select zone, {rd('coalesce(valeur, (select median(valeur) from s3))', 2)} as valeur from s3
""")(neighbour_interpolation)


# Network score weights (mobile, quality, fibre).
NETWORK_WEIGHTS = {"score_mobile": 0.45, "score_qualite": 0.35, "score_fibre": 0.20}


def network_score(spark, sf):
    """DP14: per zone, best operator values (max over operators) for mobile
    coverage, quality gap-filled from neighbours, fibre rates; NULL → 0;
    (.45·mobile + .35·quality + .20·fibre) / 100 rounded 4; competition rank;
    best mobile operator by argmax (ties alphabetical)."""
    (customer,) = tables(spark, sf, "customer")
    mob = customer.groupBy(F.col("c_nationkey").cast("long").alias("zone"),
                           C.canonical("c_mktsegment").alias("operateur")).agg(
        C.round_dec(C.clip(A.rate(F.col("c_acctbal") > 0)), 2).alias("couv_4g"),
        C.round_dec(C.clip(A.rate(F.col("c_acctbal") > 5000)), 2).alias("couv_5g"))
    mob = mob.withColumn("score_mobile", C.round_dec(0.4 * F.col("couv_4g") + 0.6 * F.col("couv_5g"), 2))
    mob = materialize(mob)
    mobile_iris = mob.groupBy("zone").agg(F.max("couv_4g").alias("couv_4g_max"),
                                          F.max("couv_5g").alias("couv_5g_max"),
                                          F.max("score_mobile").alias("score_mobile"))
    best = A.argmax(mob, "zone", "score_mobile", "operateur", "meilleur_operateur_mobile")
    q = success_rate_and_median_quality(spark, sf).withColumn("zone", F.col("zone").cast("long"))
    q = q.groupBy("zone").agg(F.max("score_qualite").alias("valeur"))
    ref = _zones(spark, sf).select(F.col("id").alias("zone")).distinct()
    neigh = materialize(G.adjacency(_zones(spark, sf), CELL))
    q = I.fill_from_neighbours(ref.join(q, "zone", "left"), neigh, "zone", "valeur") \
        .withColumnRenamed("valeur", "score_qualite")
    fib = deployment_rates(spark, sf).select(F.col("zone").cast("long").alias("zone"),
                                             F.col("taux_deploiement").alias("taux_deploiement_fibre"),
                                             "taux_pm_actif", "score_fibre", "meilleur_operateur_fibre")
    r = mobile_iris.join(q, "zone", "left").join(fib, "zone", "left").join(best, "zone", "left")
    r = r.fillna({"score_mobile": 0.0, "score_qualite": 0.0, "score_fibre": 0.0})
    r = materialize(r)
    raw = (F.lit(0.45) * F.col("score_mobile") + F.lit(0.35) * F.col("score_qualite")
           + F.lit(0.20) * F.col("score_fibre")) / 100.0
    r = r.withColumn("score_final", C.round_dec(raw, 4))
    r = S.rank_desc(r, "score_final", "rang_reseau")
    return r.select("zone", "rang_reseau", "score_final",
                    C.round_dec("score_final", 2).alias("score_final_stocke"),
                    "score_mobile", "score_qualite", "score_fibre", "couv_4g_max", "couv_5g_max",
                    "taux_deploiement_fibre", "taux_pm_actif", "meilleur_operateur_mobile",
                    "meilleur_operateur_fibre")


def _oracle_of(key: str) -> str:
    from . import ORACLES
    return ORACLES[key]


def neighbour_interpolation_runs(spark, sf):
    """DP13 with runs of missing neighbours: of a row of five zones three have no
    measure, so most zones wait for others of the same pass."""
    nation, customer = tables(spark, sf, "nation", "customer")
    zone = F.col("c_nationkey").cast("long")
    v = customer.groupBy(zone.alias("zone")).agg(F.avg(F.when(zone % 5 >= 3, F.col("c_acctbal"))).alias("valeur"))
    ref = nation.select(F.col("n_nationkey").cast("long").alias("zone")).join(v, "zone", "left")
    return I.fill_from_neighbours(ref, materialize(G.adjacency(_zones(spark, sf), CELL)), "zone", "valeur")


register("neighbour_interpolation_runs", f"""
with recursive {ADJ_SQL},
v as (select c_nationkey as zone, avg(case when c_nationkey % 5 >= 3 then c_acctbal end) as valeur from customer group by 1),
s0 as (select cast(n.n_nationkey as bigint) as zone, cast(v.valeur as double) as valeur from nation n left join v on v.zone = n.n_nationkey),
{_passes_sql('s0', 's')}
select zone, {rd('coalesce(valeur, (select median(valeur) from s3))', 2)} as valeur from s3
""")(neighbour_interpolation_runs)


def _network_sql() -> str:
    quality = _oracle_of("success_rate_and_median_quality")
    fibre = _oracle_of("deployment_rates")
    canon = ("case when lower(trim(c_mktsegment)) like '%bouygue%' then 'Bouygues' "
             "when lower(trim(c_mktsegment)) like '%free%' then 'Free' "
             "when lower(trim(c_mktsegment)) like '%orange%' then 'Orange' "
             "when lower(trim(c_mktsegment)) like '%sfr%' then 'SFR' "
             "else upper(substr(trim(c_mktsegment), 1, 1)) || lower(substr(trim(c_mktsegment), 2)) end")
    c4 = rd("greatest(0.0, least(100.0, cast(count(*) filter (where c_acctbal > 0) as double) / cast(count(*) as double) * 100.0))", 2)
    c5 = rd("greatest(0.0, least(100.0, cast(count(*) filter (where c_acctbal > 5000) as double) / cast(count(*) as double) * 100.0))", 2)
    return f"""
with recursive {ADJ_SQL},
mob0 as (select cast(c_nationkey as bigint) as zone, {canon} as operateur, {c4} as couv_4g, {c5} as couv_5g
         from customer group by 1, 2),
mob as (select *, {rd('0.4 * couv_4g + 0.6 * couv_5g', 2)} as score_mobile from mob0),
mi as (select zone, max(couv_4g) as couv_4g_max, max(couv_5g) as couv_5g_max, max(score_mobile) as score_mobile
       from mob group by zone),
best as (select zone, operateur as meilleur_operateur_mobile from (
          select *, row_number() over (partition by zone order by score_mobile desc, operateur) as rn from mob) where rn = 1),
qsrc as ({quality}),
qz as (select cast(zone as bigint) as zone, max(score_qualite) as valeur from qsrc group by 1),
s0 as (select distinct ze.id as zone, cast(qz.valeur as double) as valeur from ze left join qz on qz.zone = ze.id),
{_passes_sql('s0', 's')},
q as (select zone, {rd('coalesce(valeur, (select median(valeur) from s3))', 2)} as score_qualite from s3),
fsrc as ({fibre}),
f as (select cast(zone as bigint) as zone, taux_deploiement as taux_deploiement_fibre, taux_pm_actif, score_fibre,
             meilleur_operateur_fibre from fsrc),
r as (select mi.zone, mi.couv_4g_max, mi.couv_5g_max, coalesce(mi.score_mobile, 0.0) as score_mobile,
             coalesce(q.score_qualite, 0.0) as score_qualite, coalesce(f.score_fibre, 0.0) as score_fibre,
             f.taux_deploiement_fibre, f.taux_pm_actif, f.meilleur_operateur_fibre, best.meilleur_operateur_mobile
      from mi left join q using (zone) left join f using (zone) left join best using (zone)),
r2 as (select *, {rd('(cast(0.45 as double) * score_mobile + cast(0.35 as double) * score_qualite + cast(0.20 as double) * score_fibre) / 100.0', 4)} as score_final from r)
select zone, cast(rank() over (order by score_final desc) as bigint) as rang_reseau, score_final,
       {rd('score_final', 2)} as score_final_stocke, score_mobile, score_qualite, score_fibre, couv_4g_max, couv_5g_max,
       taux_deploiement_fibre, taux_pm_actif, meilleur_operateur_mobile, meilleur_operateur_fibre
from r2
"""


register("network_score", None)(network_score)
