"""Aggregation queries: conditional counts, medians, argmax, dominant class,
mode roll-ups, rates, full outer joins, disaggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import joins as J
from ..operators import score as S
from ..session import materialize
from . import register
from ._common import rd, tables


def _cust_zone(spark, sf):
    customer, nation = tables(spark, sf, "customer", "nation")
    return customer.join(nation.select(F.col("n_nationkey").alias("c_nationkey"),
                                       F.col("n_regionkey").alias("district")), "c_nationkey")


# ---------------------------------------------------------------- AG4 / AG5

def filtered_counts_pivot(spark, sf):
    """AG5 pivot of order status per zone + AG4 sum that is 0 (not NULL) on
    zones without matching rows."""
    nation, customer, orders = tables(spark, sf, "nation", "customer", "orders")
    oz = orders.join(customer.select("c_custkey", "c_nationkey"),
                     F.col("o_custkey") == F.col("c_custkey"))
    st = F.col("o_orderstatus")
    agg = oz.groupBy(F.col("c_nationkey").alias("zone")).agg(
        A.count_filter(st == "F").alias("n_f"),
        A.count_filter(st == "O").alias("n_o"),
        A.count_filter(st == "P").alias("n_p"),
        A.sum_or_zero(F.when(F.col("o_orderpriority") == "1-URGENT",
                             F.col("o_totalprice").cast("decimal(18,2)"))).cast("double")
        .alias("urgent_value"),
        A.sum_or_zero(F.when(F.col("o_totalprice") > 1e9, F.lit(1))).cast("long").alias("n_huge"),
    )
    ref = nation.select(F.col("n_nationkey").alias("zone"))
    return S.densify(ref, [agg], "zone", fill=0)


register("filtered_counts_pivot", """
with a as (
  select c.c_nationkey as zone,
         count(*) filter (where o_orderstatus = 'F') as n_f,
         count(*) filter (where o_orderstatus = 'O') as n_o,
         count(*) filter (where o_orderstatus = 'P') as n_p,
         cast(coalesce(sum(case when o_orderpriority = '1-URGENT' then cast(o_totalprice as decimal(18,2)) end), 0) as double) as urgent_value,
         cast(coalesce(sum(case when o_totalprice > 1e9 then 1 end), 0) as bigint) as n_huge
  from orders o join customer c on o.o_custkey = c.c_custkey group by 1)
select n.n_nationkey as zone, coalesce(n_f, 0) as n_f, coalesce(n_o, 0) as n_o, coalesce(n_p, 0) as n_p,
       coalesce(urgent_value, 0) as urgent_value, coalesce(n_huge, 0) as n_huge
from nation n left join a on n.n_nationkey = a.zone
""")(filtered_counts_pivot)


# ------------------------------------------------------- DP2 / AG6 / AG7 / FLT8

def price_indicators_by_zone_year(spark, sf):
    """DP2: unit price = value / quantity (positive measures only), per
    (zone, year, district): count, exact median, mean (round 2), conditional
    counts of two property types."""
    lineitem, orders = tables(spark, sf, "lineitem", "orders")
    cz = _cust_zone(spark, sf).select("c_custkey", F.col("c_nationkey").alias("zone"), "district")
    sales = (C.positive(lineitem.select("l_orderkey", "l_extendedprice", "l_quantity", "l_returnflag"),
                        "l_extendedprice", "l_quantity")
             .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .join(cz, F.col("o_custkey") == F.col("c_custkey"))
             .select("zone", "district", F.year("o_orderdate").alias("annee"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("prix_m2"),
                     "l_returnflag"))
    keys = ["zone", "annee", "district"]
    sales = A.drop_null_keys(sales, keys)
    base = sales.groupBy(*keys).agg(
        F.count("*").alias("nb_transactions"),
        C.round_dec(F.avg("prix_m2"), 2).alias("prix_m2_moyen"),
        A.count_filter(F.col("l_returnflag") == "A").alias("nb_appartements"),
        A.count_filter(F.col("l_returnflag") == "R").alias("nb_maisons"),
    )
    med = A.exact_median(sales, keys, "prix_m2", "_med")
    out = base.join(med, keys).withColumn("prix_m2_median", C.round_dec("_med", 2))
    return out.select("zone", F.col("annee").cast("int").alias("annee"), "district",
                      "nb_transactions", "prix_m2_median", "prix_m2_moyen",
                      "nb_appartements", "nb_maisons")


register("price_indicators_by_zone_year", f"""
with s as (
  select c.c_nationkey as zone, n.n_regionkey as district, cast(year(o.o_orderdate) as integer) as annee,
         l.l_extendedprice / l.l_quantity as prix_m2, l.l_returnflag
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
  where l.l_extendedprice > 0 and l.l_quantity > 0)
select zone, annee, district, count(*) as nb_transactions,
       {rd('median(prix_m2)', 2)} as prix_m2_median, {rd('avg(prix_m2)', 2)} as prix_m2_moyen,
       count(*) filter (where l_returnflag = 'A') as nb_appartements,
       count(*) filter (where l_returnflag = 'R') as nb_maisons
from s group by zone, annee, district
""")(price_indicators_by_zone_year)


# ------------------------------------------------------------------- AG10

def argmax_category(spark, sf):
    """AG10: per zone, the order priority with the largest order count (ties
    → alphabetically first), and the largest count itself (AG9)."""
    orders, customer = tables(spark, sf, "orders", "customer")
    oz = orders.join(customer.select("c_custkey", F.col("c_nationkey").alias("zone")),
                     F.col("o_custkey") == F.col("c_custkey"))
    counts = oz.groupBy("zone", "o_orderpriority").agg(F.count("*").alias("n"))
    best = A.argmax(counts, "zone", "n", "o_orderpriority", "best_priority")
    mx = counts.groupBy("zone").agg(F.max("n").alias("max_orders"))
    return best.join(mx, "zone")


register("argmax_category", """
with c as (select cu.c_nationkey as zone, o.o_orderpriority, count(*) as n
           from orders o join customer cu on o.o_custkey = cu.c_custkey group by 1, 2),
r as (select *, row_number() over (partition by zone order by n desc, o_orderpriority) as rn from c)
select zone, o_orderpriority as best_priority, (select max(n) from c c2 where c2.zone = r.zone) as max_orders
from r where rn = 1
""")(argmax_category)


# ------------------------------------------------------------------- AG11

def dominant_fragment(spark, sf):
    """AG11: per order, the return flag of the single most valuable line
    (not the flag with the largest total); ties → larger flag."""
    (lineitem,) = tables(spark, sf, "lineitem")
    return A.dominant(lineitem, "l_orderkey", "l_extendedprice", "l_returnflag", "dominant_flag")


register("dominant_fragment", """
select l_orderkey, dominant_flag from (
  select l_orderkey, l_returnflag as dominant_flag,
         row_number() over (partition by l_orderkey order by l_extendedprice desc, l_returnflag desc) as rn
  from lineitem) where rn = 1
""")(dominant_fragment)


# ------------------------------------------------------- AG12 / AG13 / DP18

def mode_rollup(spark, sf):
    """AG12 + AG13: zone table (customers, mean balance, modal segment) rolled
    up to districts: sum of counts, mean of means, mode of zone labels."""
    cz = _cust_zone(spark, sf)
    zones = cz.groupBy(F.col("c_nationkey").alias("zone"), "district").agg(
        F.count("*").alias("n_customers"), F.avg("c_acctbal").alias("mean_balance"))
    seg = A.mode_by(cz.withColumnRenamed("c_nationkey", "zone"), "zone", "c_mktsegment", "top_segment")
    zt = materialize(zones.join(seg, "zone"))
    d = A.rollup(zt, "district", sums=["n_customers"], means=["mean_balance"], modes=["top_segment"])
    return d.select("district", F.col("n_customers").cast("long").alias("n_customers"),
                    C.round_dec("mean_balance", 4).alias("mean_balance"), "top_segment")


register("mode_rollup", f"""
with cz as (select c.*, n.n_regionkey as district from customer c join nation n on c.c_nationkey = n.n_nationkey),
z as (select c_nationkey as zone, district, count(*) as n_customers, avg(c_acctbal) as mean_balance from cz group by 1, 2),
sh as (select c_nationkey as zone, c_mktsegment, count(*) as c from cz group by 1, 2),
sm as (select zone, c_mktsegment as top_segment from (
        select *, row_number() over (partition by zone order by c desc, c_mktsegment) as rn from sh) where rn = 1),
zt as (select z.*, sm.top_segment from z join sm using (zone)),
dh as (select district, top_segment, count(*) as c from zt group by 1, 2),
dm as (select district, top_segment from (
        select *, row_number() over (partition by district order by c desc, top_segment) as rn from dh) where rn = 1)
select d.district, cast(sum(n_customers) as bigint) as n_customers, {rd('avg(mean_balance)', 4)} as mean_balance,
       any_value(dm.top_segment) as top_segment
from zt d join dm using (district) group by d.district
""")(mode_rollup)


# --------------------------------------------------- DP12 / AG7 / AG8 / SF15

def success_rate_and_median_quality(spark, sf):
    """DP12: per (zone, operator): throughput score = clip(median/100·100),
    success rate = mean(type ≠ error)·100, quality = ½·throughput + ½·success
    (NULL → 0), round 2.  Users are located through the customer table; the
    operator label is the user's segment, canonicalised."""
    (events,) = tables(spark, sf, "events")
    cz = _cust_zone(spark, sf).select(F.col("c_custkey").alias("user_id"),
                                      F.col("c_nationkey").alias("zone"),
                                      C.canonical("c_mktsegment").alias("operateur"))
    ev = events.select("user_id", "event_type", "value").join(cz, "user_id")
    keys = ["zone", "operateur"]
    med = A.exact_median(ev, keys, "value", "median_value")
    ok = ev.groupBy(*keys).agg(
        A.rate(F.col("event_type") != "error").alias("taux_succes"))
    q = med.join(ok, keys, "full")
    q = q.withColumn("score_debit", C.round_dec(C.clip(F.col("median_value") / 100.0 * 100.0), 2))
    q = q.withColumn("score_fiabilite", C.round_dec("taux_succes", 2))
    q = q.withColumn("score_qualite", C.round_dec(
        0.5 * F.coalesce("score_debit", F.lit(0.0)) + 0.5 * F.coalesce("score_fiabilite", F.lit(0.0)), 2))
    return q.select(*keys, "score_debit", "score_fiabilite",
                    F.lit(None).cast("double").alias("score_latence"), "score_qualite")


register("success_rate_and_median_quality", f"""
with ev as (
  select c.c_nationkey as zone,
         case when lower(trim(c.c_mktsegment)) like '%bouygue%' then 'Bouygues'
              when lower(trim(c.c_mktsegment)) like '%free%' then 'Free'
              when lower(trim(c.c_mktsegment)) like '%orange%' then 'Orange'
              when lower(trim(c.c_mktsegment)) like '%sfr%' then 'SFR'
              else upper(substr(trim(c.c_mktsegment), 1, 1)) || lower(substr(trim(c.c_mktsegment), 2)) end as operateur,
         e.event_type, e.value
  from events e join customer c on e.user_id = c.c_custkey),
a as (select zone, operateur, median(value) as median_value,
             cast(count(*) filter (where event_type <> 'error') as double) / cast(count(*) as double) * 100.0 as taux_succes
      from ev group by 1, 2),
b as (select zone, operateur,
             {rd('case when median_value is null then null else greatest(0.0, least(100.0, median_value / 100.0 * 100.0)) end', 2)} as score_debit,
             {rd('taux_succes', 2)} as score_fiabilite from a)
select zone, operateur, score_debit, score_fiabilite, cast(null as double) as score_latence,
       {rd('0.5 * coalesce(score_debit, 0.0) + 0.5 * coalesce(score_fiabilite, 0.0)', 2)} as score_qualite
from b
""")(success_rate_and_median_quality)


# ---------------------------------------------------- DP11 / AG14 / JN14

def deployment_rates(spark, sf):
    """DP11: per zone, one pass of conditional counts (no full outer join of
    three frames): total, deployed (status F), active (status O), both
    rates, the weighted fibre score and the best operator among deployed
    rows (argmax of count, ties alphabetical)."""
    orders, customer = tables(spark, sf, "orders", "customer")
    oz = orders.join(customer.select("c_custkey", F.col("c_nationkey").alias("zone")),
                     F.col("o_custkey") == F.col("c_custkey"))
    r = oz.groupBy("zone").agg(
        F.count("*").alias("total_imb"),
        A.count_filter(F.col("o_orderstatus") == "F").alias("imb_deployes"),
        A.count_filter(F.col("o_orderstatus") == "O").alias("pm_actifs"),
    )
    r = r.withColumn("taux_deploiement", C.round_dec(
        F.col("imb_deployes").cast("double") / F.col("total_imb").cast("double") * 100.0, 2))
    r = r.withColumn("taux_pm_actif", C.round_dec(
        F.col("pm_actifs").cast("double") / F.col("total_imb").cast("double") * 100.0, 2))
    r = r.withColumn("score_fibre", C.round_dec(
        0.60 * F.col("taux_deploiement") + 0.40 * F.col("taux_pm_actif"), 2))
    dep = oz.filter(F.col("o_orderstatus") == "F").groupBy("zone", "o_orderpriority") \
        .agg(F.count("*").alias("n"))
    best = A.argmax(dep, "zone", "n", "o_orderpriority", "meilleur_operateur_fibre")
    return r.join(best, "zone", "left")


register("deployment_rates", f"""
with oz as (select o.*, c.c_nationkey as zone from orders o join customer c on o.o_custkey = c.c_custkey),
r as (select zone, count(*) as total_imb,
             count(*) filter (where o_orderstatus = 'F') as imb_deployes,
             count(*) filter (where o_orderstatus = 'O') as pm_actifs
      from oz group by zone),
r2 as (select *, {rd('cast(imb_deployes as double) / cast(total_imb as double) * 100.0', 2)} as taux_deploiement,
                 {rd('cast(pm_actifs as double) / cast(total_imb as double) * 100.0', 2)} as taux_pm_actif from r),
dep as (select zone, o_orderpriority, count(*) as n from oz where o_orderstatus = 'F' group by 1, 2),
best as (select zone, o_orderpriority as meilleur_operateur_fibre from (
          select *, row_number() over (partition by zone order by n desc, o_orderpriority) as rn from dep) where rn = 1)
select r2.*, {rd('cast(0.60 as double) * taux_deploiement + cast(0.40 as double) * taux_pm_actif', 2)} as score_fibre,
       best.meilleur_operateur_fibre
from r2 left join best using (zone)
""")(deployment_rates)


# ---------------------------------------------------- DP10 / JN13 / SF19

def full_outer_two_tech(spark, sf):
    """JN13: two per-(supplier, flag) coverage tables (line status F = "4G",
    O = "5G") full-outer-joined on both keys; the district comes from the
    4G side only (kept quirk); best = row-wise max ignoring NULLs (SF19)."""
    lineitem, supplier, nation = tables(spark, sf, "lineitem", "supplier", "nation")
    li = lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_discount")

    def tech(status, name):
        return (li.filter(F.col("l_linestatus") == status)
                  .groupBy("l_suppkey", "l_returnflag")
                  .agg(C.round_dec(F.avg("l_discount") * 1000.0, 2).alias(name)))

    g4 = tech("F", "couv_4g").join(
        supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("arrondissement")),
        "l_suppkey", "left")
    g5 = tech("O", "couv_5g")
    j = J.full_outer(g4, g5, ["l_suppkey", "l_returnflag"])
    return j.select("l_suppkey", "l_returnflag", "arrondissement", "couv_4g", "couv_5g",
                    C.row_max("couv_4g", "couv_5g").alias("couv_max"))


register("full_outer_two_tech", f"""
with g4 as (select l_suppkey, l_returnflag, {rd('avg(l_discount) * 1000.0', 2)} as couv_4g
            from lineitem where l_linestatus = 'F' group by 1, 2),
g4d as (select g4.*, s.s_nationkey as arrondissement from g4 left join supplier s on g4.l_suppkey = s.s_suppkey),
g5 as (select l_suppkey, l_returnflag, {rd('avg(l_discount) * 1000.0', 2)} as couv_5g
       from lineitem where l_linestatus = 'O' group by 1, 2)
select coalesce(g4d.l_suppkey, g5.l_suppkey) as l_suppkey, coalesce(g4d.l_returnflag, g5.l_returnflag) as l_returnflag,
       g4d.arrondissement, couv_4g, couv_5g, greatest(couv_4g, couv_5g) as couv_max
from g4d full outer join g5 on g4d.l_suppkey = g5.l_suppkey and g4d.l_returnflag = g5.l_returnflag
""")(full_outer_two_tech)


# ---------------------------------------------------------- JN20 / WN5

def disaggregate_even(spark, sf):
    """JN20 + WN5: district totals (suppliers per region, by a canonical
    operator label) spread evenly over the district's zones (1 decimal);
    districts without any row keep a NULL operator and a 0 count; density
    per zone normalised ×100, round 2."""
    supplier, nation = tables(spark, sf, "supplier", "nation")
    members = nation.select(F.col("n_nationkey").alias("zone"), F.col("n_regionkey").alias("district"))
    facts = (supplier.filter(F.col("s_acctbal") > 0)
             .join(members, F.col("s_nationkey") == F.col("zone"))
             .select("district", F.when(F.col("s_acctbal") > 5000, F.lit("Orange"))
                     .otherwise(F.lit("Free")).alias("operateur")))
    totals = facts.groupBy("district", "operateur").agg(F.count("*").alias("n"))
    spread = J.spread_evenly(totals, members, "district", "n", "nb_antennes", digits=1)
    spread = materialize(spread)
    out = S.minmax(spread, {"nb_antennes": "score_densite"}, scale=100.0, digits=2)
    return out.select("zone", "district", "operateur", "nb_antennes", "score_densite")


register("disaggregate_even", f"""
with m as (select n_nationkey as zone, n_regionkey as district from nation),
f as (select m.district, case when s_acctbal > 5000 then 'Orange' else 'Free' end as operateur
      from supplier s join m on s.s_nationkey = m.zone where s_acctbal > 0),
t as (select district, operateur, count(*) as n from f group by 1, 2),
k as (select district, count(*) as k from m group by 1),
sp as (select m.zone, m.district, t.operateur,
              case when t.n is null then 0.0 else {rd('cast(t.n as double) / cast(k.k as double)', 1)} end as nb_antennes
       from m join k using (district) left join t using (district))
select zone, district, operateur, nb_antennes,
       case when (select max(nb_antennes) from sp) = (select min(nb_antennes) from sp) then 0.0
            else {rd('(nb_antennes - (select min(nb_antennes) from sp)) / ((select max(nb_antennes) from sp) - (select min(nb_antennes) from sp)) * 100.0', 2)} end as score_densite
from sp
""")(disaggregate_even)


# --------------------------------------------------- DP16 / SF18 / SF23 / JN11

def rate_per_10k(spark, sf):
    """DP16 at district level: E1 = orders / customers, E2 = suppliers /
    customers (safe division), S1..S4 = counts per 10 000 customers; WN3 on
    each (E* without NULL fill, S* with fill 0); education = (2·E1+E2)/3,
    health = mean(S1..S4), overall = (education+health)/2, round 4."""
    region, nation, customer, supplier, orders = tables(
        spark, sf, "region", "nation", "customer", "supplier", "orders")
    nz = nation.select(F.col("n_nationkey").alias("zone"), F.col("n_regionkey").alias("district"))
    cz = customer.join(nz, F.col("c_nationkey") == F.col("zone"))
    pop = cz.groupBy("district").agg(F.count("*").alias("population"),
                                     A.count_filter(F.col("c_acctbal") < 0).alias("n_debt"))
    sup = supplier.join(nz, F.col("s_nationkey") == F.col("zone")).groupBy("district").agg(
        F.count("*").alias("n_sup"), A.count_filter(F.col("s_acctbal") > 5000).alias("n_rich_sup"))
    ords = orders.join(cz.select("c_custkey", "district"), F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy("district").agg(F.count("*").alias("n_orders"),
                                 A.count_filter(F.col("o_orderstatus") == "P").alias("n_pending"))
    d = region.select(F.col("r_regionkey").alias("district")) \
        .join(pop, "district").join(sup, "district", "left").join(ords, "district", "left")
    d = d.select(
        "district",
        C.safe_div("n_orders", "population").alias("e1"),
        C.safe_div("n_sup", "population").alias("e2"),
        C.per_10k("n_sup", "population").alias("s1"),
        C.per_10k("n_rich_sup", "population").alias("s2"),
        C.per_10k("n_debt", "population").alias("s3"),
        C.per_10k("n_pending", "population").alias("s4"),
    )
    d = materialize(d)
    d = S.minmax(d, {"e1": "ne1", "e2": "ne2"})
    d = S.minmax(d, {"s1": "ns1", "s2": "ns2", "s3": "ns3", "s4": "ns4"}, fill=0)
    edu = (2.0 * F.col("ne1") + F.col("ne2")) / 3.0
    health = (F.col("ns1") + F.col("ns2") + F.col("ns3") + F.col("ns4")) / 4.0
    d = d.select("district", C.round_dec("e1", 6).alias("e1"), C.round_dec("e2", 6).alias("e2"),
                 C.round_dec(edu, 4).alias("score_education"),
                 C.round_dec(health, 4).alias("score_sante"),
                 C.round_dec((edu + health) / 2.0, 4).alias("score_aes"))
    return d


def _mm(c: str, src: str) -> str:
    return (f"(case when (select max({c}) from {src}) = (select min({c}) from {src}) then 0.0 "
            f"else ({c} - (select min({c}) from {src})) / ((select max({c}) from {src}) - (select min({c}) from {src})) end)")


register("rate_per_10k", f"""
with nz as (select n_nationkey as zone, n_regionkey as district from nation),
cz as (select c.*, nz.district from customer c join nz on c.c_nationkey = nz.zone),
pop as (select district, count(*) as population, count(*) filter (where c_acctbal < 0) as n_debt from cz group by 1),
sup as (select nz.district, count(*) as n_sup, count(*) filter (where s_acctbal > 5000) as n_rich_sup
        from supplier s join nz on s.s_nationkey = nz.zone group by 1),
ords as (select cz.district, count(*) as n_orders, count(*) filter (where o_orderstatus = 'P') as n_pending
         from orders o join cz on o.o_custkey = cz.c_custkey group by 1),
d as (select r.r_regionkey as district,
        cast(n_orders as double) / nullif(cast(population as double), 0) as e1,
        cast(n_sup as double) / nullif(cast(population as double), 0) as e2,
        cast(n_sup as double) * 10000.0 / nullif(cast(population as double), 0) as s1,
        cast(n_rich_sup as double) * 10000.0 / nullif(cast(population as double), 0) as s2,
        cast(n_debt as double) * 10000.0 / nullif(cast(population as double), 0) as s3,
        cast(n_pending as double) * 10000.0 / nullif(cast(population as double), 0) as s4
      from region r join pop on r.r_regionkey = pop.district
      left join sup on r.r_regionkey = sup.district left join ords on r.r_regionkey = ords.district),
f as (select district, e1, e2, coalesce(s1, 0.0) as s1, coalesce(s2, 0.0) as s2,
             coalesce(s3, 0.0) as s3, coalesce(s4, 0.0) as s4 from d),
n as (select district, e1, e2, {_mm('e1', 'f')} as ne1, {_mm('e2', 'f')} as ne2,
             {_mm('s1', 'f')} as ns1, {_mm('s2', 'f')} as ns2, {_mm('s3', 'f')} as ns3, {_mm('s4', 'f')} as ns4 from f)
select district, {rd('e1', 6)} as e1, {rd('e2', 6)} as e2,
       {rd('(2.0 * ne1 + ne2) / 3.0', 4)} as score_education,
       {rd('(ns1 + ns2 + ns3 + ns4) / 4.0', 4)} as score_sante,
       {rd('((2.0 * ne1 + ne2) / 3.0 + (ns1 + ns2 + ns3 + ns4) / 4.0) / 2.0', 4)} as score_aes
from n
""")(rate_per_10k)


# ---------------------------------------------------- SNK15 / AG15–AG17

def load_quality_metrics(spark, sf):
    """SNK15: one metrics row for a load: customers left-joined with their
    orders' zone reach (rows, distinct keys, duplicates, rows without a
    match, matched share, min/max/median/mean of the balance)."""
    customer, orders = tables(spark, sf, "customer", "orders")
    firsts = orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("zone"))
    j = customer.select("c_custkey", "c_acctbal").join(firsts, "c_custkey", "left")
    m = A.load_metrics(j, "c_custkey", "zone", {"c_acctbal": "c_acctbal"})
    return m.select("rows", "distinct_keys", "duplicate_rows", "rows_without_zone",
                    C.round_dec("matched_share", 6).alias("matched_share"),
                    "min_c_acctbal", "max_c_acctbal",
                    C.round_dec("median_c_acctbal", 4).alias("median_c_acctbal"),
                    C.round_dec("mean_c_acctbal", 4).alias("mean_c_acctbal"))


register("load_quality_metrics", f"""
with j as (select c.c_custkey, c.c_acctbal, o.o_orderkey as zone
           from customer c left join (select o_custkey, o_orderkey from orders where o_orderstatus = 'P') o
           on c.c_custkey = o.o_custkey)
select count(*) as rows, count(distinct c_custkey) as distinct_keys,
       count(*) - count(distinct c_custkey) as duplicate_rows,
       count(*) filter (where zone is null) as rows_without_zone,
       {rd('cast(count(zone) as double) / cast(count(*) as double)', 6)} as matched_share,
       min(c_acctbal) as min_c_acctbal, max(c_acctbal) as max_c_acctbal,
       {rd('median(c_acctbal)', 4)} as median_c_acctbal, {rd('avg(c_acctbal)', 4)} as mean_c_acctbal
from j
""")(load_quality_metrics)


def value_counts_top5(spark, sf):
    """AG16: top-5 frequency table of order priorities among urgent-ish orders
    (a top-k report: the limit is the feature)."""
    (orders,) = tables(spark, sf, "orders")
    return A.value_counts(orders, "o_orderpriority", 5)


register("value_counts_top5", """
select o_orderpriority, count(*) as n from orders group by 1 order by n desc, o_orderpriority limit 5
""")(value_counts_top5)


# ---------------------------------------------------------- JN15 / SO1

def antijoin_tuple_union(spark, sf):
    """JN15 + SO1: entries of the first list (customers) whose (number,
    district) tuple also appears among the second list's 'Polyvalent' rows
    (suppliers with a positive balance) are dropped — NULL-safe, a NULL
    district matches a NULL district — then both lists are unioned by name."""
    customer, supplier = tables(spark, sf, "customer", "supplier")
    num = lambda c: F.regexp_extract(F.col(c), r"#0*(\d+)$", 1)
    a = customer.select(num("c_name").alias("numero"),
                        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("district"),
                        F.lit("client").alias("type"))
    b = supplier.select(num("s_name").alias("numero"),
                        F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")).alias("district"),
                        F.when(F.col("s_acctbal") > 0, F.lit("Polyvalent")).otherwise(F.lit("Autre")).alias("type"))
    poly = b.filter(F.col("type") == "Polyvalent")
    kept = J.anti_join(a, poly, ["numero", "district"], null_safe=True)
    return kept.unionByName(b)


register("antijoin_tuple_union", """
with a as (select regexp_extract(c_name, '#0*(\\d+)$', 1) as numero,
                  case when c_acctbal >= 0 then c_nationkey end as district, 'client' as type from customer),
b as (select regexp_extract(s_name, '#0*(\\d+)$', 1) as numero,
             case when s_acctbal >= 0 then s_nationkey end as district,
             case when s_acctbal > 0 then 'Polyvalent' else 'Autre' end as type from supplier)
select * from a where not exists (select 1 from b where b.type = 'Polyvalent'
  and b.numero is not distinct from a.numero and b.district is not distinct from a.district)
union all select * from b
""")(antijoin_tuple_union)


# ---------------------------------------------------------- FLT4 / FLT5 / FLT6

def filtered_sales(spark, sf):
    """FLT4 + FLT5 + FLT6: an IN-set, a pattern and a range on raw columns,
    counted per kind of part."""
    (part,) = tables(spark, sf, "part")
    kept = part.filter(F.col("p_brand").isin("Brand#13", "Brand#21", "Brand#34") & F.col("p_name").rlike(r"^[a-m]\w+ ")
                       & F.col("p_size").between(5, 40))
    return kept.groupBy("p_type").agg(F.count("*").alias("n"), F.min("p_size").cast("long").alias("least"))


register("filtered_sales", r"""
select p_type, count(*) as n, cast(min(p_size) as bigint) as least from part
where p_brand in ('Brand#13', 'Brand#21', 'Brand#34') and regexp_matches(p_name, '^[a-m]\w+ ') and p_size between 5 and 40
group by 1
""")(filtered_sales)


# ---------------------------------------------------------- JN18 / JN19

def attribute_per_key(spark, sf):
    """JN18 + JN19: one district per zone from the rows that name it, and the
    doubled district columns of both sides of an outer join made one."""
    customer, supplier = tables(spark, sf, "customer", "supplier")
    a = J.first_attribute(customer.select(F.col("c_nationkey").alias("zone"), (F.col("c_nationkey") % 5).alias("d")), "zone", "d")
    b = J.first_attribute(supplier.filter("s_acctbal > 0").select(F.col("s_nationkey").alias("zone"),
                                                                  (F.col("s_nationkey") % 5).alias("d_2")), "zone", "d_2")
    return J.coalesce_pair(a.filter("d <> 1").join(b, "zone", "full"), "d", "d_2", "district").select("zone", "district")


register("attribute_per_key", """
with a as (select c_nationkey as zone, min(c_nationkey % 5) as d from customer group by 1),
b as (select s_nationkey as zone, min(s_nationkey % 5) as d_2 from supplier where s_acctbal > 0 group by 1)
select coalesce(a.zone, b.zone) as zone, coalesce(b.d_2, a.d) as district
from (select * from a where d <> 1) a full join b on a.zone = b.zone
""")(attribute_per_key)
