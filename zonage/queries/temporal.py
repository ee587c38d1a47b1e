"""Period queries: latest snapshot, as-of nearest-year join, year resolution,
affordability index (exact join with nearest-year fallback)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import temporal as TM
from . import register
from ._common import rd, tables


def _cust_zone(spark, sf):
    (customer,) = tables(spark, sf, "customer")
    return customer.select("c_custkey", F.col("c_nationkey").alias("zone"))


def latest_snapshot(spark, sf):
    """FLT9: orders of the latest order year, per status, and the global latest year."""
    (orders,) = tables(spark, sf, "orders")
    o = orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("annee"))
    per = TM.latest_snapshot(o, "annee", by=["o_orderstatus"]).withColumn("scope", F.lit("status"))
    glob = TM.latest_snapshot(o, "annee").withColumn("scope", F.lit("global"))
    return per.unionByName(glob).select("scope", "o_orderkey", "o_orderstatus",
                                        F.col("annee").cast("int").alias("annee"))


register("latest_snapshot", """
with o as (select o_orderkey, o_orderstatus, cast(year(o_orderdate) as integer) as annee from orders)
select 'status' as scope, o_orderkey, o_orderstatus, annee from o
where annee = (select max(annee) from o o2 where o2.o_orderstatus = o.o_orderstatus)
union all
select 'global' as scope, o_orderkey, o_orderstatus, annee from o where annee = (select max(annee) from o)
""")(latest_snapshot)


def _event_years(spark, sf):
    (events,) = tables(spark, sf, "events")
    return events.join(_cust_zone(spark, sf), F.col("user_id") == F.col("c_custkey")) \
        .groupBy("zone", F.year("ts").alias("annee_evt")).agg(F.count("*").alias("n_events"))


def _order_years(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    return orders.join(_cust_zone(spark, sf), F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy("zone", F.year("o_orderdate").alias("annee")).agg(
            F.count("*").alias("n_orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value_orders"))


def nearest_year_asof(spark, sf):
    """JN8: event activity per (zone, year) matched to the order statistics
    of the same zone in the nearest order year (tie → earlier)."""
    j = TM.nearest_year_join(_event_years(spark, sf), _order_years(spark, sf), ["zone"],
                             "annee_evt", "annee", tie="earlier")
    return j.select("zone", F.col("annee_evt").cast("int").alias("annee_evt"),
                    F.col("annee").cast("int").alias("annee"), "n_events", "n_orders", "value_orders")


_NEAREST_SQL = """
with ev as (select c.c_nationkey as zone, cast(year(e.ts) as integer) as annee_evt, count(*) as n_events
            from events e join customer c on e.user_id = c.c_custkey group by 1, 2),
ord as (select c.c_nationkey as zone, cast(year(o.o_orderdate) as integer) as annee, count(*) as n_orders,
               cast(sum(cast(o.o_totalprice as decimal(18,2))) as double) as value_orders
        from orders o join customer c on o.o_custkey = c.c_custkey group by 1, 2),
ty as (select distinct annee_evt as t from ev),
ay as (select distinct annee as y from ord),
m as (select t, (select y from ay order by abs(y - t), y limit 1) as y from ty)
select ev.zone, ev.annee_evt, ord.annee, ev.n_events, ord.n_orders, ord.value_orders
from ev join m on ev.annee_evt = m.t join ord on ord.zone = ev.zone and ord.annee = m.y
"""
register("nearest_year_asof", _NEAREST_SQL)(nearest_year_asof)


def nearest_year_resolve(spark, sf):
    """JN9 + ST4: every distinct requested year (event years and ship years)
    resolved to the nearest year present in the orders, tie → later; plus
    the single-target form for the latest event year."""
    events, lineitem, orders = tables(spark, sf, "events", "lineitem", "orders")
    targets = events.select(F.year("ts").alias("y")).unionByName(
        lineitem.select(F.year("l_shipdate").alias("y")))
    avail = orders.select(F.year("o_orderdate").alias("y"))
    m = TM.nearest_year_map(targets, avail, tie="later")
    latest_evt = events.select(F.max(F.year("ts"))).scalar()
    single = TM.resolve_year(avail, "y", latest_evt, tie="later") \
        .select(F.lit("single").alias("kind"), F.lit(None).cast("long").alias("target"), "year")
    return m.select(F.lit("map").alias("kind"), "target", "year").unionByName(single) \
        .select("kind", F.col("target").cast("int").alias("target"), F.col("year").cast("int").alias("year"))


register("nearest_year_resolve", """
with ty as (select distinct cast(year(ts) as integer) as t from events
            union select distinct cast(year(l_shipdate) as integer) from lineitem),
ay as (select distinct cast(year(o_orderdate) as integer) as y from orders)
select 'map' as kind, t as target, (select y from ay order by abs(y - t), y desc limit 1) as year from ty
union all
select 'single' as kind, cast(null as integer) as target,
       (select y from ay order by abs(y - (select max(cast(year(ts) as integer)) from events)), y desc limit 1) as year
""")(nearest_year_resolve)


def affordability_index(spark, sf):
    """DP4: zone-year median unit price (lineitem) over monthly income (median
    order value / 12) on the exact (zone, year) join — falling back to the
    nearest-year join only if the exact join is empty; iai rounded to 4."""
    lineitem, orders = tables(spark, sf, "lineitem", "orders")
    cz = _cust_zone(spark, sf)
    sales = (C.positive(lineitem.select("l_orderkey", "l_extendedprice", "l_quantity"),
                        "l_extendedprice", "l_quantity")
             .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .join(cz, F.col("o_custkey") == F.col("c_custkey"))
             .select("zone", F.year("o_orderdate").alias("annee"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("prix_m2")))
    prices = A.exact_median(sales, ["zone", "annee"], "prix_m2", "prix_m2_median") \
        .withColumn("prix_m2_median", C.round_dec("prix_m2_median", 2))
    inc = orders.join(cz, F.col("o_custkey") == F.col("c_custkey")) \
        .select("zone", F.year("o_orderdate").alias("annee"), "o_totalprice")
    income = A.exact_median(inc, ["zone", "annee"], "o_totalprice", "revenu_median") \
        .withColumn("revenu_median", C.round_dec("revenu_median", 2))
    j = TM.exact_or_nearest(income, prices, ["zone"], "annee")
    j = j.filter(F.col("revenu_median").isNotNull() & F.col("prix_m2_median").isNotNull())
    iai = C.round_dec(F.col("prix_m2_median") / (F.col("revenu_median") / 12.0), 4)
    return j.select("zone", F.col("annee").cast("int").alias("annee"), "revenu_median",
                    "prix_m2_median", iai.alias("iai"))


register("affordability_index", f"""
with cz as (select c_custkey, c_nationkey as zone from customer),
s as (select cz.zone, cast(year(o.o_orderdate) as integer) as annee, l.l_extendedprice / l.l_quantity as prix_m2
      from lineitem l join orders o on l.l_orderkey = o.o_orderkey join cz on o.o_custkey = cz.c_custkey
      where l.l_extendedprice > 0 and l.l_quantity > 0),
p as (select zone, annee, {rd('median(prix_m2)', 2)} as prix_m2_median from s group by 1, 2),
i as (select cz.zone, cast(year(o.o_orderdate) as integer) as annee, {rd('median(o.o_totalprice)', 2)} as revenu_median
      from orders o join cz on o.o_custkey = cz.c_custkey group by 1, 2),
ex as (select i.zone, i.annee, i.revenu_median, p.prix_m2_median from i join p using (zone, annee)),
ty as (select distinct annee as t from i), ay as (select distinct annee as y from p),
m as (select t, (select y from ay order by abs(y - t), y limit 1) as y from ty),
nr as (select i.zone, i.annee, i.revenu_median, p.prix_m2_median
       from i join m on i.annee = m.t join p on p.zone = i.zone and p.annee = m.y),
j as (select * from ex union all select * from nr where (select count(*) from ex) = 0)
select zone, annee, revenu_median, prix_m2_median, {rd('prix_m2_median / (revenu_median / 12.0)', 4)} as iai
from j where revenu_median is not null and prix_m2_median is not null
""")(affordability_index)
