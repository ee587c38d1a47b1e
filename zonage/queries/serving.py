"""Serving queries: wide per-zone and per-district indicator tables, map
layers, GeoJSON features, search, two-zone comparison, labels and the
address-reference join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import load as L
from ..operators import temporal as TM
from ..session import materialize, side_by_side
from ..sources import lattice as LT
from . import ORACLES, register
from ._common import rd, tables

TARGET_YEAR = 2024
# Indicators of the zone table averaged per district, and the
# operator labels whose mode is taken.
DISTRICT_MEANS = ["revenu_median", "prix_m2_median", "iai", "score_environnemental", "score_reseau",
                  "score_transport_collectif", "score_velib", "score_mobilite"]
DISTRICT_MODES = ["meilleur_operateur_mobile", "meilleur_operateur_fibre"]


def _registry():
    from . import REGISTRY
    return REGISTRY


def wide_zone_indicators(spark, sf):
    """DP17: one row per zone for the requested year — every yearly table is
    read at its own nearest available year (JN9, tie → later), then a chain
    of key-unique left joins on the zone reference (JN10); housing counts
    fill 0, other gaps stay NULL; NaN/Inf sanitised (SNK11)."""
    reg = _registry()
    nation, orders, customer = tables(spark, sf, "nation", "orders", "customer")
    ref = nation.select(F.col("n_nationkey").cast("long").alias("zone"),
                        F.col("n_regionkey").alias("district"), F.col("n_name").alias("nom"))
    housing = (orders.filter(F.col("o_orderstatus") == "F")
               .join(customer.select("c_custkey", F.col("c_nationkey").cast("long").alias("zone")),
                     F.col("o_custkey") == F.col("c_custkey"))
               .groupBy("zone", F.year("o_orderdate").alias("annee"))
               .agg(F.count("*").alias("nb_logements_sociaux_finances")))
    housing, socio, env, net, mob = side_by_side(
        spark, lambda: materialize(housing),
        lambda: materialize(reg["affordability_index"](spark, sf).withColumn("zone", F.col("zone").cast("long"))),
        lambda: reg["zone_counts_score"](spark, sf), lambda: reg["network_score"](spark, sf),
        lambda: reg["minmax_composite_rank"](spark, sf))
    hy = TM.resolve_year(housing, "annee", TARGET_YEAR, tie="later")
    housing = housing.join(F.broadcast(hy), F.col("annee") == F.col("year")) \
        .groupBy("zone").agg(F.sum("nb_logements_sociaux_finances").alias("nb_logements_sociaux_finances"))
    sy = TM.resolve_year(socio, "annee", TARGET_YEAR, tie="later")
    socio = socio.join(F.broadcast(sy), F.col("annee") == F.col("year")) \
        .select("zone", "revenu_median", "prix_m2_median", "iai")
    env = env.select(F.col("zone").cast("long").alias("zone"), F.col("score").alias("score_environnemental"))
    net = net.select("zone", F.col("score_final_stocke").alias("score_reseau"),
                     "meilleur_operateur_mobile", "meilleur_operateur_fibre")
    mob = mob.select(F.col("zone").cast("long").alias("zone"), "score_transport_collectif", "score_velib", "score_mobilite")
    out = ref.join(housing, "zone", "left").fillna({"nb_logements_sociaux_finances": 0})
    for t in (socio, env, net, mob):
        out = out.join(t, "zone", "left")
    return C.sanitize(out)


def _cte(key: str) -> str:
    return ORACLES[key]


def _wide_zone_sql() -> str:
    return f"""
with h0 as (select cast(c.c_nationkey as bigint) as zone, cast(year(o.o_orderdate) as integer) as annee, count(*) as n
            from orders o join customer c on o.o_custkey = c.c_custkey where o.o_orderstatus = 'F' group by 1, 2),
hy as (select (select annee from (select distinct annee from h0) order by abs(annee - {TARGET_YEAR}), annee desc limit 1) as y),
h as (select zone, cast(sum(n) as bigint) as nb_logements_sociaux_finances from h0 where annee = (select y from hy) group by zone),
s0 as ({_cte('affordability_index')}),
sy as (select (select annee from (select distinct annee from s0) order by abs(annee - {TARGET_YEAR}), annee desc limit 1) as y),
s as (select cast(zone as bigint) as zone, revenu_median, prix_m2_median, iai from s0 where annee = (select y from sy)),
e as (select cast(zone as bigint) as zone, score as score_environnemental from ({_cte('zone_counts_score')})),
nt as (select zone, score_final_stocke as score_reseau, meilleur_operateur_mobile, meilleur_operateur_fibre
       from ({_cte('network_score')})),
m as (select cast(zone as bigint) as zone, score_transport_collectif, score_velib, score_mobilite
      from ({_cte('minmax_composite_rank')}))
select cast(n.n_nationkey as bigint) as zone, n.n_regionkey as district, n.n_name as nom,
       coalesce(h.nb_logements_sociaux_finances, 0) as nb_logements_sociaux_finances,
       s.revenu_median, s.prix_m2_median, s.iai, e.score_environnemental, nt.score_reseau,
       nt.meilleur_operateur_mobile, nt.meilleur_operateur_fibre,
       m.score_transport_collectif, m.score_velib, m.score_mobilite
from nation n left join h on h.zone = n.n_nationkey left join s on s.zone = n.n_nationkey
left join e on e.zone = n.n_nationkey left join nt on nt.zone = n.n_nationkey left join m on m.zone = n.n_nationkey
"""


register("wide_zone_indicators", None)(wide_zone_indicators)


def wide_district_indicators(spark, sf):
    """DP18: the zone table rolled up per district (sum of housing, NULL-
    skipping means of the scores, modes of the operator labels, AG13) joined
    with the district education/health scores (DP16)."""
    reg = _registry()
    z = materialize(wide_zone_indicators(spark, sf))
    d = A.rollup(z, "district", sums=["nb_logements_sociaux_finances"], means=DISTRICT_MEANS,
                 modes=DISTRICT_MODES)
    aes = reg["rate_per_10k"](spark, sf).select("district", "score_education", "score_sante", "score_aes")
    d = d.join(aes, "district", "left")
    return C.sanitize(d.select(
        "district", F.col("nb_logements_sociaux_finances").cast("long").alias("nb_logements_sociaux_finances"),
        *[C.round_dec(c, 4).alias(c) for c in DISTRICT_MEANS], *DISTRICT_MODES,
        "score_education", "score_sante", "score_aes"))


def _mode_sql(col: str) -> str:
    return (f"{col}_m as (select district, {col} from (select district, {col}, row_number() over "
            f"(partition by district order by count(*) desc, {col}) as rn from z where {col} is not null "
            f"group by district, {col}) where rn = 1)")


def _wide_district_sql() -> str:
    means = ", ".join(f"{rd(f'avg({c})', 4)} as {c}" for c in DISTRICT_MEANS)
    return f"""
with z as ({_wide_zone_sql()}),
{_mode_sql('meilleur_operateur_mobile')},
{_mode_sql('meilleur_operateur_fibre')},
a as ({_cte('rate_per_10k')}),
g as (select district, cast(sum(nb_logements_sociaux_finances) as bigint) as nb_logements_sociaux_finances, {means}
      from z group by district)
select g.*, mm.meilleur_operateur_mobile, mf.meilleur_operateur_fibre, a.score_education, a.score_sante, a.score_aes
from g left join meilleur_operateur_mobile_m mm using (district) left join meilleur_operateur_fibre_m mf using (district)
left join a using (district)
"""


register("wide_district_indicators", None)(wide_district_indicators)


# ---------------------------------------------------------- SNK10 / SF13 / SF20

def _coord(c) -> F.Column:
    return F.round(F.col(c).cast("decimal(38,10)"), 6).cast("decimal(12,6)")


def layer_point_geojson(spark, sf):
    """SNK10 + SF13 + SF20: a map layer ``(code, nom, geo_shape)`` — code,
    ``ligne || ' - ' || nom`` label (NULL if a part is NULL) and a Point
    GeoJSON text from the supplier's coordinates."""
    (supplier,) = tables(spark, sf, "supplier")
    s = LT.with_point(supplier, "s_suppkey")
    ligne = F.when(F.col("s_acctbal") > 0, F.concat(F.lit("L"), (F.col("s_nationkey") % 14 + 1).cast("string")))
    return s.select(F.col("s_suppkey").cast("string").alias("code"),
                    F.concat(ligne, F.lit(" - "), F.col("s_name")).alias("nom"),
                    C.point_geojson(_coord("x"), _coord("y")).alias("geo_shape"))


def _coord_sql(e: str) -> str:
    return f"cast(cast(round(cast({e} as decimal(38,10)), 6) as decimal(12,6)) as varchar)"


register("layer_point_geojson", f"""
select cast(s_suppkey as varchar) as code,
       (case when s_acctbal > 0 then 'L' || cast(s_nationkey % 14 + 1 as varchar) end) || ' - ' || s_name as nom,
       '{{"type": "Point", "coordinates": [' || {_coord_sql(LT.sql_point('s_suppkey', 'x'))} || ', '
         || {_coord_sql(LT.sql_point('s_suppkey', 'y'))} || ']}}' as geo_shape
from supplier
""")(layer_point_geojson)


def feature_export(spark, sf):
    """SNK9: one GeoJSON Feature document per supplier (``_id`` + JSON text)."""
    lay = layer_point_geojson(spark, sf)
    (supplier,) = tables(spark, sf, "supplier")
    lay = lay.join(supplier.select(F.col("s_suppkey").cast("string").alias("code"),
                                   F.col("s_nationkey").alias("zone")), "code")
    return L.to_features(lay, "code", "geo_shape", ["code", "zone"])


register("feature_export", f"""
with l as ({ORACLES['layer_point_geojson']})
select l.code as _id, '{{"type":"Feature","properties":' || json_object('code', l.code, 'zone', s.s_nationkey)::varchar
       || ',"geometry":' || l.geo_shape || '}}' as feature
from l join supplier s on cast(s.s_suppkey as varchar) = l.code
""")(feature_export)


# ---------------------------------------------------------- DP20 / ST3

def zone_search(spark, sf):
    """ST3: first 6 zones (by code) whose name or code contains the query text
    — a top-k report, the limit is the feature."""
    (nation,) = tables(spark, sf, "nation")
    q = "1"
    hit = F.lower(F.col("n_name")).contains(q) | F.col("n_nationkey").cast("string").contains(q)
    return nation.filter(hit).orderBy("n_nationkey").limit(6).select(
        F.col("n_nationkey").alias("zone"), F.col("n_name").alias("nom"))


register("zone_search", """
select n_nationkey as zone, n_name as nom from nation
where contains(lower(n_name), '1') or contains(cast(n_nationkey as varchar), '1')
order by n_nationkey limit 6
""")(zone_search)


# Indicators where a lower value is better in a comparison.
LOWER_IS_BETTER = {"prix_m2_median", "iai"}
COMPARE_COLS = ["revenu_median", "prix_m2_median", "iai", "score_environnemental", "score_mobilite"]


def zone_compare(spark, sf):
    """DP20: two zones side by side per indicator (unpivot), winner by the
    indicator's direction; ties → the second zone."""
    z = wide_zone_indicators(spark, sf)
    a_id, b_id = 1, 2
    long = z.filter(F.col("zone").isin(a_id, b_id)).unpivot(
        "zone", COMPARE_COLS, "indicateur", "valeur")
    a = long.filter(F.col("zone") == a_id).select("indicateur", F.col("valeur").alias("zone_a"))
    b = long.filter(F.col("zone") == b_id).select("indicateur", F.col("valeur").alias("zone_b"))
    j = a.join(b, "indicateur", "full")
    lower = F.col("indicateur").isin(*sorted(LOWER_IS_BETTER))
    a_wins = F.when(lower, F.col("zone_a") < F.col("zone_b")).otherwise(F.col("zone_a") > F.col("zone_b"))
    win = F.when(F.col("zone_a").isNull() | F.col("zone_b").isNull(), F.lit(None).cast("long")) \
        .when(a_wins, F.lit(a_id).cast("long")).otherwise(F.lit(b_id).cast("long"))
    return j.select("indicateur", "zone_a", "zone_b", win.alias("gagnant"))


def _compare_sql() -> str:
    unp = " union all ".join(
        f"select zone, '{c}' as indicateur, cast({c} as double) as valeur from z" for c in COMPARE_COLS)
    lower = ", ".join(f"'{c}'" for c in sorted(LOWER_IS_BETTER))
    return f"""
with z as ({_wide_zone_sql()}),
l as ({unp}),
a as (select indicateur, valeur as zone_a from l where zone = 1),
b as (select indicateur, valeur as zone_b from l where zone = 2)
select coalesce(a.indicateur, b.indicateur) as indicateur, zone_a, zone_b,
       case when zone_a is null or zone_b is null then null
            when (case when coalesce(a.indicateur, b.indicateur) in ({lower}) then zone_a < zone_b else zone_a > zone_b end)
            then cast(1 as bigint) else cast(2 as bigint) end as gagnant
from a full outer join b on a.indicateur = b.indicateur
"""


register("zone_compare", None)(zone_compare)


# ---------------------------------------------------------- SF21 / SF22

def affordability_band(spark, sf):
    """SF22 + SF21: band label and gauge score of the affordability index,
    with the district-style zone labels."""
    t = _registry()["affordability_index"](spark, sf)
    gauge = C.round_dec(C.gauge("iai"), 2)
    return t.select("zone", "annee", "iai", C.band("iai").alias("niveau"), gauge.alias("jauge"),
                    C.district_zone_prefix(F.col("zone") + 1).alias("code_prefix"),
                    C.district_label(F.col("zone") + 1).alias("libelle"))


register("affordability_band", f"""
with t as ({ORACLES['affordability_index']})
select zone, annee, iai,
       case when iai is null then null when iai < 5.0 then 'Bon' when iai < 10.0 then 'Moyen' else 'Faible' end as niveau,
       {rd('case when iai < 5.0 then 100.0 - iai * 8.0 when iai < 10.0 then 100.0 - iai * 6.0 when iai is not null then greatest(10.0, 100.0 - iai * 5.0) end', 2)} as jauge,
       '751' || lpad(cast(zone + 1 as varchar), 2, '0') as code_prefix,
       case when zone + 1 = 1 then '1er' else cast(zone + 1 as varchar) || 'e' end as libelle
from t
""")(affordability_band)


# ---------------------------------------------------------- SF14 / JN17

def address_reference_join(spark, sf):
    """SF14 + JN17: customer addresses composed from number / street type /
    street (NULL parts → ''), unusable ones (≤ 2 chars) dropped, then
    geocoded by a left join on an address reference built from suppliers."""
    customer, supplier = tables(spark, sf, "customer", "supplier")
    numero = F.when(F.col("c_custkey") % 11 != 0, (F.col("c_custkey") % 100).cast("string"))
    voie = F.concat(F.lit("Supplier#"), F.lpad((F.col("c_custkey") % 120).cast("string"), 9, "0"))
    adresse = F.trim(F.concat_ws(" ", F.coalesce(numero, F.lit("")), F.lit("rue"), voie))
    c = customer.select("c_custkey", adresse.alias("adresse")).filter(F.length("adresse") > 2)
    ref = LT.with_point(supplier, "s_suppkey").select(
        F.trim(F.concat_ws(" ", (F.col("s_suppkey") % 100).cast("string"), F.lit("rue"), F.col("s_name")))
        .alias("adresse"), F.col("y").alias("latitude"), F.col("x").alias("longitude"))
    ref = A.drop_null_keys(ref, ["adresse"]).groupBy("adresse").agg(F.min(F.struct("latitude", "longitude")).alias("p")) \
        .select("adresse", "p.latitude", "p.longitude")  # one point of the reference, not a mix of two
    return c.join(ref, "adresse", "left")


register("address_reference_join", f"""
with c as (select c_custkey, trim(concat_ws(' ', coalesce(case when c_custkey % 11 <> 0 then cast(c_custkey % 100 as varchar) end, ''),
             'rue', 'Supplier#' || lpad(cast(c_custkey % 120 as varchar), 9, '0'))) as adresse from customer),
r as (select trim(concat_ws(' ', cast(s_suppkey % 100 as varchar), 'rue', s_name)) as adresse,
             {LT.sql_point('s_suppkey', 'y')} as latitude, {LT.sql_point('s_suppkey', 'x')} as longitude from supplier),
rr as (select adresse, latitude, longitude from (select *, row_number() over (partition by adresse order by latitude, longitude) as k from r) where k = 1)
select c.c_custkey, c.adresse, rr.latitude, rr.longitude from c left join rr using (adresse) where length(c.adresse) > 2
""")(address_reference_join)


# ---------------------------------------------------------- ST1 / ST2

def top_ranked_zones(spark, sf):
    """ST1 + ST2: the ten best zones by rank, then zone (a top-k report: the
    limit is the feature)."""
    t = _registry()["zone_counts_score"](spark, sf)
    return t.orderBy(F.col("rank").asc(), F.col("zone").asc()).limit(10).select("zone", "score", "rank")


register("top_ranked_zones", f"""
select zone, score, rank from ({ORACLES['zone_counts_score']}) order by rank, zone limit 10
""")(top_ranked_zones)


def register_late_oracles() -> None:
    """Oracles composed from other oracles (need the registry filled)."""
    ORACLES.setdefault("wide_zone_indicators", _wide_zone_sql().strip())
    ORACLES.setdefault("wide_district_indicators", _wide_district_sql().strip())
    ORACLES.setdefault("zone_compare", _compare_sql().strip())


def zone_label(spark, sf):
    """SF21: zone codes and labels — 9-character zone code built from the
    district number (``751`` + 2-digit district + 4-digit sequence), the
    5-character commune prefix, and the ``1er`` / ``Ne`` district label."""
    (nation,) = tables(spark, sf, "nation")
    d = F.col("n_nationkey") % 20 + 1
    prefix = C.district_zone_prefix(d)
    return nation.select(F.col("n_nationkey").alias("zone"), prefix.alias("commune"),
                         F.concat(prefix, F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("code_iris"),
                         C.district_label(d).alias("libelle"))


register("zone_label", """
select n_nationkey as zone, '751' || lpad(cast(n_nationkey % 20 + 1 as varchar), 2, '0') as commune,
       '751' || lpad(cast(n_nationkey % 20 + 1 as varchar), 2, '0') || lpad(cast(n_nationkey as varchar), 4, '0') as code_iris,
       case when n_nationkey % 20 + 1 = 1 then '1er' else cast(n_nationkey % 20 + 1 as varchar) || 'e' end as libelle
from nation
""")(zone_label)
