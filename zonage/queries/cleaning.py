"""Cleaning queries: the coercion/parsing functions applied to messy text
built row by row from table columns (both engines build the same strings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from . import register
from ._common import tables

NUM_RE = C.NUMERIC_PATTERN


def _num_sql(s: str) -> str:
    return f"(case when regexp_matches({s}, '{NUM_RE}') then try_cast(trim({s}) as double) end)"


def _int_sql(s: str) -> str:
    d = _num_sql(s)
    return f"(case when {d} = floor({d}) then cast({d} as bigint) end)"


def _s(c: str) -> F.Column:
    return F.col(c).cast("string")


# ------------------------------------------------------------------ SF1

def numeric_coercion(spark, sf):
    """SF1: ``ns``/``nd``/empty/NULL/``12d``/``NaN``/``12.0``/padded values."""
    (customer,) = tables(spark, sf, "customer")
    k = F.col("c_custkey")
    raw = (F.when(k % 8 == 0, F.lit("ns")).when(k % 8 == 1, F.lit("nd"))
           .when(k % 8 == 2, F.lit("")).when(k % 8 == 3, F.concat(_s("c_custkey"), F.lit("d")))
           .when(k % 8 == 4, F.lit("NaN")).when(k % 8 == 5, F.concat(_s("c_nationkey"), F.lit(".0")))
           .when(k % 8 == 6, F.concat(F.lit(" "), _s("c_custkey"), F.lit(".25 ")))
           .otherwise(F.lit(None).cast("string")))
    c = customer.select("c_custkey", raw.alias("raw"))
    return c.select("c_custkey", "raw", C.to_number("raw").alias("num"), C.to_int("raw").alias("int_value"))


register("numeric_coercion", f"""
with c as (select c_custkey, case c_custkey % 8 when 0 then 'ns' when 1 then 'nd' when 2 then ''
  when 3 then cast(c_custkey as varchar) || 'd' when 4 then 'NaN' when 5 then cast(c_nationkey as varchar) || '.0'
  when 6 then ' ' || cast(c_custkey as varchar) || '.25 ' else null end as raw from customer)
select c_custkey, raw, {_num_sql('raw')} as num, {_int_sql('raw')} as int_value from c
""")(numeric_coercion)


# ---------------------------------------------------------------- SF2 / SF3

def french_decimal(spark, sf):
    """SF2 + SF3: decimal commas and ``dd/MM/yyyy`` dates (with impossible
    dates) parsed; the sale year extracted."""
    (orders,) = tables(spark, sf, "orders")
    k = F.col("o_orderkey")
    raw_val = F.concat(_s("o_custkey"), F.lit(","), (k % 100).cast("string"))
    raw_date = F.when(k % 9 == 0, F.lit("31/02/2001")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    o = orders.select("o_orderkey", raw_val.alias("raw_value"), raw_date.alias("raw_date"))
    d = C.parse_date("raw_date")
    return o.select("o_orderkey", "raw_value", C.comma_decimal("raw_value").alias("valeur"),
                    "raw_date", d.alias("date_mutation"), F.year(d).alias("annee"))


register("french_decimal", f"""
with o as (select o_orderkey, cast(o_custkey as varchar) || ',' || cast(o_orderkey % 100 as varchar) as raw_value,
  case when o_orderkey % 9 = 0 then '31/02/2001' else strftime(o_orderdate, '%d/%m/%Y') end as raw_date from orders)
select o_orderkey, raw_value, {_num_sql("replace(raw_value, ',', '.')")} as valeur, raw_date,
       cast(try_strptime(raw_date, '%d/%m/%Y') as date) as date_mutation,
       cast(year(try_strptime(raw_date, '%d/%m/%Y')) as integer) as annee
from o
""")(french_decimal)


# ------------------------------------------------------------------ SF4

def latlon_parse(spark, sf):
    """SF4: ``"lat, lon"`` text — well formed, no space, single value, junk,
    three parts, NULL."""
    (customer,) = tables(spark, sf, "customer")
    k = F.col("c_custkey")
    lat = F.concat(F.lit("48."), (k % 97).cast("string"))
    lon = F.concat(F.lit("2."), (k % 89).cast("string"))
    raw = (F.when(k % 6 == 0, F.concat(lat, F.lit(", "), lon))
           .when(k % 6 == 1, F.concat(lat, F.lit(","), lon))
           .when(k % 6 == 2, lat)
           .when(k % 6 == 3, F.lit("a,b"))
           .when(k % 6 == 4, F.concat(lat, F.lit(","), lon, F.lit(",3")))
           .otherwise(F.lit(None).cast("string")))
    c = customer.select("c_custkey", raw.alias("raw"))
    la, lo = C.lat_lon("raw")
    return c.select("c_custkey", "raw", la.alias("lat"), lo.alias("lon"))


def _latlon_sql() -> str:
    p = "string_split(raw, ',')"
    la = _num_sql(f"trim({p}[1])")
    lo = _num_sql(f"trim({p}[2])")
    ok = f"(len({p}) = 2 and {la} is not null and {lo} is not null)"
    return f"case when {ok} then {la} end as lat, case when {ok} then {lo} end as lon"


register("latlon_parse", f"""
with c as (select c_custkey, case c_custkey % 6
  when 0 then '48.' || cast(c_custkey % 97 as varchar) || ', 2.' || cast(c_custkey % 89 as varchar)
  when 1 then '48.' || cast(c_custkey % 97 as varchar) || ',2.' || cast(c_custkey % 89 as varchar)
  when 2 then '48.' || cast(c_custkey % 97 as varchar)
  when 3 then 'a,b'
  when 4 then '48.' || cast(c_custkey % 97 as varchar) || ',2.' || cast(c_custkey % 89 as varchar) || ',3'
  else null end as raw from customer)
select c_custkey, raw, {_latlon_sql()} from c
""")(latlon_parse)


# ------------------------------------------------------------ SF5–SF7

def ordinal_parse(spark, sf):
    """SF5/SF6/SF7: ordinal and district labels → district number."""
    (customer,) = tables(spark, sf, "customer")
    k = F.col("c_custkey")
    n = (k % 20 + 1).cast("string")
    raw = (F.when(k % 5 == 0, F.concat(n, F.when(n == "1", F.lit("er")).otherwise(F.lit("ème"))))
           .when(k % 5 == 1, F.concat(F.lit("PARIS "), n, F.lit("E ARRDT")))
           .when(k % 5 == 2, F.concat(F.lit("Paris "), n, F.when(n == "1", F.lit("er")).otherwise(F.lit("e")),
                                      F.lit(" Arrondissement")))
           .when(k % 5 == 3, F.concat(n, F.lit("e")))
           .otherwise(F.lit("TOTAL")))
    c = customer.select("c_custkey", raw.alias("raw"))
    return c.select("c_custkey", "raw", C.ordinal("raw").alias("ordinal"),
                    C.first_number("raw").alias("first_number"))


register("ordinal_parse", f"""
with c as (select c_custkey, case c_custkey % 5
  when 0 then cast(c_custkey % 20 + 1 as varchar) || case when c_custkey % 20 + 1 = 1 then 'er' else 'ème' end
  when 1 then 'PARIS ' || cast(c_custkey % 20 + 1 as varchar) || 'E ARRDT'
  when 2 then 'Paris ' || cast(c_custkey % 20 + 1 as varchar) || case when c_custkey % 20 + 1 = 1 then 'er' else 'e' end || ' Arrondissement'
  when 3 then cast(c_custkey % 20 + 1 as varchar) || 'e'
  else 'TOTAL' end as raw from customer)
select c_custkey, raw, cast({_int_sql("trim(string_split_regex(raw, '[èer]')[1])")} as integer) as ordinal,
       cast(nullif(regexp_extract(raw, '(?i)\\b(\\d+)(er|e|ème)?\\b', 1), '') as integer) as first_number
from c
""")(ordinal_parse)


# ------------------------------------------------------------------ SF8

def code_to_district(spark, sf):
    """SF8: postal (with 75116 and a float-typed ``.0`` suffix), INSEE, zone
    codes → district, sane and quirk variants."""
    (customer,) = tables(spark, sf, "customer")
    k = F.col("c_custkey")
    n = k % 20 + 1
    postal = F.when(k % 10 == 0, F.lit("75116")).otherwise(
        F.concat(F.lit("750"), F.lpad(n.cast("string"), 2, "0")))
    postal = F.when(k % 7 == 0, F.concat(postal, F.lit(".0"))).otherwise(postal)
    insee = F.concat(F.lit("751"), F.lpad(n.cast("string"), 2, "0"))
    zone = F.concat(insee, F.lpad((k % 10000).cast("string"), 4, "0"))
    c = customer.select("c_custkey", postal.alias("postal"), insee.alias("insee"), zone.alias("zone_code"))
    return c.select("c_custkey", "postal", "insee", "zone_code",
                    C.code_to_district("postal", "postal").alias("d_postal"),
                    C.code_to_district("postal", "postal", keep_116=True).alias("d_postal_quirk"),
                    C.code_to_district("insee", "insee").alias("d_insee"),
                    C.code_to_district("zone_code", "zone").alias("d_zone"),
                    C.code_to_district("insee", "last2").alias("d_last2"))


def _code_sql(s: str) -> str:
    return _int_sql(f"regexp_replace(trim({s}), '\\.0$', '')")


register("code_to_district", f"""
with c0 as (select c_custkey, c_custkey % 20 + 1 as n,
  case when c_custkey % 10 = 0 then '75116' else '750' || lpad(cast(c_custkey % 20 + 1 as varchar), 2, '0') end as p0
  from customer),
c as (select c_custkey, case when c_custkey % 7 = 0 then p0 || '.0' else p0 end as postal,
  '751' || lpad(cast(n as varchar), 2, '0') as insee,
  '751' || lpad(cast(n as varchar), 2, '0') || lpad(cast(c_custkey % 10000 as varchar), 4, '0') as zone_code from c0)
select c_custkey, postal, insee, zone_code,
  cast(case when {_code_sql('postal')} - 75000 = 116 then 16 else {_code_sql('postal')} - 75000 end as integer) as d_postal,
  cast({_code_sql('postal')} - 75000 as integer) as d_postal_quirk,
  cast({_code_sql('insee')} - 75100 as integer) as d_insee,
  cast({_int_sql("substr(regexp_replace(trim(zone_code), '\\.0$', ''), 4, 2)")} as integer) as d_zone,
  cast({_code_sql('insee')} % 100 as integer) as d_last2
from c
""")(code_to_district)


# -------------------------------------------------------------- SF11 / SF12

def operator_normalise(spark, sf):
    """SF11 (ordered substring rules, else Python-style Title Case) and SF12
    (lower/trim + lookup) on operator labels."""
    (customer,) = tables(spark, sf, "customer")
    k = F.col("c_custkey")
    seg = F.lower(F.col("c_mktsegment"))
    raw = (F.when(k % 7 == 0, F.lit(" Bouygues Telecom "))
           .when(k % 7 == 1, F.lit("FREE MOBILE"))
           .when(k % 7 == 2, F.lit("orange France"))
           .when(k % 7 == 3, F.lit("SFR "))
           .when(k % 7 == 4, F.concat(F.lit("la-poste "), seg))
           .when(k % 7 == 5, F.concat(seg, F.lit(" telecom")))
           .otherwise(F.lit(None).cast("string")))
    c = customer.select("c_custkey", raw.alias("raw"))
    return c.select("c_custkey", "raw", C.canonical("raw").alias("operateur"),
                    C.map_values("raw", C.ANTENNA_OPERATORS, normalise=True).alias("operateur_antenne"))


def _title_sql(s: str) -> str:
    low = f"lower({s})"
    return (f"(case when {s} is null then null else array_to_string(list_transform(range(1, length({s}) + 1), "
            f"lambda i: case when i = 1 or not regexp_matches(substr({low}, i - 1, 1), '^\\p{{L}}$') "
            f"then upper(substr({low}, i, 1)) else substr({low}, i, 1) end), '') end)")


def _canon_sql(raw: str) -> str:
    t = f"trim({raw})"
    low = f"lower({t})"
    rules = "".join(f"when contains({low}, '{n}') then '{v}' " for n, v in C.OPERATOR_SUBSTRINGS)
    return f"(case {rules}else {_title_sql(t)} end)"


def _map_sql(raw: str, mapping: dict) -> str:
    key = f"lower(trim({raw}))"
    whens = "".join(f"when {key} = '{k}' then '{v}' " for k, v in mapping.items())
    return f"(case {whens}end)"


register("operator_normalise", f"""
with c as (select c_custkey, case c_custkey % 7 when 0 then ' Bouygues Telecom ' when 1 then 'FREE MOBILE'
  when 2 then 'orange France' when 3 then 'SFR ' when 4 then 'la-poste ' || lower(c_mktsegment)
  when 5 then lower(c_mktsegment) || ' telecom' else null end as raw from customer)
select c_custkey, raw, {_canon_sql('raw')} as operateur, {_map_sql('raw', C.ANTENNA_OPERATORS)} as operateur_antenne
from c
""")(operator_normalise)


# ---------------------------------------------------------------- SNK11

def sanitize_nulls(spark, sf):
    """SNK11: NaN / ±Inf → NULL on every double column of a frame."""
    (customer,) = tables(spark, sf, "customer")
    k = F.col("c_custkey")
    v = (F.when(k % 5 == 0, F.lit(float("nan"))).when(k % 5 == 1, F.lit(float("inf")))
         .when(k % 5 == 2, F.lit(float("-inf"))).otherwise(F.col("c_acctbal")))
    c = customer.select("c_custkey", v.alias("score"), F.col("c_acctbal").alias("balance"),
                        F.col("c_mktsegment"))
    return C.sanitize(c)


register("sanitize_nulls", """
with c as (select c_custkey, case c_custkey % 5 when 0 then 'NaN'::double when 1 then 'inf'::double
  when 2 then '-inf'::double else c_acctbal end as score, c_acctbal as balance, c_mktsegment from customer)
select c_custkey, case when isnan(score) or isinf(score) then null else score end as score,
       case when isnan(balance) or isinf(balance) then null else balance end as balance, c_mktsegment
from c
""")(sanitize_nulls)


# ---------------------------------------------------------------- FLT12

def median_impute_sentinel(spark, sf):
    """FLT12: sentinel 9999 (unknown) → NULL → exact column median."""
    (part,) = tables(spark, sf, "part")
    p = part.select("p_partkey", F.when(F.col("p_size") > 45, F.lit(9999))
                    .otherwise(F.col("p_size")).alias("annee"))
    return A.impute_median(p, "annee", sentinel=9999)


register("median_impute_sentinel", """
with p as (select p_partkey, case when p_size > 45 then 9999 else p_size end as annee from part),
q as (select p_partkey, nullif(annee, 9999) as annee from p)
select p_partkey, coalesce(cast(annee as double), (select median(annee) from q)) as annee from q
""")(median_impute_sentinel)


# ---------------------------------------------------------------- JN16

PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


def lookup_passthrough(spark, sf):
    """JN16: literal lookup map, unmapped → NULL or passed through."""
    (orders,) = tables(spark, sf, "orders")
    return orders.select("o_orderkey", "o_orderpriority",
                         C.map_values("o_orderpriority", PRIORITY_LABELS).alias("label"),
                         C.map_values("o_orderpriority", PRIORITY_LABELS, passthrough=True)
                         .alias("label_or_raw"))


_pl = "".join(f"when o_orderpriority = '{k}' then '{v}' " for k, v in PRIORITY_LABELS.items())
register("lookup_passthrough", f"""
select o_orderkey, o_orderpriority, case {_pl}end as label,
       coalesce(case {_pl}end, o_orderpriority) as label_or_raw from orders
""")(lookup_passthrough)


# ---------------------------------------------------------------- SF24

def age_band_sums(spark, sf):
    """SF24: band columns summed row-wise per district — the 3–10 sum treats
    a missing band as 0, the 11–17 sum propagates NULL.  The bands are
    conditional sums that are NULL when no row qualifies."""
    customer, nation = tables(spark, sf, "customer", "nation")
    cz = customer.join(nation.select(F.col("n_nationkey").alias("c_nationkey"),
                                     F.col("n_regionkey").alias("district")), "c_nationkey")
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    band = lambda cond: F.sum(F.when(cond, F.lit(1)))
    d = cz.groupBy("district").agg(
        band(seg == "AUTOMOBILE").alias("f3_5"), band(seg == "BUILDING").alias("f6_10"),
        band(seg == "FURNITURE").alias("h3_5"), band((seg == "HOUSEHOLD") & (bal > 9900)).alias("h6_10"),
        band(seg == "MACHINERY").alias("f11_17"), band(bal < -990).alias("h11_17"))
    return d.select("district", C.sum_columns(["f3_5", "f6_10", "h3_5", "h6_10"]).alias("pop_3_10"),
                    C.sum_columns(["f11_17", "h11_17"], null_as_zero=False).alias("pop_11_17"))


register("age_band_sums", """
with d as (select n.n_regionkey as district,
    sum(case when c_mktsegment = 'AUTOMOBILE' then 1 end) as f3_5, sum(case when c_mktsegment = 'BUILDING' then 1 end) as f6_10,
    sum(case when c_mktsegment = 'FURNITURE' then 1 end) as h3_5,
    sum(case when c_mktsegment = 'HOUSEHOLD' and c_acctbal > 9900 then 1 end) as h6_10,
    sum(case when c_mktsegment = 'MACHINERY' then 1 end) as f11_17, sum(case when c_acctbal < -990 then 1 end) as h11_17
  from customer c join nation n on c.c_nationkey = n.n_nationkey group by 1)
select district, cast(coalesce(f3_5, 0) + coalesce(f6_10, 0) + coalesce(h3_5, 0) + coalesce(h6_10, 0) as bigint) as pop_3_10,
       cast(f11_17 + h11_17 as bigint) as pop_11_17
from d
""")(age_band_sums)
