"""Load-semantics queries: the next state of a target table after an
incremental batch.  The *target* is the state loaded by an earlier run
(orders dated before 1999) and the *batch* the new extract (orders dated
from 1998 on, re-priced), so both overlap on 1998 like successive weekly
extracts do; together they cover the whole ``orders`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import load as L
from ..operators import score as S
from ..sources.readers import POSITION, parquet_position
from . import register
from ._common import tables

_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _target_batch(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(*_COLS)
    batch = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        C.round_dec(F.col("o_totalprice") * 1.1, 2).alias("o_totalprice"))
    return target, batch


_TB_SQL = """
with tgt as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate < timestamp '1999-01-01'),
src as (select o_orderkey, o_custkey, o_orderstatus,
               cast(round(cast(o_totalprice * 1.1 as decimal(38,10)), 2) as double) as o_totalprice
        from orders where o_orderdate >= timestamp '1998-01-01')
"""


def upsert_merge(spark, sf):
    """SNK6: batch rows replace target rows with the same key."""
    target, batch = _target_batch(spark, sf)
    return L.upsert(target, batch, ["o_orderkey"], ["o_custkey"])


register("upsert_merge", _TB_SQL + """
select * from src
union all
select * from tgt where not exists (select 1 from src where src.o_orderkey = tgt.o_orderkey)
""")(upsert_merge)


def insert_ignore_merge(spark, sf):
    """SNK3: existing target rows win; the batch is the union of two
    extracts (re-priced recent orders, and finished orders re-exported at
    list price) whose overlapping keys collapse to the first extract."""
    (orders,) = tables(spark, sf, "orders")
    target, batch = _target_batch(spark, sf)
    second = orders.filter((F.col("o_orderstatus") == "F")
                           & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))) \
        .select(*_COLS)
    b = batch.withColumn("_extract", F.lit(1)).unionByName(second.withColumn("_extract", F.lit(2)))
    nxt = L.insert_ignore(target, b, ["o_orderkey"], [F.col("_extract"), F.col("o_totalprice")])
    return nxt.select(*_COLS)


register("insert_ignore_merge", _TB_SQL + """,
b as (select *, 1 as ext from src
      union all
      select o_orderkey, o_custkey, o_orderstatus, o_totalprice, 2 as ext from orders
      where o_orderstatus = 'F' and o_orderdate >= timestamp '1997-01-01'),
d as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from (
        select *, row_number() over (partition by o_orderkey order by ext, o_totalprice) as rn from b) where rn = 1)
select * from tgt
union all
select * from d where not exists (select 1 from tgt where tgt.o_orderkey = d.o_orderkey)
""")(insert_ignore_merge)


def antijoin_append(spark, sf):
    """SNK4: only batch rows whose key is new to the target."""
    target, batch = _target_batch(spark, sf)
    return L.new_rows(target, batch, ["o_orderkey"])


register("antijoin_append", _TB_SQL + """
select * from src where not exists (select 1 from tgt where tgt.o_orderkey = src.o_orderkey)
""")(antijoin_append)


def antijoin_append_composite(spark, sf):
    """SNK5: composite key (customer, year) — new (customer, year) pairs of
    the batch, NULL-safe on every key part."""
    (orders,) = tables(spark, sf, "orders")
    o = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("annee"),
                      "o_orderstatus")
    target = o.filter(F.col("annee") < 1999)
    batch = o.filter(F.col("annee") >= 1998)
    return L.new_rows(target, batch, ["o_custkey", "annee"], null_safe=True)


register("antijoin_append_composite", """
with o as (select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as annee, o_orderstatus from orders),
t as (select * from o where annee < 1999), b as (select * from o where annee >= 1998)
select * from b where not exists (
  select 1 from t where t.o_custkey is not distinct from b.o_custkey and t.annee is not distinct from b.annee)
""")(antijoin_append_composite)


def insert_if_empty(spark, sf):
    """SNK2: two runs — into an empty target (the batch is loaded) and into
    a populated target (nothing changes)."""
    (orders,) = tables(spark, sf, "orders")
    target, batch = _target_batch(spark, sf)
    empty = orders.filter(F.col("o_orderstatus") == "none").select(*_COLS)
    first = L.insert_if_empty(empty, batch).withColumn("run", F.lit("empty_target"))
    second = L.insert_if_empty(target, batch).withColumn("run", F.lit("populated_target"))
    return first.unionByName(second)


register("insert_if_empty", _TB_SQL + """,
e as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderstatus = 'none')
select *, 'empty_target' as run from e
union all select *, 'empty_target' as run from src where (select count(*) from e) = 0
union all select *, 'populated_target' as run from tgt
union all select *, 'populated_target' as run from src where (select count(*) from tgt) = 0
""")(insert_if_empty)


LINEITEM_CONTRACT = L.Contract(
    columns={"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
             "l_extendedprice": "decimal(7,2)", "l_discount": "decimal(3,2)",
             "l_returnflag": "string"},
    primary_key=["l_orderkey", "l_linenumber"],
    unique=[["l_orderkey", "l_partkey", "l_suppkey"]],
    not_null=["l_quantity", "l_returnflag"],
    ranges={"l_quantity": (1, 50), "l_discount": (0.0, 0.08), "l_tax": (0.0, 0.05)},
)


def contract_violations(spark, sf):
    """SNK12: contract checks over the whole lineitem table."""
    (lineitem,) = tables(spark, sf, "lineitem")
    return L.violations(lineitem, LINEITEM_CONTRACT)


register("contract_violations", """
select 'not_null' as rule, 'l_orderkey' as "column", count(*) filter (where l_orderkey is null) as n from lineitem
union all select 'not_null', 'l_linenumber', count(*) filter (where l_linenumber is null) from lineitem
union all select 'not_null', 'l_quantity', count(*) filter (where l_quantity is null) from lineitem
union all select 'not_null', 'l_returnflag', count(*) filter (where l_returnflag is null) from lineitem
union all select 'range', 'l_quantity', count(*) filter (where l_quantity < 1 or l_quantity > 50) from lineitem
union all select 'range', 'l_discount', count(*) filter (where l_discount < 0.0 or l_discount > 0.08) from lineitem
union all select 'range', 'l_tax', count(*) filter (where l_tax < 0.0 or l_tax > 0.05) from lineitem
union all select 'type', 'l_orderkey', count(*) filter (where l_orderkey is not null and try_cast(l_orderkey as bigint) is null) from lineitem
union all select 'type', 'l_linenumber', count(*) filter (where l_linenumber is not null and try_cast(l_linenumber as integer) is null) from lineitem
union all select 'type', 'l_quantity', count(*) filter (where l_quantity is not null and try_cast(l_quantity as double) is null) from lineitem
union all select 'type', 'l_extendedprice', count(*) filter (where l_extendedprice is not null and try_cast(l_extendedprice as decimal(7,2)) is null) from lineitem
union all select 'type', 'l_discount', count(*) filter (where l_discount is not null and try_cast(l_discount as decimal(3,2)) is null) from lineitem
union all select 'type', 'l_returnflag', count(*) filter (where l_returnflag is not null and try_cast(l_returnflag as varchar) is null) from lineitem
union all select 'primary_key', 'l_orderkey,l_linenumber', cast(coalesce(sum(k - 1), 0) as bigint) from (
  select count(*) as k from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'unique', 'l_orderkey,l_partkey,l_suppkey', cast(coalesce(sum(k - 1), 0) as bigint) from (
  select count(*) as k from lineitem group by l_orderkey, l_partkey, l_suppkey having count(*) > 1)
""")(contract_violations)


def keep_first_dedupe(spark, sf):
    """WN6: first line per order under an explicit total order (earliest
    ship date, then line number, then supplier: the table has repeated line
    numbers) — deterministic unlike ``dropDuplicates``."""
    (lineitem,) = tables(spark, sf, "lineitem")
    li = lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey")
    return S.keep_first(li, ["l_orderkey"], [F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_suppkey")])


register("keep_first_dedupe", """
select l_orderkey, l_linenumber, l_shipdate, l_suppkey from (
  select l_orderkey, l_linenumber, l_shipdate, l_suppkey,
         row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber, l_suppkey) as rn from lineitem)
where rn = 1
""")(keep_first_dedupe)


def row_id_md5(spark, sf):
    """SF9: deterministic md5 row id over ten pipe-joined columns (NULL → '')."""
    (orders,) = tables(spark, sf, "orders")
    cols = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
            F.col("o_totalprice").cast("decimal(18,2)"), F.to_date("o_orderdate"),
            F.col("o_orderpriority"), F.lit(None).cast("string"), F.year("o_orderdate"),
            F.month("o_orderdate"), F.lit("ventes")]
    return orders.select("o_orderkey", C.row_id(*cols).alias("id_mutation"))


register("row_id_md5", """
select o_orderkey, md5(concat_ws('|', coalesce(cast(o_orderkey as varchar), ''), coalesce(cast(o_custkey as varchar), ''),
  coalesce(o_orderstatus, ''), coalesce(cast(cast(o_totalprice as decimal(18,2)) as varchar), ''),
  coalesce(cast(cast(o_orderdate as date) as varchar), ''), coalesce(o_orderpriority, ''), '',
  coalesce(cast(year(o_orderdate) as varchar), ''), coalesce(cast(month(o_orderdate) as varchar), ''), 'ventes')) as id_mutation
from orders
""")(row_id_md5)


# ---------------------------------------------------------- SNK12 / SNK13

def conform_contract(spark, sf):
    """SNK13: rows projected and cast to a contract's columns in its order; what
    doesn't fit NUMERIC(5,2) or the text's declared length becomes NULL."""
    (customer,) = tables(spark, sf, "customer")
    contract = L.Contract(columns={"c_custkey": "int", "c_mktsegment": "varchar(9)", "c_acctbal": "decimal(5,2)"})
    return L.conform(customer.select("c_acctbal", "c_mktsegment", "c_custkey", "c_name"), contract) \
        .withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


register("conform_contract", """
select cast(c_custkey as integer) as c_custkey, case when length(c_mktsegment) <= 9 then c_mktsegment end as c_mktsegment,
       cast(try_cast(c_acctbal as decimal(5,2)) as double) as c_acctbal from customer
""")(conform_contract)


def keep_first_in_file(spark, sf):
    """WN6 by the position of the scan: per part, the first line item as the file
    has them; what is kept differs from its duplicates outside the key."""
    (li,) = tables(spark, sf, "lineitem")
    rows = li.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", parquet_position().alias(POSITION))
    return S.keep_first(rows, ["l_partkey"], [POSITION]).drop(POSITION)


register("keep_first_in_file", """
select l_partkey, l_orderkey, l_linenumber, l_extendedprice
from (select *, row_number() over () as pos from lineitem)
qualify row_number() over (partition by l_partkey order by pos) = 1
""")(keep_first_in_file)


# An order table that takes one order a customer and clerk day, and no dear ones.
_ORDER_CONTRACT = L.Contract(
    columns={"o_orderkey": "bigint", "o_custkey": "int", "o_orderstatus": "varchar(1)", "o_orderpriority": "varchar(8)",
             "o_totalprice": "decimal(8,2)"},
    primary_key=["o_custkey"], unique=[["o_orderstatus", "o_totalprice"]], not_null=["o_orderstatus"],
    ranges={"o_totalprice": (2000, 300000)})


def contract_load(spark, sf):
    """SNK12: a batch divided by its contract into accepted rows and rejected
    ones with the rules that these break: types, ranges, NULLs, and repeats of
    the key and of a unique set, the first row of the file being kept."""
    (orders,) = tables(spark, sf, "orders")
    rows = orders.select(*_ORDER_CONTRACT.columns, parquet_position().alias(POSITION))
    rows = rows.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")))
    marked = rows.withColumn("_broken", L.broken(rows, _ORDER_CONTRACT))
    again = L.repeated(marked.filter(F.size("_broken") == 0), _ORDER_CONTRACT, POSITION)
    out = marked.join(again, POSITION, "left")
    rules = F.concat("_broken", F.when(F.col("rule").isNotNull(), F.array("rule")).otherwise(F.array().cast("array<string>")))
    return out.select("o_orderkey", (F.size(rules) == 0).alias("accepted"), F.array_join(F.sort_array(rules), ",").alias("rules"))


register("contract_load", """
with o as (select o_orderkey, o_custkey, case when o_orderkey % 11 <> 0 then o_orderstatus end as s, o_orderpriority as p,
                  o_totalprice as t, row_number() over () as pos from orders),
b as (select *, list_filter([
        case when o_custkey is null then 'not_null:o_custkey' end, case when s is null then 'not_null:o_orderstatus' end,
        case when t < 2000 or t > 300000 then 'range:o_totalprice' end,
        case when length(p) > 8 then 'type:o_orderpriority' end, case when length(s) > 1 then 'type:o_orderstatus' end,
        case when t >= 999999.995 then 'type:o_totalprice' end], lambda r: r is not null) as rules from o),
k as (select *, len(rules) = 0 and row_number() over (partition by len(rules) = 0, o_custkey order by pos) > 1 as again from b),
u as (select *, len(rules) = 0 and not again
        and row_number() over (partition by len(rules) = 0 and not again, s, t order by pos) > 1 as twice from k)
select o_orderkey, len(rules) = 0 and not again and not twice as accepted,
       array_to_string(list_sort(rules || case when again then ['primary_key:o_custkey'] when twice then ['unique:o_orderstatus,o_totalprice']
                                               else [] end), ',') as rules
from u
""")(contract_load)
