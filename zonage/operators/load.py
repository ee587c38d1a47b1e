"""Idempotent load semantics and table contracts (SNK1–SNK15).

The load rules are functions from a target and a batch to the target's next
state.  A stored table is a folder of Parquet, dealt over partitions by a hash of
its keys (``buckets`` of them) or by one of its columns, and written with Spark's
own writes only:

* append, insert-if-empty, insert-ignore, anti-join append (SNK1–SNK5) append the
  new rows; of what the table had only the keys are read;
* upsert (SNK6) takes the rows that differ from the stored ones, writes the next
  state of the partitions that these touch to a table of its own, and overwrites
  just these partitions (dynamic partition overwrite); a batch without news
  writes nothing, and an interrupted one is repaired by running it again;
* drop-and-reload (SNK7, SNK8) overwrites the folder.

:func:`load` checks a batch against the table's contract on the way: rows that
break it go to a table of rejected rows, with the rules they break.  The joins are
shuffle joins on the key (or broadcast by AQE's runtime statistics); none collects
a side.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .joins import anti_join
from .score import keep_first


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """SNK1: next state = target ∪ source."""
    return target.unionByName(source.select(*target.columns))


def insert_if_empty(target: DataFrame, source: DataFrame) -> DataFrame:
    """SNK2: load ``source`` only when ``target`` has no row; otherwise the
    target is unchanged.  The emptiness test is a scalar subquery."""
    n = target.select(F.count(F.lit(1))).scalar()
    return target.unionByName(source.select(*target.columns).filter(n == 0))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str],
             null_safe: bool = False) -> DataFrame:
    """SNK4/SNK5: rows of ``source`` whose key is not in ``target``.
    ``null_safe`` matches NULL key parts (pandas ``merge`` semantics)."""
    return anti_join(source, target, keys, null_safe=null_safe)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[Column | str]) -> DataFrame:
    """SNK3: ``INSERT … ON CONFLICT DO NOTHING``: existing rows win, in-batch
    duplicates collapse to the first row under ``order``."""
    batch = keep_first(source, keys, order)
    return target.unionByName(new_rows(target, batch, keys).select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[Column | str]) -> DataFrame:
    """SNK6: ``INSERT … ON CONFLICT DO UPDATE``: new rows replace old ones per
    key.  Duplicate keys inside the batch keep the first row under ``order``
    (PostgreSQL would reject such a batch)."""
    src = keep_first(source, keys, order)
    kept = anti_join(target, src, keys, null_safe=False)
    return src.select(*target.columns).unionByName(kept)


# --------------------------------------------------------------------------
# stored tables
# --------------------------------------------------------------------------

BUCKETS = 16
BUCKET, BATCH = "_bucket", "_batch"   # partition columns that are no columns of the table


@dataclass(frozen=True)
class Layout:
    """How a stored table is dealt over partitions: by the column ``by``, or by a
    hash of ``keys`` over ``buckets`` (a fixed number for a table, as many as
    partitions of handy size come to), or not at all."""
    keys: Sequence[str] = ()
    buckets: int = BUCKETS
    by: str | None = None

    @property
    def column(self) -> str | None:
        return self.by or (f"{BUCKET}{self.buckets}" if self.keys else None)

    def deal(self, df: DataFrame) -> DataFrame:
        """``df`` with the partition column, its rows of a partition together
        (AQE splits partitions that are too large)."""
        if self.column is None:
            return df
        if not self.by:
            hashed = F.xxhash64(*[F.col(k).cast("string") for k in self.keys])
            df = df.withColumn(self.column, F.pmod(hashed, F.lit(self.buckets)).cast("int"))
        return df.hint("rebalance", F.col(self.column))


def _folder(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.parquet(base)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or no row ever
            return None
        raise


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The table's current rows; ``None`` if it has never had one."""
    df = _folder(spark, base)
    return None if df is None else df.drop(*[c for c in df.columns if c.startswith((BUCKET, BATCH))])


def _fitted(df: DataFrame, current: DataFrame | None) -> DataFrame:
    """``df`` with the columns and types of the stored table."""
    if current is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in current.schema.fields])


def _put(df: DataFrame, base: str, column: str | None, mode: str = "append") -> int:
    """Write rows into their partitions; how many."""
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if column is not None:
        w = w.partitionBy(column)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(base)
    return seen.get["n"]


def append_rows(df: DataFrame, base: str, layout: Layout = Layout()) -> int:
    """SNK1 on a stored table: add the rows of ``df``; no other file changes."""
    df = _fitted(df, read_current(df.sparkSession, base))
    return _put(layout.deal(df), base, layout.column)


def append_batch(df: DataFrame, base: str, batch: str) -> int:
    """Add the rows of a numbered batch as a partition of their own, in the place
    of what an earlier, interrupted try of the same batch has left there."""
    df = _fitted(df, read_current(df.sparkSession, base))
    return _put(df.withColumn(BATCH, F.lit(batch)), base, BATCH, "overwrite")


def upsert_rows(df: DataFrame, base: str, layout: Layout, order: Sequence[Column | str], stamp: str | None = None) -> int:
    """SNK6 on a stored table: how many rows are new or changed (the column
    ``stamp`` aside).  Only the partitions that hold them are written."""
    spark, keys = df.sparkSession, list(layout.keys)
    current = read_current(spark, base)
    batch = keep_first(_fitted(df, current), keys, order)
    if current is None:
        return _put(layout.deal(batch), base, layout.column)
    stored = _folder(spark, base)
    batch = materialize(layout.deal(batch))
    same = [c for c in current.columns if c != stamp]
    news = materialize(anti_join(batch, stored.filter(_touched(batch, layout.column)), same, null_safe=True))
    if news.isEmpty():
        return 0
    here = _touched(news, layout.column)
    kept = anti_join(stored.filter(here), news, keys, null_safe=False)
    state = materialize(news.unionByName(kept.select(*news.columns)))
    _put(state.hint("rebalance", F.col(layout.column)), base, layout.column, "overwrite")
    return news.count()


def _touched(rows: DataFrame, column: str) -> Column:
    """Whether a stored row is in a partition that ``rows`` have rows of (the
    partitions' values, not the rows, go to the driver)."""
    values = [r[0] for r in rows.select(column).distinct().collect()]
    here = F.col(column).isin([v for v in values if v is not None])
    return here | F.col(column).isNull() if None in values else here


def replace(df: DataFrame, base: str, layout: Layout = Layout()) -> int:
    """SNK7/SNK8: drop-and-reload."""
    seen = Observation()
    w = layout.deal(df).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    (w.partitionBy(layout.column) if layout.column else w).parquet(base)
    return seen.get["n"]


def compact(spark: SparkSession, base: str, layout: Layout = Layout()) -> None:
    """Rewrite a table of many appended files with few files a partition."""
    df = read_current(spark, base)
    if df is not None:
        replace(materialize(df), base, layout)


def audit(df: DataFrame, col: str = "created_at") -> DataFrame:
    """SNK14: load timestamp column (excluded from result comparisons)."""
    return df.withColumn(col, F.current_timestamp())


# --------------------------------------------------------------------------
# table contracts (SNK12, SNK13)
# --------------------------------------------------------------------------

@dataclass
class Contract:
    """Declared table shape: ordered columns with Spark SQL types, key,
    unique sets, NOT NULL columns, value ranges and defaults (of NOT NULL columns)."""
    columns: Mapping[str, str]
    primary_key: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    not_null: Sequence[str] = ()
    ranges: Mapping[str, tuple] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """SNK13: project and cast to the contract's columns, in order; values that
    do not fit become NULL and are reported by :func:`violations`."""
    return df.select(*[fitting(c, t).alias(c) for c, t in contract.columns.items()])


def fitting(c: str, kind: str) -> Column:
    """A column cast to a declared type, NULL where it doesn't fit; a text of
    ``varchar(n)`` fits up to ``n`` characters."""
    if m := re.fullmatch(r"varchar\((\d+)\)", kind.strip(), re.IGNORECASE):
        text = F.col(c).cast("string")
        return F.when(F.length(text) <= int(m[1]), text)
    return F.col(c).try_cast(kind)


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """SNK12: ``(rule, column, n)`` counts of contract violations — duplicate
    keys, NULLs in key/NOT NULL columns, out-of-range values and values that
    do not fit the declared type.  Duplicate checks are grouped aggregations
    (partial, shuffle on the key); the per-row checks are one pass."""
    checks: list[Column] = []
    names: list[tuple[str, str]] = []
    for c in list(dict.fromkeys([*contract.primary_key, *contract.not_null])):
        checks.append(F.count_if(F.col(c).isNull()))
        names.append(("not_null", c))
    for c, (lo, hi) in contract.ranges.items():
        cond = None
        if lo is not None:
            cond = F.col(c) < F.lit(lo)
        if hi is not None:
            cond = (F.col(c) > F.lit(hi)) if cond is None else cond | (F.col(c) > F.lit(hi))
        checks.append(F.count_if(cond))
        names.append(("range", c))
    for c, t in contract.columns.items():
        if c in df.columns:
            checks.append(F.count_if(F.col(c).isNotNull() & fitting(c, t).isNull()))
            names.append(("type", c))
    row = df.agg(*[x.alias(f"_v{i}") for i, x in enumerate(checks)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"_v{i}").cast("long").alias("n"))
        for i, (r, c) in enumerate(names)]))
    out = row.select(stack.alias("v")).select("v.*")
    for keyset, rule in [(contract.primary_key, "primary_key")] + \
            [(u, "unique") for u in contract.unique]:
        if not keyset:
            continue
        dup = (df.groupBy(*keyset).agg(F.count("*").alias("_k"))
                 .filter(F.col("_k") > 1)
                 .agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("long").alias("n")))
        out = out.unionByName(dup.select(F.lit(rule).alias("rule"),
                                         F.lit(",".join(keyset)).alias("column"), "n"))
    return out


def broken(df: DataFrame, contract: Contract) -> Column:
    """The rules that a row breaks by itself, as an array of ``rule:column``:
    NULL in a key or NOT NULL column (a column that ``df`` lacks is NULL), a value
    out of its range, a value that doesn't fit the declared type."""
    found = []
    for c in dict.fromkeys([*contract.primary_key, *contract.not_null, *contract.defaults]):
        if c not in df.columns and c in contract.defaults:
            continue
        found.append(F.when(F.col(c).isNull() if c in df.columns else F.lit(True), F.lit(f"not_null:{c}")))
    for c, (lo, hi) in contract.ranges.items():
        outside = F.lit(False)
        if lo is not None:
            outside = outside | (F.col(c) < F.lit(lo))
        if hi is not None:
            outside = outside | (F.col(c) > F.lit(hi))
        found.append(F.when(outside, F.lit(f"range:{c}")))
    for c, t in contract.columns.items():
        if c in df.columns:
            found.append(F.when(F.col(c).isNotNull() & fitting(c, t).isNull(), F.lit(f"type:{c}")))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def repeated(rows: DataFrame, contract: Contract, row: str, target: DataFrame | None = None,
             keys: Sequence[str] = ()) -> DataFrame:
    """``(row, rule)`` of rows that repeat the primary key or a unique set: of
    rows that agree on it (NULLs never do), all but the first by the column
    ``row``, and all if ``target`` has it.  The sets are gone through in order, and
    a row that one set rules out doesn't count for the next.  Sets that hold all
    of ``keys`` aren't looked up in the target: the rows' keys are new to it."""
    found, left = None, rows
    for rule, cols in [("primary_key", list(contract.primary_key)), *(("unique", list(u)) for u in contract.unique)]:
        if not cols or any(c not in rows.columns for c in cols):
            continue
        known = left.select(row, *cols).dropna(subset=cols)
        first = known.groupBy(*cols).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        bad = known.join(first, cols).filter(F.col(row) > F.col("_first")).select(row)
        if target is not None and not (keys and set(keys) <= set(cols)):
            bad = bad.unionByName(known.join(target.select(*cols), cols, "left_semi").select(row)).distinct()
        left = left.join(bad, row, "left_anti")
        named = bad.select(row, F.lit(f"{rule}:{','.join(cols)}").alias("rule"))
        found = named if found is None else found.unionByName(named)
    return found if found is not None else rows.select(row, F.lit(None).cast("string").alias("rule")).filter("false")


@dataclass
class Loaded:
    """What a load did: the table's rows now, and its measures."""
    table: DataFrame
    metrics: dict

    def _read(self, base: str) -> Loaded:
        current = read_current(self.table.sparkSession, base)
        return self if current is None else Loaded(current, self.metrics)


def load(df: DataFrame, base: str, rule: str, keys: Sequence[str], contract: Contract | None = None,
         layout: Layout | None = None, rejected: str | None = None, stamp: str = "created_at") -> Loaded:
    """Load a batch into the stored table ``base`` by its rule, with its contract.

    The batch is computed once and written to the side with the rules each row
    breaks; its measures (rows, broken rows, NULLs a column) are observed during
    that write.  Rows that break a rule, or repeat a key or unique set of the batch
    or table, are appended to the folder ``rejected`` as JSON text with the rules
    and the load time; the others are loaded with the load time in ``stamp``.
    """
    spark, keys = df.sparkSession, list(keys)
    layout = layout or Layout(keys)
    if rule == "replace":
        return Loaded(df, {"loaded": replace(df, base, layout)})._read(base)
    if contract is not None:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                             for c, v in contract.defaults.items() if c in df.columns})
        df = df.select(*[c for c in contract.columns if c in df.columns], *[c for c in df.columns if c not in contract.columns])
    contract = contract or Contract(columns={})
    columns = df.columns
    seen = Observation()
    marked = df.withColumn("_broken", broken(df, contract)).withColumn("_row", F.monotonically_increasing_id())
    staged = materialize(marked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_broken") > 0).alias("broken"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in columns]))
    metrics = dict(seen.get)
    current = read_current(spark, base)
    fine = staged.filter(F.size("_broken") == 0).drop("_broken")
    if rule in ("insert_ignore", "upsert"):
        fine = keep_first(fine, keys, ["_row"])
    if rule in ("append_new", "insert_ignore") and current is not None:
        fine = new_rows(current, fine, keys, null_safe=len(keys) > 1)
    elif rule == "insert_if_empty" and current is not None and not current.isEmpty():
        fine = fine.limit(0)
    again = materialize(repeated(fine, contract, "_row", None if rule == "upsert" else current, keys))
    metrics["repeated"] = again.count()
    if metrics["repeated"]:
        fine = fine.join(again, "_row", "left_anti")
    if rejected and metrics["broken"] + metrics["repeated"]:
        rules = staged.filter(F.size("_broken") > 0).select("_row", F.explode("_broken").alias("rule")).unionByName(again) \
                      .groupBy("_row").agg(F.sort_array(F.collect_list("rule")).alias("rules"))
        out = staged.join(rules, "_row").select("rules", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"))
        append_rows(audit(out, stamp), rejected)
    rows = audit(fine.select(*columns), stamp)
    if rule == "upsert":
        metrics["loaded"] = upsert_rows(rows, base, layout, keys, stamp)
    elif rule in ("append_new", "insert_ignore", "insert_if_empty", "append"):
        metrics["loaded"] = append_rows(rows, base, layout)
    else:
        raise ValueError(rule)
    return Loaded(rows.limit(0), metrics)._read(base)


# --------------------------------------------------------------------------
# GeoJSON exports (SNK9, SNK10)
# --------------------------------------------------------------------------

def to_features(df: DataFrame, id_col: str, geometry_json: str,
                properties: Sequence[str]) -> DataFrame:
    """SNK9: one GeoJSON Feature per row as JSON text, ``_id`` = ``id_col``.
    The geometry text is embedded verbatim (it already is GeoJSON)."""
    feat = F.concat(F.lit('{"type":"Feature","properties":'),
                    F.to_json(F.struct(*[F.col(p) for p in properties])),
                    F.lit(',"geometry":'), F.col(geometry_json), F.lit("}"))
    return df.select(F.col(id_col).cast("string").alias("_id"), feat.alias("feature"))
