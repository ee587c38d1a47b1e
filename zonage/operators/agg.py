"""Per-zone aggregations (AG1–AG17).

Everything here is a ``groupBy().agg()`` whose aggregate functions have a
map-side partial form (count, sum, min/max, min_by/max_by, count_if), so a
key holding a third of the rows is pre-aggregated in every task before the
shuffle.  The two holistic aggregates — median and mode — are rewritten
over a value histogram for the same reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .score import positions


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``groupby`` drops NULL keys; SQL keeps them as a group."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.filter(cond) if cond is not None else df


def argmax(df: DataFrame, keys: str | Sequence[str], by: str, value: str,
           out: str | None = None, tie: str = "smallest") -> DataFrame:
    """AG10: the ``value`` of the row with the largest ``by`` per key.
    Ties go to the alphabetically first value (``tie='smallest'``) or last."""
    keys = _keys(keys)
    if tie == "smallest":
        agg = F.min_by(value, F.struct(-F.col(by), F.col(value)))
    else:
        agg = F.max_by(value, F.struct(F.col(by), F.col(value)))
    return (df.filter(F.col(by).isNotNull())
              .groupBy(*keys).agg(agg.alias(out or value)))


def dominant(df: DataFrame, keys: str | Sequence[str], weight: str, value: str,
             out: str | None = None) -> DataFrame:
    """AG11: class of the single heaviest fragment per key (not the class with
    the largest total); ties -> the larger class value."""
    keys = _keys(keys)
    return (df.filter(F.col(weight).isNotNull())
              .groupBy(*keys)
              .agg(F.max_by(value, F.struct(F.col(weight), F.col(value))).alias(out or value)))


def mode_by(df: DataFrame, keys: str | Sequence[str], col: str,
            out: str | None = None) -> DataFrame:
    """AG12: most frequent non-NULL value per key, ties -> smallest value.

    Two partial aggregations: ``(key, value) -> count`` then
    ``min_by(value, (-count, value))`` — no per-group value list is built,
    so a hot key is split across the histogram's shuffle partitions."""
    keys = _keys(keys)
    hist = (df.filter(F.col(col).isNotNull())
              .groupBy(*keys, col).agg(F.count("*").alias("_c")))
    return hist.groupBy(*keys).agg(
        F.min_by(col, F.struct(-F.col("_c"), F.col(col))).alias(out or col))


def exact_median(df: DataFrame, keys: str | Sequence[str], value: str, out: str = "median") -> DataFrame:
    """AG7: exact median with linear interpolation (= pandas / SQL ``median``).

    One value histogram ``(key, value) -> count`` is built (partial
    aggregation: duplicates collapse map-side, a hot key is spread over the
    histogram's partitions), and the middle positions ``floor((n-1)/2)`` and
    ``ceil((n-1)/2)`` are found by exact prefix counts
    (:func:`zonage.operators.score.positions`), the same way for groups of
    every size.  NULL values are ignored; a group with only NULLs is absent
    (without keys: one row with NULL).
    """
    keys = _keys(keys)
    hist = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count("*").alias("_c")))
    return _median_by_positions(hist, keys, value, out)


def _median_by_positions(hist: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    pos = positions(hist, value, "_c", keys)
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.ceil((F.col("_n") - 1) / 2)
    start, end = F.col("_below"), F.col("_below") + F.col("_c")
    covers_lo = (start <= lo) & (lo < end)
    covers_hi = (start <= hi) & (hi < end)
    picked = pos.filter(covers_lo | covers_hi)
    v = F.col(value).cast("double")
    res = picked.groupBy(*keys).agg(
        F.max(F.when(covers_lo, v)).alias("_lo"), F.max(F.when(covers_hi, v)).alias("_hi"))
    return res.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * 0.5).alias(out))


def rate(cond: Column, scale: float = 100.0) -> Column:
    """AG14/AG8: share of rows satisfying ``cond`` × scale, in one pass."""
    return F.count_if(cond).cast("double") / F.count(F.lit(1)).cast("double") * scale


def rate_of(part: str, total: str, scale: float = 100.0) -> Column:
    """AG14 from two counts already aggregated."""
    return F.col(part).cast("double") / F.col(total).cast("double") * scale


def count_filter(cond: Column) -> Column:
    """AG5: ``COUNT(*) FILTER (WHERE cond)``."""
    return F.count_if(cond)


def sum_or_zero(c: str | Column) -> Column:
    """AG4: sum where an empty / all-NULL group gives 0 (pandas semantics)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col), F.lit(0))


def rollup(df: DataFrame, key: str, sums: Sequence[str] = (), means: Sequence[str] = (),
           modes: Sequence[str] = ()) -> DataFrame:
    """AG13: zone -> district roll-up: sums for counts, NULL-skipping means
    for scores, modes for labels.  Modes are computed by :func:`mode_by`
    (histogram) and joined on the district key."""
    aggs = [F.sum(c).alias(c) for c in sums] + [F.avg(c).alias(c) for c in means]
    out = df.groupBy(key).agg(*aggs) if aggs else df.select(key).distinct()
    for c in modes:
        out = out.join(mode_by(df, key, c), key, "left")
    return out


def value_counts(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """AG16: top-k frequency table (ties broken by value)."""
    return (df.groupBy(col).agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), F.asc_nulls_last(col)).limit(k))


def load_metrics(df: DataFrame, key: str, zone: str, measures: Mapping[str, str] | None = None
                 ) -> DataFrame:
    """SNK15/AG15/AG17: one row of load-quality metrics — rows, distinct keys,
    duplicates, rows without zone, matched share, and min/max/median/mean of
    each measure."""
    aggs = [
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        (F.count("*") - F.count_distinct(key)).alias("duplicate_rows"),
        F.count_if(F.col(zone).isNull()).alias("rows_without_zone"),
        (F.count(zone).cast("double") / F.count("*").cast("double")).alias("matched_share"),
    ]
    out = df.agg(*aggs)
    for c in (measures or {}):
        stats = df.agg(F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                       F.avg(c).alias(f"mean_{c}"))
        med = exact_median(df, [], c, f"median_{c}")
        stats = stats.withColumn(f"median_{c}", med.select(f"median_{c}").scalar())
        out = out.withColumn(f"_s_{c}", stats.select(F.struct("*")).scalar()) \
                 .select("*", f"_s_{c}.*").drop(f"_s_{c}")
    return out


def impute_median(df: DataFrame, col: str, sentinel=None, out: str | None = None) -> DataFrame:
    """FLT12: sentinel -> NULL, then NULLs <- the exact column median.  The
    median is a histogram-based global aggregate (:func:`exact_median`)
    attached as a scalar subquery: evaluated once, no join."""
    o = out or col
    x = F.col(col)
    if sentinel is not None:
        x = F.when(x != F.lit(sentinel), x)
    cleaned = df.withColumn(o, x)
    med = exact_median(cleaned, [], o, "_median").select("_median").scalar()
    return cleaned.withColumn(o, F.coalesce(F.col(o).cast("double"), med))
