"""Normalise → weight → score → rank (WN1–WN7, DP7/DP9/DP14 building blocks).

Ranks are computed from a *histogram of distinct values* instead of a
window over all rows: ``groupBy(value).count()`` is partially aggregated
map-side, and the number of rows strictly below each value comes from
:func:`positions` — exact prefix sums computed per value bucket so that no
window partition ever holds more than one bucket of distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import round_dec
from ..session import bounded_broadcast

# Values are first cut into monotone log-scale buckets, ``floor(sign(v) * ln(1 +
# |v|) * BUCKETS_PER_E)``, and each of these by its own least and greatest value
# into as many equal parts as it has thousands of distinct values
# (``PART_VALUES``).  Any non-decreasing map of the value gives exact results;
# this one follows the data: a few or millions of values in a narrow range
# spread over window partitions of about the same size.
BUCKETS_PER_E = 256
PART_VALUES = 10_000


def value_bucket(v: Column) -> Column:
    """Monotone (non-decreasing) bucket of a numeric value."""
    d = v.cast("double")
    lg = F.signum(d) * F.log1p(F.abs(d)) * float(BUCKETS_PER_E)
    # ±Inf get the extreme finite buckets; NaN sorts above +Inf in Spark
    return (F.when(F.isnan(d), F.lit(10 ** 16))
             .when(F.abs(lg) > 1e15, (F.signum(d) * 1e15).cast("long"))
             .otherwise(F.floor(lg).cast("long")))


def positions(hist: DataFrame, value: str, count: str = "_c",
              by: Sequence[str] = ()) -> DataFrame:
    """Exact prefix counts over a histogram.

    ``hist`` has one row per distinct ``(by…, value)`` with its multiplicity
    in ``count``.  Adds ``_below`` (rows with a strictly smaller value in the
    same ``by`` group) and ``_n`` (rows in the group).

    Values are cut into monotone buckets (:func:`value_bucket`) and these into
    parts by their least and greatest value.  Part totals are prefix-summed per
    group (one row per ``PART_VALUES`` distinct values and bucket), and values
    are prefix-summed inside their own ``(group, bucket, part)`` window
    partition, so no window partition holds all values of a hot group.
    Because the map to parts is non-decreasing in the value, the result is
    exact.
    """
    by = list(by)
    h = hist.withColumn("_b", value_bucket(F.col(value)))
    d = F.col(value).cast("double")
    extent = h.groupBy(*by, "_b").agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"),
                                      F.ceil(F.count(F.lit(1)) / PART_VALUES).alias("_parts"))
    # Infinities and NaN have buckets of their own, where least and greatest are equal.
    share = (d - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    part = F.when((F.col("_hi") > F.col("_lo")) & (F.col("_parts") > 1),
                  F.least(F.floor(share * F.col("_parts")).cast("long"), F.col("_parts") - 1)).otherwise(F.lit(0).cast("long"))
    h = h.join(extent, [*by, "_b"]).select(*h.columns, part.alias("_p"))
    bt = h.groupBy(*by, "_b", "_p").agg(F.sum(count).alias("_bc"))
    wb = Window.partitionBy(*by).orderBy("_b", "_p")
    bt = (bt.withColumn("_off", F.coalesce(
              F.sum("_bc").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_n", F.sum("_bc").over(Window.partitionBy(*by)))
            .drop("_bc"))
    # Dealt by all three keys: by group and bucket alone a hot bucket would meet in one task.
    wv = Window.partitionBy(*by, "_b", "_p").orderBy(value)
    h = h.repartition(*by, "_b", "_p").withColumn("_in", F.coalesce(
        F.sum(count).over(wv.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    h = h.join(bt, [*by, "_b", "_p"])
    return (h.withColumn("_below", (F.col("_off") + F.col("_in")).cast("long"))
             .drop("_b", "_p", "_off", "_in"))


def _histogram(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return (df.filter(F.col(value).isNotNull())
              .groupBy(*by, value).agg(F.count("*").alias("_c")))


def rank_desc(df: DataFrame, value: str, out: str = "rank", by: Sequence[str] = ()) -> DataFrame:
    """WN1: competition rank, highest value first, ties share the smallest
    rank (``rank() over (order by value desc)``).  NULL values get NULL."""
    by = list(by)
    pos = positions(_histogram(df, value, by), value, "_c", by)
    pos = pos.select(*by, value,
                     (F.col("_n") - F.col("_below") - F.col("_c") + 1).cast("long").alias(out))
    return df.join(pos, [*by, value], "left")


def pct_rank_avg(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """WN2: average-tie percentile rank, ascending
    (``(below + (ties + 1) / 2) / n``).  Not ``percent_rank`` nor ``cume_dist``."""
    by = list(by)
    pos = positions(_histogram(df, value, by), value, "_c", by)
    pct = ((F.col("_below").cast("double") + (F.col("_c") + 1).cast("double") / 2.0)
           / F.col("_n").cast("double"))
    pos = pos.select(*by, value, pct.alias(out))
    return df.join(pos, [*by, value], "left")


def minmax(df: DataFrame, cols: Sequence[str] | Mapping[str, str], scale: float = 1.0,
           fill: float | None = None, constant: float | None = 0.0,
           digits: int | None = None) -> DataFrame:
    """WN3/WN4/WN5/WN7: min-max normalisation over the whole frame.

    ``cols`` maps input column -> output column (a list keeps names).
    ``fill`` replaces NULL inputs inside the normalisation (WN4); input
    columns themselves are left unchanged unless an output has their name.  When max = min
    every row (NULLs included) gets ``constant`` (WN3); ``constant=None``
    divides by 1 instead (WN7).  ``scale``/``digits`` give the ×100, round 2
    variant (WN5).  Min and max of all columns come from one aggregate,
    attached once as a scalar subquery (evaluated once, no join, no shuffle
    of ``df``).  Intended for dimension-sized frames (see
    :func:`zonage.session.materialize`).
    """
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}

    def val(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.coalesce(v, F.lit(float(fill))) if fill is not None else v

    def norm(v: Column, s: Column) -> Column:
        mn, mx = s["mn"], s["mx"]
        if constant is None:
            out = (v - mn) / F.when(mx == mn, F.lit(1.0)).otherwise(mx - mn)
        else:
            out = F.when(mx == mn, F.lit(float(constant))).otherwise((v - mn) / (mx - mn))
        out = out * float(scale) if scale != 1.0 else out
        return round_dec(out, digits) if digits is not None else out

    # All measures are one array, normalised by one expression, so that chains
    # of normalisations don't multiply the generated code.
    stats = df.select(F.array(*[F.struct(F.min(val(c)).alias("mn"), F.max(val(c)).alias("mx")) for c in mapping])
                      .alias("s")).scalar()
    src = df.withColumn("_st", stats).withColumn("_mm", F.zip_with(F.array(*[val(c) for c in mapping]), F.col("_st"), norm))
    return src.withColumns({o: F.col("_mm")[i] for i, o in enumerate(mapping.values())}).drop("_mm", "_st")


def pct_rank_many(df: DataFrame, key: str | Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """WN2 for several columns at once over a frame with a unique ``key``.

    The measures are unpivoted to ``(key, measure, value)``; a single
    histogram grouped by ``(measure, value)`` gives the positions of every
    measure, and one pivot brings them back — one join with ``df`` whatever
    the number of columns, instead of one histogram-and-join per column.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = list(cols)
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v"))
        for i, c in enumerate(names)])).alias("_mv")).select(*keys, "_mv._m", "_mv._v")
    pos = positions(_histogram(long, "_v", ["_m"]), "_v", "_c", ["_m"])
    pct = ((F.col("_below").cast("double") + (F.col("_c") + 1).cast("double") / 2.0)
           / F.col("_n").cast("double"))
    ranked = long.join(pos.select("_m", "_v", pct.alias("_p")), ["_m", "_v"], "left")
    wide = ranked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_m") == i, F.col("_p"))).alias(cols[c]) for i, c in enumerate(names)])
    return df.join(wide, keys, "left")


def weighted_score(df: DataFrame, weights: Mapping[str, float], out: str,
                   digits: int | None = None, null_as_zero: bool = False) -> DataFrame:
    """Linear composite ``Σ w·col`` (in the given order), optionally rounded."""
    expr = None
    for c, w in weights.items():
        term = F.col(c).cast("double")
        if null_as_zero:
            term = F.coalesce(term, F.lit(0.0))
        term = F.lit(float(w)) * term
        expr = term if expr is None else expr + term
    if digits is not None:
        expr = round_dec(expr, digits)
    return df.withColumn(out, expr)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """WN6: keep the first row per key under an explicit ascending order
    (``dropDuplicates`` keeps an arbitrary row).  Rows with NULL keys are
    grouped together, as pandas ``drop_duplicates`` does.

    Written as ``groupBy(keys).agg(min_by(row, (order…, row…)))``: the
    aggregate is partial, so a key holding a third of the rows is reduced in
    every task before the shuffle instead of landing in one window
    partition.  Remaining ties are broken by the other (orderable) columns,
    which makes the choice deterministic; NULLs sort first, as in
    ``ORDER BY … ASC``."""
    order_exprs = [F.col(o) if isinstance(o, str) else o for o in order]
    ties = [f.name for f in df.schema.fields if _orderable(f.dataType)]
    key = F.struct(*[e.alias(f"_o{i}") for i, e in enumerate(order_exprs)],
                   *[F.col(c).alias(f"_t{j}") for j, c in enumerate(ties)])
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, key).alias("_row")).select("_row.*")


def _orderable(kind: T.DataType) -> bool:
    """Whether Spark can compare values of a type (maps and variants it can't)."""
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return kind.typeName() not in ("map", "variant")


def densify(reference: DataFrame, facts: Sequence[DataFrame], key: str | Sequence[str],
            fill: float | int | None = 0) -> DataFrame:
    """JN10: left-join per-zone aggregates onto the zone reference so every
    zone appears; missing measures are filled with ``fill``.  The reference is
    dimension-sized and each fact frame is already aggregated to one row per
    key, so every join is key-unique."""
    keys = [key] if isinstance(key, str) else list(key)
    out = reference
    measures: list[str] = []
    for f in facts:
        out = out.join(f, keys, "left")
        measures += [c for c in f.columns if c not in keys]
    if fill is not None:
        out = out.fillna({c: fill for c in measures})
    return out
