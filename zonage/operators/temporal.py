"""Period operators: latest snapshot (FLT9), nearest-year as-of join (JN8),
nearest available year resolution (JN9), affordability with fallback (DP4).

Year sets are calendar-bounded (a few hundred distinct values at most), so
the nearest-year mapping is computed over the *distinct years* only — a
window over that tiny sorted set — and then broadcast into an equi-join.
No fact-sized cross join and no per-row loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def latest_snapshot(df: DataFrame, period: str, by: Sequence[str] = ()) -> DataFrame:
    """FLT9: keep rows of the latest period (globally, or per ``by`` group)."""
    by = list(by)
    if not by:
        return df.filter(F.col(period) == df.select(F.max(period)).scalar())
    mx = df.groupBy(*by).agg(F.max(period).alias("_max"))
    return df.join(mx, by).filter(F.col(period) == F.col("_max")).drop("_max")


def nearest_year_map(targets: DataFrame, available: DataFrame, tie: str = "earlier") -> DataFrame:
    """``(target, year)``: for every distinct target year, the nearest year in
    ``available`` (single-column frames).  ``tie`` = ``earlier`` | ``later``
    for equidistant years.  Empty ``available`` -> no rows."""
    t = targets.select(F.col(targets.columns[0]).cast("long").alias("y"),
                       F.lit(True).alias("_t"), F.lit(False).alias("_a"))
    a = available.select(F.col(available.columns[0]).cast("long").alias("y"),
                         F.lit(False).alias("_t"), F.lit(True).alias("_a"))
    u = (t.unionByName(a).filter(F.col("y").isNotNull())
          .groupBy("y").agg(F.max("_t").alias("_is_t"), F.max("_a").alias("_is_a"))
          .withColumn("_a", F.when(F.col("_is_a"), F.col("y"))))
    w = Window.orderBy("y")  # over distinct years only: calendar-bounded
    prev = F.last("_a", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    nxt = F.first("_a", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    u = (u.select(F.col("y").alias("target"), "_is_t", prev.alias("_p"), nxt.alias("_n"))
          .filter(F.col("_is_t")))
    dp = F.col("target") - F.col("_p")
    dn = F.col("_n") - F.col("target")
    if tie == "earlier":
        pick = F.when(F.col("_n").isNull() | (F.col("_p").isNotNull() & (dp <= dn)), F.col("_p")) \
                .otherwise(F.col("_n"))
    else:
        pick = F.when(F.col("_p").isNull() | (F.col("_n").isNotNull() & (dn <= dp)), F.col("_n")) \
                .otherwise(F.col("_p"))
    return u.select("target", pick.alias("year")).filter(F.col("year").isNotNull())


def nearest_year_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_year: str,
                      right_year: str, tie: str = "earlier") -> DataFrame:
    """JN8: join each left row to the right rows of the same ``on`` keys in
    the year nearest to the left year, nearest taken among *all* years
    present on the right (tie -> earlier).  Left rows whose zone has no right
    row in that year are dropped (inner semantics)."""
    m = nearest_year_map(left.select(left_year), right.select(right_year), tie)
    l2 = left.join(m, F.col(left_year).cast("long") == F.col("target")).drop("target") \
             .withColumnRenamed("year", "_ny")
    r2 = right.withColumn("_ny", F.col(right_year).cast("long"))
    return l2.join(r2, [*on, "_ny"]).drop("_ny")


def resolve_year(df: DataFrame, year: str, target: int | Column, tie: str = "later") -> DataFrame:
    """JN9: 1-row frame with the available year nearest to ``target``
    (``tie='later'`` prefers the later of two equidistant years).  No row
    when ``df`` is empty."""
    t = F.lit(target) if not isinstance(target, Column) else target
    ys = df.select(F.col(year).cast("long").alias("y")).filter(F.col("y").isNotNull()).distinct()
    d = F.abs(F.col("y") - t)
    if tie == "later":
        agg = F.max_by("y", F.struct(-d, F.col("y")))
    else:
        agg = F.min_by("y", F.struct(d, F.col("y")))
    return ys.agg(agg.alias("year")).filter(F.col("year").isNotNull())


def exact_or_nearest(left: DataFrame, right: DataFrame, on: Sequence[str], year: str) -> DataFrame:
    """DP4 join rule: the exact ``(on…, year)`` inner join; only when it is
    empty as a whole, the nearest-year join (tie -> earlier).  Expressed
    lazily: the fallback branch is gated by a scalar count of the exact
    join, so no driver round-trip decides the plan.  Both inputs are
    zone × year aggregates and are materialised once (they are read twice)."""
    left, right = materialize(left), materialize(right)
    exact = left.join(right, [*on, year])
    ly = left.withColumnRenamed(year, "_ly")
    near = nearest_year_join(ly, right, on, "_ly", year).drop(year).withColumnRenamed("_ly", year)
    n_exact = exact.select(F.count(F.lit(1))).scalar()
    return exact.unionByName(near.select(*exact.columns).filter(n_exact == 0))
