"""Spatial gap filling (DP13).

A zone without a value takes the mean of its neighbours' values (rounded to
2 decimals), repeated for a fixed number of passes; zones still empty get the
global median of the filled table, and every value is rounded to 2.

Within a pass zones are filled one after the other in the order of the file, so
that a zone filled early feeds those after it.  The result of that sequence is
computed in levels: a zone waits only for those of its missing neighbours that
come before it; all zones that wait for none are filled at once, from the values
that are there then, and the next level begins.  A zone is filled before its
missing neighbours that come after it, so it never sees their values too early.
A pass takes as many levels as the longest chain of such neighbours, one join
each, and passes that find nothing to fill are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import round_dec
from ..session import materialize


def fill_from_neighbours(values: DataFrame, neighbours: DataFrame, key: str, value: str,
                         passes: int = 3, nkey: str = "nzone", order: str | None = None) -> DataFrame:
    """``values(key, value)`` (one row per zone, NULL = missing) and
    ``neighbours(key, nkey)`` ordered pairs -> filled ``(key, value)``; ``order``
    is the column that says where a zone stands in the file (by default its key).

    The zone table is dimension-sized; each level is materialised so the plan
    does not grow with their number."""
    state = materialize(values.select(key, F.col(order or key).alias("_o"), F.col(value).cast("double").alias(value)))
    for _ in range(passes):
        empty = state.filter(F.col(value).isNull())
        near = neighbours.join(empty.select(key, "_o"), key).join(
            state.select(F.col(key).alias(nkey), F.col(value).isNull().alias("_gap"), F.col("_o").alias("_no")), nkey)
        near = materialize(near.select(key, nkey, (F.col("_gap") & (F.col("_no") < F.col("_o"))).alias("_waits")))
        if near.isEmpty():  # no gap, or none with a neighbour
            break
        state, filled = _one_pass(state, near, key, value, nkey)
        if not filled:
            break
    # the global median is over the zone table (one row per zone): bounded by
    # the zone count, so Spark's exact ``median`` aggregate is safe here
    med = state.select(F.median(value)).scalar()
    return state.select(key, round_dec(F.coalesce(F.col(value), med), 2).alias(value))


def _one_pass(state: DataFrame, near: DataFrame, key: str, value: str, nkey: str) -> tuple[DataFrame, bool]:
    """The zones after a pass, and whether it has filled any; ``near`` are the
    neighbours of the zones that were empty before it."""
    turn = state.withColumn("_left", F.col(value).isNull())  # zones whose turn hasn't come
    gaps = n = turn.filter("_left").count()
    while n:
        waiting = near.filter("_waits").join(turn.filter("_left").select(F.col(key).alias(nkey)), nkey, "left_semi") \
                      .select(key, F.lit(True).alias("_blocked")).distinct()
        means = near.join(turn.filter(F.col(value).isNotNull()).select(F.col(key).alias(nkey), F.col(value).alias("_v")), nkey) \
                    .groupBy(key).agg(F.avg("_v").alias("_mean"))
        now = F.col("_left") & F.col("_blocked").isNull()
        turn = materialize(turn.join(waiting, key, "left").join(means, key, "left").select(
            key, "_o", F.when(now, round_dec("_mean", 2)).otherwise(F.col(value)).alias(value),
            (F.col("_left") & F.col("_blocked").isNotNull()).alias("_left")))
        n = turn.filter("_left").count()
    filled = gaps > turn.filter(F.col(value).isNull()).count()
    return turn.drop("_left"), filled
