"""Relational join operators (JN10–JN20)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import round_dec


def _null_safe_cond(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str],
               null_safe: bool = True) -> DataFrame:
    """JN13: full outer join on ``keys`` with the keys coalesced (USING
    semantics).  ``null_safe`` matches NULL keys with each other, as pandas
    ``merge`` does."""
    keys = list(keys)
    if not null_safe:
        return left.join(right, keys, "full")
    l2 = left.select(*[F.col(c).alias(f"_l_{c}") if c in keys else F.col(c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    j = l2.join(r2, cond, "full")
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return j.select(*[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys], *rest)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              null_safe: bool = True) -> DataFrame:
    """JN15/SO2/SNK4/SNK5: rows of ``left`` whose key tuple is absent from
    ``right``.  ``null_safe`` treats NULL = NULL (pandas index semantics)."""
    keys = list(keys)
    r = right.select(*keys).distinct()
    if not null_safe:
        return left.join(r, keys, "left_anti")
    r2 = r.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r2, cond, "left_anti")


def spread_evenly(totals: DataFrame, members: DataFrame, group: str, value: str,
                  out: str, digits: int | None = None) -> DataFrame:
    """JN20: spread each group's total evenly over its members.

    ``totals`` has ``(group, …attrs, value)``; ``members`` has
    ``(member, group)``.  Every member gets ``value / #members`` for each
    total row of its group; members of a group without any total row are
    kept with NULL attributes and 0.
    """
    k = members.groupBy(group).agg(F.count("*").alias("_k"))
    share = F.col(value).cast("double") / F.col("_k").cast("double")
    if digits is not None:
        share = round_dec(share, digits)
    j = members.join(k, group).join(totals, group, "left")
    attrs = [c for c in totals.columns if c not in (group, value)]
    member_cols = [c for c in members.columns if c != group]
    return j.select(*member_cols, group, *attrs,
                    F.when(F.col(value).isNull(), F.lit(0.0)).otherwise(share).alias(out))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
           how: str = "left") -> DataFrame:
    """JN16/JN17: attach attributes from a dimension table by key."""
    dk = dim_key or key
    if dk != key:
        dim = dim.withColumnRenamed(dk, key)
    return df.join(dim, key, how)


def first_attribute(df: DataFrame, key: str, attr: str) -> DataFrame:
    """JN18: one attribute value per key (functionally dependent; the smallest
    is taken so the result is deterministic)."""
    return df.groupBy(key).agg(F.min(attr).alias(attr))


def coalesce_pair(df: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """JN19: collapse duplicated columns from both join sides."""
    return df.withColumn(out, F.coalesce(F.col(right), F.col(left)))
