"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, sf_dir, n) for n in names]


def rd(expr: str, digits: int) -> str:
    """SQL twin of :func:`zonage.functions.clean.round_dec`."""
    return f"cast(round(cast({expr} as decimal(38,10)), {digits}) as double)"


def pct_sql(v: str, by: str = "") -> str:
    """SQL twin of :func:`zonage.operators.score.pct_rank_avg`."""
    part = f"partition by {by} " if by else ""
    part_v = f"partition by {by + ', ' if by else ''}{v}"
    return (f"((cast(rank() over ({part}order by {v}) - 1 as double) + "
            f"cast(count(*) over ({part_v}) + 1 as double) / 2.0) / "
            f"cast(count(*) over ({part.strip()}) as double))")
