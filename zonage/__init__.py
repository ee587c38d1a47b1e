"""zonage — zonal indicators as Spark DataFrame operators.

Facts are attached to zones (spatial joins written as equi-joins on a grid
index plus JVM-side geometry predicates), aggregated per zone and year,
normalised, weighted, ranked, gap-filled and loaded idempotently.  Every
operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions so Catalyst can prune, push down and plan the shuffles.
"""

__version__ = "0.1.0"
