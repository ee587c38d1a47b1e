"""Domain plans (DP1–DP21) on the reference's silver/gold schemas.

Each plan is a function of DataFrames returning a DataFrame; the caller
decides where inputs come from (``zonage.sources``) and how results are
loaded (``zonage.operators.load``).  :mod:`zonage.plans.runner` chains them
in dependency order.
"""
