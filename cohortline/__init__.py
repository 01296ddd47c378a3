"""Longitudinal cohort analytics on Spark: cohorts, feature tables, outcome
labels, crosstabs, model datasets, resampling, model sweeps and metrics.

Every operator is a function from DataFrames to a DataFrame.
"""

from cohortline.roles import Roles

__all__ = ["Roles"]
