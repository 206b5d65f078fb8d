"""Aggregate expressions with the null, constant-column and small-sample rules of the data model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def skew_g1(x: Column) -> Column:
    """Adjusted Fisher-Pearson skewness: null below three values, 0 for a constant column."""
    n = F.count(x).cast("double")
    adjusted = F.coalesce(F.skewness(x), F.lit(0.0)) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n >= 3, adjusted)


def safe_corr(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson correlation; null instead of an error on a constant column."""
    xm, ym = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    scale = F.stddev_pop(xm) * F.stddev_pop(ym)
    return F.when(scale > 0, F.try_divide(F.covar_pop(x, y), scale))


def count_true(cond: Column) -> Column:
    """Rows where the condition holds; null counts as no."""
    return F.count_if(F.coalesce(cond, F.lit(False)))
