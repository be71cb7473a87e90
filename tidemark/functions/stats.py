"""Aggregate and error expressions that stay defined on degenerate input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAPE_FLOOR = 1e-6


def safe_corr(a: str, b: str) -> Column:
    """Pearson correlation; NULL (not an ANSI error) for a constant column."""
    den = F.stddev_samp(a) * F.stddev_samp(b)
    return F.try_divide(F.covar_samp(a, b), F.when(den != 0, den))


def nan_to_null(c: Column) -> Column:
    """Treat a floating NaN as missing, as rolling statistics do."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def signed_error(actual: Column, predicted: Column) -> Column:
    return actual - predicted


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def mae(err: str = "prediction_error") -> Column:
    return F.avg(F.abs(F.col(err)))


def rmse(err: str = "prediction_error") -> Column:
    return F.sqrt(F.avg(F.col(err) * F.col(err)))


def mape(actual: str, predicted: str) -> Column:
    """Mean absolute percentage error, denominator floored at 1e-6."""
    a, p = F.col(actual), F.col(predicted)
    return F.avg(F.abs(a - p) / F.greatest(a.cast("double"), F.lit(MAPE_FLOOR))) * 100
