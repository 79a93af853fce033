"""Statistics as aggregate column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skewness(x: Column) -> Column:
    """Skewness with the small-sample correction; null below three values."""
    n = F.count(x).cast("double")
    spread = F.stddev_pop(x)
    factor = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    return F.when(n > 2, F.when(spread == 0, F.lit(0.0)).otherwise(F.skewness(x) * factor))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are present; null for a constant side."""
    both_x = F.when(y.isNotNull(), x)
    both_y = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(both_x) * F.stddev_pop(both_y))


def share(condition: Column) -> Column:
    """Fraction of rows for which the condition holds."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))
