"""Ratios, shares and growth rates with their guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true; 0 rather than NULL for none."""
    return F.count(F.when(cond, F.lit(1)))


def ratio(x: Column, y: Column) -> Column:
    """``x / y`` as a double, NULL where ``y`` is 0 or NULL."""
    return x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0))


def pct(x: Column, y: Column) -> Column:
    return ratio(x * F.lit(100.0), y)


def pct_change(new: Column, old: Column) -> Column:
    return ratio((new.cast("double") - old.cast("double")) * 100.0, old)


def cagr_pct(first: Column, last: Column, years: Column | int) -> Column:
    """Compound growth per year, in percent."""
    n = F.lit(years) if isinstance(years, int) else years
    return (F.pow(ratio(last, first), F.lit(1.0) / n) - 1) * 100


def share_if(cond: Column, scale: float = 100.0) -> Column:
    """Mean of a condition over the group; NULL conditions count as false."""
    return F.avg(F.when(cond, F.lit(scale)).otherwise(F.lit(0.0)))
