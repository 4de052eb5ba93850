"""Control totals, market shares, policy periods and per-capita rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cagr_pct, pct, ratio
from .series import share


def reconcile(actual: DataFrame, control: DataFrame, key: str, value: str, expected: str,
              warn_above: float = 10.0) -> DataFrame:
    """Sums against control totals; zero control totals are skipped, missing sums count as 0."""
    sums = actual.groupBy(key).agg(F.sum(value).alias("actual"))
    diff = pct(F.abs(F.col("actual") - F.col("expected")), F.col("expected"))
    return (control.select(key, F.col(expected).alias("expected")).filter(F.col("expected") != 0)
            .join(sums, key, "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
            .withColumn("diff_pct", diff)
            .withColumn("status", F.when(F.col("diff_pct") > warn_above, "warning").otherwise("passed")))


def growth_rate(df: DataFrame, year: str, value: str, first: int, last: int,
                by: Sequence[str] = ()) -> DataFrame:
    """Compound growth per year between two years."""
    ends = df.groupBy(*by).agg(F.sum(F.when(F.col(year) == first, F.col(value))).alias("first_value"),
                               F.sum(F.when(F.col(year) == last, F.col(value))).alias("last_value"))
    return ends.withColumn("cagr_pct", cagr_pct(F.col("first_value"), F.col("last_value"), last - first))


def market_share(df: DataFrame, year: Column, group: Column, value: str) -> DataFrame:
    sums = df.groupBy(year.alias("year"), group.alias("group")).agg(F.sum(value).alias("total"))
    return share(sums, "total", ["year"], "share_pct")


def before_after(df: DataFrame, period: Column, total: str, parts: Sequence[str]) -> DataFrame:
    """Means per policy period and the parts' share of all units."""
    return df.groupBy(period.alias("period")).agg(
        F.avg(total).alias(f"avg_{total}"), *[F.avg(p).alias(f"avg_{p}") for p in parts],
        *[pct(F.sum(p), F.sum(total)).alias(f"pct_{p}") for p in parts])


def per_capita(df: DataFrame, population: DataFrame, key: str, value: str, per: float = 1000.0,
               out: str = "per_1000") -> DataFrame:
    """Value per ``per`` inhabitants; ``population`` holds (key, population) in heads."""
    joined = df.join(population.select(key, "population"), key, "left")
    return joined.withColumn(out, ratio(F.col(value) * per, F.col("population")))
