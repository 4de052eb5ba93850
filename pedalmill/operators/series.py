"""Windows over aggregated series: shares, indexes, lags, rolling means.

Every function here expects an *aggregate* (one row per day, month, class ...).
Windows without partition keys run in one task, so they belong after the
``groupBy``, never on trips.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numeric import pct, pct_change, ratio
from .prefix import running_sum


def _over(keys: Sequence[str] | None):
    return Window.partitionBy(*(keys or []))


def share(df: DataFrame, value: str, within: Sequence[str] | None = None,
          out: str = "pct") -> DataFrame:
    """Percent of the total, or of the group total. The total is a scalar subquery, not a window over all rows."""
    total = F.sum(value).over(_over(within)) if within else df.agg(F.sum(value)).scalar()
    return df.withColumn(out, pct(F.col(value), total))


def pct_of_mean(df: DataFrame, value: str, within: Sequence[str],
                out: str = "pct_of_mean") -> DataFrame:
    return df.withColumn(out, pct(F.col(value), F.avg(value).over(_over(within))))


def pct_of_peak(df: DataFrame, value: str, within: Sequence[str],
                out: str = "pct_of_peak") -> DataFrame:
    return df.withColumn(out, pct(F.col(value), F.max(value).over(_over(within))))


def index_to_base(df: DataFrame, value: str, base: Column, within: Sequence[str] | None = None,
                  out: str = "indexed", scale: float = 100.0) -> DataFrame:
    """Value relative to the group's base row; NULL where there is none."""
    at_base = F.max(F.when(base, F.col(value))).over(_over(within))
    return df.withColumn(out, ratio(F.col(value) * scale, at_base))


def change_on_previous(df: DataFrame, value: str, order: Sequence[str],
                       within: Sequence[str] | None = None, out: str = "pct_change") -> DataFrame:
    prev = F.lag(value).over(_over(within).orderBy(*order))
    return df.withColumn(out, pct_change(F.col(value), prev))


def change_on_year(df: DataFrame, value: str, year: str, years: int = 1,
                   within: Sequence[str] | None = None, out: str = "yoy_pct") -> DataFrame:
    """Change on the row exactly ``years`` earlier; a gap gives NULL, not the row before it."""
    w = _over(within).orderBy(year).rangeBetween(-years, -years)
    return df.withColumn(out, pct_change(F.col(value), F.first(value).over(w)))


def value_years_before(df: DataFrame, value: str, year: str, years: int,
                       within: Sequence[str] | None = None, out: str = "lagged") -> DataFrame:
    w = _over(within).orderBy(year).rangeBetween(-years, -years)
    return df.withColumn(out, F.first(value).over(w))


def rolling_mean(df: DataFrame, value: str, order: Sequence[str], before: int, after: int,
                 within: Sequence[str] | None = None, out: str = "rolling") -> DataFrame:
    """Mean over ``before`` rows back to ``after`` rows ahead, NULL unless the window is full."""
    w = _over(within).orderBy(*order).rowsBetween(-before, after)
    full = F.count(value).over(w) == before + after + 1
    return df.withColumn(out, F.when(full, F.avg(value).over(w)))


def centred_mean(df: DataFrame, value: str, order: Sequence[str], rows: int = 30, **kw) -> DataFrame:
    """Centred mean; an even window takes one more row from the past."""
    return rolling_mean(df, value, order, rows // 2, rows - rows // 2 - 1, **kw)


def trailing_mean(df: DataFrame, value: str, order: Sequence[str], rows: int = 12, **kw) -> DataFrame:
    return rolling_mean(df, value, order, rows - 1, 0, **kw)


def running_share(df: DataFrame, value: str, tie: Sequence[str],
                  out: str = "cumulative_pct") -> DataFrame:
    """Cumulative percent of the total, largest first, for tables of any length (see ``prefix``)."""
    summed = running_sum(df, value, [F.desc(value), *tie], "__running")
    return summed.withColumn(out, pct(F.col("__running"), summed.agg(F.sum(value)).scalar())).drop("__running")


def items_to_reach(df: DataFrame, value: str, tie: Sequence[str], threshold: float = 80.0) -> DataFrame:
    """How many of the largest items stay within the threshold, plus one."""
    shares = running_share(df, value, tie, "__c")
    return shares.agg(
        (F.count(F.when(F.col("__c") <= threshold, 1)) + 1).alias("items"),
        F.count(F.lit(1)).alias("of_items"))


def ranked(df: DataFrame, order: Sequence[Column | str], within: Sequence[str] | None = None,
           out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(_over(within).orderBy(*order)))


def top_per_group(df: DataFrame, within: Sequence[str], order: Sequence[Column | str],
                  n: int) -> DataFrame:
    """First ``n`` rows per group. Spark prunes each task's rows to ``n`` per
    group before the shuffle, so a hot group stays small."""
    rn = "__rn"
    return (df.withColumn(rn, F.row_number().over(_over(within).orderBy(*order)))
            .filter(F.col(rn) <= n).drop(rn))


def best_per_group(df: DataFrame, within: Sequence[str], measure: str, tie: Sequence[str],
                   keep: Sequence[str]) -> DataFrame:
    """The row with the largest measure per group, as an aggregate (no sort)."""
    key = F.struct((-F.col(measure)).alias("m"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)])
    picked = F.min_by(F.struct(*keep), key).alias("__p")
    return df.groupBy(*within).agg(picked).select(*within, *[F.col(f"__p.{k}").alias(k) for k in keep])


def forward_fill(df: DataFrame, value: str, order: Sequence[str], within: Sequence[str],
                 out: str | None = None) -> DataFrame:
    w = (_over(within).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out or value, F.last(value, ignorenulls=True).over(w))


def weekday_gap(daily: DataFrame, value: str, week: str, dow: str, by: Sequence[str],
                prefix: str = "") -> DataFrame:
    """Mid-week versus Monday/Friday level, in percent points of the week's mean.

    Each working day is first put in relation to its own week, which removes
    growth; the gap is mean(Tue, Wed, Thu) - mean(Mon, Fri) of the per-day means.
    """
    work = daily.filter(F.col(dow).between(1, 5))
    rel = pct_of_mean(work, value, [week], "__rel")
    means = rel.groupBy(*by).agg(*[
        F.avg(F.when(F.col(dow) == d, F.col("__rel"))).alias(f"__d{d}") for d in range(1, 6)])
    mon_fri = (F.col("__d1") + F.col("__d5")) / 2
    mid = (F.col("__d2") + F.col("__d3") + F.col("__d4")) / 3
    return means.select(*by, mon_fri.alias(f"{prefix}mon_fri_avg"), mid.alias(f"{prefix}tue_thu_avg"),
                        (mid - mon_fri).alias(f"{prefix}gap"))


def full_grid(df: DataFrame, axes: dict[str, Sequence], values: Sequence[str],
              within: Sequence[str] = ()) -> DataFrame:
    """Every combination of the axes per group, missing cells filled with 0. A NULL group is a group."""
    spine = df.select(*within).distinct() if within else df.sparkSession.range(1).drop("id")
    for name, levels in axes.items():
        spine = spine.withColumn(name, F.explode(F.array(*[F.lit(v) for v in levels])))
    keys = [*within, *axes]
    cells = df.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in df.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return spine.join(cells, same, "left").select(*keys, *[c for c in df.columns if c not in keys]).fillna(0, subset=list(values))


def heatmap_cells(trips: DataFrame, ts: str = "started_at", default_bike: str = "classic_bike") -> DataFrame:
    """Trips by day type, year, rider, bike, hour and weekday, with every hour and weekday present.

    Trips of the eras that name no bike count for the default one.
    """
    when = F.col(ts)
    keys = {"day_type": F.when(dates.is_weekend(when), "Weekend").otherwise("Weekday"), "year": F.year(when),
            "member_casual": F.col("member_casual"), "rideable_type": F.coalesce("rideable_type", F.lit(default_bike))}
    cells = trips.groupBy(*[c.alias(n) for n, c in keys.items()], F.hour(when).alias("hour"), dates.dow(when).alias("dow")).agg(
        F.count(F.lit(1)).alias("trips"))
    return full_grid(cells, {"hour": range(24), "dow": range(7)}, ["trips"], list(keys))


def missing_dates(df: DataFrame, date: str) -> DataFrame:
    """Calendar days between the first and last date that have no row."""
    days = df.select(F.col(date).cast("date").alias(date)).distinct()
    span = days.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(date))
    return spine.join(days, date, "left_anti")


def versus_base_year(df: DataFrame, value: str, year: str, base: int,
                     within: Sequence[str], out: str = "pct_of_base") -> DataFrame:
    """Percent of the same group's value in the base year."""
    return index_to_base(df, value, F.col(year) == base, within, out)
