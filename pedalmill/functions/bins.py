"""Bins, bands and 0/1 features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Duration buckets in seconds with their labels, in order.
DURATION_BUCKETS = [
    (300, "< 5 min"),
    (600, "5-10 min"),
    (900, "10-15 min"),
    (1200, "15-20 min"),
    (1800, "20-30 min"),
    (3600, "30-60 min"),
    (None, "60+ min"),
]

# Feels-like temperature edges (degrees F) and labels.
FEELS_LIKE_EDGES = [0, 32, 45, 55, 65, 75, 85, 100]
FEELS_LIKE_LABELS = ["<32°F", "32-45°F", "45-55°F", "55-65°F", "65-75°F", "75-85°F", "85°F+"]

# Hourly precipitation edges (mm) and labels.
PRECIP_EDGES = [-0.1, 0, 1, 3, 7, 100]
PRECIP_LABELS = ["Dry", "<1mm", "1-3mm", "3-7mm", ">7mm"]


def cut(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(lo, hi]``; values outside every bin give NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs one more edge than labels")
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((x > F.lit(lo)) & (x <= F.lit(hi)), label).otherwise(out)
    return out


def equal_width_bins(df: DataFrame, col: str, n: int, out: str = "bin") -> DataFrame:
    """Add the bin number 1..n of equal-width right-closed bins over min..max.

    The two bounds are a scalar subquery, so the data is neither sorted nor
    collected.
    """
    bounds = df.agg(F.struct(F.min(col).cast("double").alias("lo"),
                             F.max(col).cast("double").alias("hi")).alias("b")).scalar()
    x, lo, hi = F.col(col).cast("double"), F.col("__b.lo"), F.col("__b.hi")
    number = (F.when(x.isNull(), F.lit(None))
              .when(hi == lo, F.lit(1))
              .otherwise(F.least(F.lit(n), F.greatest(F.lit(1), F.ceil((x - lo) / ((hi - lo) / float(n)))))))
    return df.withColumn("__b", bounds).withColumn(out, number.cast("int")).drop("__b")


def duration_bucket(seconds: Column) -> Column:
    out = F.when(seconds.isNull(), F.lit(None).cast("string"))
    for limit, label in DURATION_BUCKETS:
        out = out.otherwise(label) if limit is None else out.when(seconds < limit, label)
    return out


def duration_bucket_order(bucket: Column) -> Column:
    return label_order(bucket, [label for _, label in DURATION_BUCKETS])


def label_order(label: Column, order: Sequence[str]) -> Column:
    """1-based position of a label in a fixed order, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), label).cast("int")


def age_band(age: Column, bands: Sequence[tuple[int, int, str]], other: str | None = None) -> Column:
    """Inclusive age ranges to labels."""
    out = F.lit(other).cast("string")
    for lo, hi, label in reversed(list(bands)):
        out = F.when(age.between(lo, hi), label).otherwise(out)
    return out


def rain_class(total_mm: Column) -> Column:
    return (F.when(total_mm > 15, "Heavy Rain").when(total_mm > 5, "Moderate Rain")
            .when(total_mm > 0, "Light Rain").otherwise("No Rain"))


def temperature_flags(temp_f: Column) -> dict[str, Column]:
    """0/1 columns per temperature band; 65-80 °F is the reference band."""
    def flag(cond: Column) -> Column:
        return F.coalesce(cond.cast("int"), F.lit(0))

    return {
        "temp_freezing": flag(temp_f < 32),
        "temp_cold": flag((temp_f >= 32) & (temp_f < 50)),
        "temp_cool": flag((temp_f >= 50) & (temp_f < 65)),
        "temp_hot": flag((temp_f >= 80) & (temp_f < 90)),
        "temp_very_hot": flag(temp_f >= 90),
    }


def rain_flags(max_precip: Column) -> dict[str, Column]:
    return {
        "rain_light": F.coalesce(((max_precip > 0) & (max_precip < 3)).cast("int"), F.lit(0)),
        "rain_heavy": F.coalesce((max_precip >= 3).cast("int"), F.lit(0)),
    }


def one_hot(x: Column, levels: Sequence, prefix: str, drop=None) -> dict[str, Column]:
    """0/1 columns, one per level, leaving out the reference level."""
    return {f"{prefix}_{v}": F.coalesce((x == F.lit(v)).cast("int"), F.lit(0))
            for v in levels if v != drop}


def clip(x: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    out = x
    if lower is not None:
        out = F.when(out < lower, F.lit(lower).cast("double")).otherwise(out)
    if upper is not None:
        out = F.when(out > upper, F.lit(upper).cast("double")).otherwise(out)
    return out


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32
