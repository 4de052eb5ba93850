"""Exact quantiles and modes that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per histogram level. Two levels split the overall range 4096 x 4096 times.
FANOUT = 4096


def even_scale(value: Column) -> Column:
    """A number that grows with ``value`` by 1 per doubling, linearly in between; odd in its sign.

    Buckets of equal width on it follow the size of the values, so a far outlier
    does not push all the others into one bucket.
    """
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    grown = octave.cast("double") + 1100.0 + (size / F.pow(F.lit(2.0), octave.cast("double")) - 1.0)
    return F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * grown)


def exact_quantiles(df: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[str, float]],
                    fanout: int = FANOUT, weight: str | None = None) -> DataFrame:
    """Interpolated quantiles per key: ``{output: (column, probability)}``.

    With ``weight`` each row stands for that many equal rows.

    ``percentile`` keeps every distinct value of a group in one task. Here equal
    values are counted first. A histogram per key then finds the bucket of each
    wanted rank, a second histogram splits those buckets again, and only values
    that share a key and a finest bucket are put in order. Windows therefore run
    over at most ``fanout`` buckets, or over values closer together than
    ``1/fanout^2`` of the column's range in doublings, however many rows a key has
    and however far an outlier lies. Bucket bounds are exact minima and maxima, so a retried task sees the same buckets.
    """
    keys = list(keys)
    cols = list(dict.fromkeys(c for c, _ in wanted.values()))
    n = F.lit(1).cast("long") if weight is None else F.col(weight)
    stacked = df.select(*keys, n.alias("__w"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("__s"))
    counts = (stacked.filter(F.col("__s.v").isNotNull())
              .groupBy(*keys, F.col("__s.i").alias("__i"), F.col("__s.v").alias("__v"))
              .agg(F.sum("__w").alias("__n")).withColumn("__e", even_scale(F.col("__v"))))
    # The sum keeps this aggregate equal to the one below, so Spark reuses its shuffle.
    bounds = counts.agg(F.struct(
        *[F.min(F.when(F.col("__i") == i, F.col("__e"))).alias(f"lo{i}") for i in range(len(cols))],
        *[F.max(F.when(F.col("__i") == i, F.col("__e"))).alias(f"hi{i}") for i in range(len(cols))],
        F.sum("__n").alias("n")).alias("b")).scalar()

    def per_column(make) -> Column:
        out = make(len(cols) - 1)
        for i in range(len(cols) - 2, -1, -1):
            out = F.when(F.col("__i") == i, make(i)).otherwise(out)
        return out

    lo, hi = per_column(lambda i: F.col(f"__b.lo{i}")), per_column(lambda i: F.col(f"__b.hi{i}"))
    at = F.when(hi > lo, (F.col("__e") - lo) / (hi - lo)).otherwise(F.lit(0.0))
    counts = (counts.withColumn("__b", bounds).withColumn("__x", at)
              .withColumn("__b1", F.floor(F.col("__x") * fanout))
              .withColumn("__b2", F.floor(F.col("__x") * (fanout * fanout)))
              .drop("__b", "__x", "__e"))

    def position(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    ranks = per_column(lambda i: F.array(*[
        f(position(p)).cast("long") for c, p in wanted.values() if c == cols[i] for f in (F.floor, F.ceil)]))
    holds = F.exists(ranks, lambda k: (k >= F.col("__upto") - F.col("__n")) & (k < F.col("__upto")))
    group = [*keys, "__i"]

    def running(part: Sequence[str], order: str):
        return (Window.partitionBy(*part).orderBy(order)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def before() -> Column:
        return (F.col("__upto") - F.col("__n")).alias("__before")

    first = (counts.groupBy(*group, "__b1").agg(F.sum("__n").alias("__n"))
             .withColumn("__total", F.sum("__n").over(Window.partitionBy(*group)))
             .withColumn("__upto", F.sum("__n").over(running(group, "__b1")))
             .filter(holds).select(*group, "__b1", "__total", before()))
    second = (_join_same(counts, first, [*group, "__b1"])
              .groupBy(*group, "__b1", "__b2", "__total", "__before").agg(F.sum("__n").alias("__n"))
              .withColumn("__upto", F.col("__before") + F.sum("__n").over(running([*group, "__b1"], "__b2")))
              .filter(holds).select(*group, "__b1", "__b2", "__total", before()))
    last = (_join_same(counts, second, [*group, "__b1", "__b2"])
            .withColumn("__upto", F.col("__before") + F.sum("__n").over(running([*group, "__b1", "__b2"], "__v"))))

    def value_at(i: int, p: float, f) -> Column:
        k = f(position(p)).cast("long")
        hit = (F.col("__i") == i) & (k >= F.col("__upto") - F.col("__n")) & (k < F.col("__upto"))
        return F.max(F.when(hit, F.col("__v")))

    aggs = []
    for name, (c, p) in wanted.items():
        i = cols.index(c)
        low, high = value_at(i, p, F.floor), value_at(i, p, F.ceil)
        h = F.max(F.when(F.col("__i") == i, position(p)))
        aggs.append((low + (high - low) * (h - F.floor(h))).alias(name))
    return last.groupBy(*keys).agg(*aggs)


def _join_same(counts: DataFrame, picks: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi join that also matches NULL keys."""
    cond = None
    for c in on:
        same = F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}"))
        cond = same if cond is None else cond & same
    extra = [c for c in picks.columns if c not in on]
    return counts.alias("c").join(picks.alias("p"), cond).select("c.*", *[F.col(f"p.{c}") for c in extra])


def modes(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value per key with its count; ties go to the smallest value.

    Counting per (key, value) first spreads a hot key over its values.
    """
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("__n")))
    best = F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("__b")).select(
        *keys, F.col("__b.v").alias(out), (-F.col("__b.neg")).alias(f"{out}_count"))
