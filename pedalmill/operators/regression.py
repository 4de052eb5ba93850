"""Least squares from a distributed Gram matrix.

Spark reduces the rows to one (p+1) x (p+1) matrix of cross products per model;
only that matrix reaches the driver, where a pseudo-inverse copes with collinear
designs (weekend flag = Saturday dummy + Sunday dummy).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERCEPT = "const"


@dataclass(frozen=True)
class Gram:
    """Cross products of (1, features..., y) and the number of rows."""

    names: list[str]
    matrix: np.ndarray

    @property
    def n(self) -> int:
        return int(round(self.matrix[0, 0]))

    def sub(self, features: Sequence[str]) -> "Gram":
        """The Gram matrix of a model with fewer features."""
        wanted = [INTERCEPT, *features, self.names[-1]]
        idx = [self.names.index(w) for w in wanted]
        return Gram(wanted, self.matrix[np.ix_(idx, idx)])


@dataclass(frozen=True)
class Fit:
    names: list[str]
    coef: np.ndarray
    stderr: np.ndarray
    r2: float
    adj_r2: float
    n: int
    rank: int

    @property
    def determined(self) -> bool:
        """Whether the data determine all coefficients; otherwise they are the shortest of many equally good ones."""
        return self.rank == len(self.names)

    def params(self) -> dict[str, float]:
        return dict(zip(self.names, (float(c) for c in self.coef)))

    def p_values(self) -> np.ndarray:
        df = self.n - self.rank
        with np.errstate(divide="ignore", invalid="ignore"):
            t = self.coef / self.stderr
        return np.array([t_two_sided(float(x), df) for x in t])

    def table(self, spark) -> DataFrame:
        """One row per coefficient."""
        p = self.p_values()
        rows = [(name, float(self.coef[i]), float(self.stderr[i]), float(p[i]))
                for i, name in enumerate(self.names)]
        return spark.createDataFrame(rows, "term string, coef double, std_err double, p_value double")


def t_two_sided(t: float, df: int) -> float:
    """Two-sided p-value of Student's t."""
    if math.isnan(t) or df <= 0:
        return float("nan")
    return _beta_inc(df / 2.0, 0.5, df / (df + t * t))


def _beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_inc(b, a, 1.0 - x)
    tiny = 1e-300
    c, d, value = 1.0, 1.0 - (a + b) * x / (a + 1.0), 1.0
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value / a


def gram_rows(df: DataFrame, features: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """Cross products as rows (by..., __i, __j, __v), reduced per task before the shuffle.

    Rows with a NULL feature or target are left out, as are their weights. Each
    task sends p(p+1)/2 sums per group, whatever the number of rows it read.
    """
    cols = [*features, y]
    by = list(by)
    width = len(cols) + 1
    upper = np.triu_indices(width)
    data = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    by_schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in data.schema.fields[:len(by)])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            groups = pdf.groupby(by, sort=False, dropna=False) if by else [((), pdf)]
            for key, part in groups:
                key = key if isinstance(key, tuple) else (key,)
                x = np.column_stack([np.ones(len(part)), part[cols].to_numpy(dtype="float64")])
                g = x.T @ x
                sums[key] = sums[key] + g if key in sums else g
        for key, g in sums.items():
            out = pd.DataFrame({"__i": upper[0], "__j": upper[1], "__v": g[upper]})
            for pos, name in enumerate(by):
                out.insert(pos, name, key[pos])
            yield out

    parts = data.mapInPandas(partial, by_schema + "__i int, __j int, __v double")
    return parts.groupBy(*by, "__i", "__j").agg(F.sum("__v").alias("__v"))


def _assemble(rows: list, names: list[str]) -> Gram:
    m = np.zeros((len(names), len(names)))
    for i, j, v in rows:
        m[i, j] = m[j, i] = v
    return Gram(names, m)


def gram(df: DataFrame, features: Sequence[str], y: str) -> Gram:
    """The Gram matrix; p(p+1)/2 numbers reach the driver."""
    rows = [tuple(r) for r in gram_rows(df, features, y).collect()]
    return _assemble(rows, [INTERCEPT, *features, y])


def solve(g: Gram) -> Fit:
    """Coefficients, standard errors and fit measures of one model."""
    p = len(g.names) - 1
    xtx, xty, yty = g.matrix[:p, :p], g.matrix[:p, p], float(g.matrix[p, p])
    n = g.n
    # Scale columns to unit length so the rank test does not depend on units. The inverse in
    # scaled units is then projected onto the row space in raw units, which makes it the
    # pseudo-inverse of the raw design: the shortest coefficients among all best ones.
    scale = np.sqrt(np.maximum(np.diag(xtx), 0.0))
    scale[scale == 0.0] = 1.0
    values, vectors = np.linalg.eigh(xtx / np.outer(scale, scale))
    used = values > 1e-10 * max(values[-1], 0.0)
    rank = int(used.sum())
    inv = (vectors[:, used] / values[used]) @ vectors[:, used].T / np.outer(scale, scale)
    if rank < p:
        free = np.linalg.qr(vectors[:, ~used] / scale[:, None])[0]
        onto = np.eye(p) - free @ free.T
        inv = onto @ inv @ onto
    coef = inv @ xty
    # Sums of squares around the means, which large means do not cancel.
    centre, mean = xtx[0] / n, xty[0] / n
    sst = yty - n * mean * mean
    xy, xx = xty - n * centre * mean, xtx - n * np.outer(centre, centre)
    sse = max(sst - 2 * float(coef @ xy) + float(coef @ xx @ coef), 0.0)
    r2 = 1.0 - sse / sst if sst > 0 else float("nan")
    dof = n - rank
    adj = 1.0 - (1.0 - r2) * (n - 1) / dof if dof > 0 else float("nan")
    sigma2 = sse / dof if dof > 0 else float("nan")
    stderr = np.sqrt(np.maximum(np.diag(inv) * sigma2, 0.0))
    return Fit(list(g.names[:p]), coef, stderr, r2, adj, n, rank)


def ols(df: DataFrame, features: Sequence[str], y: str) -> Fit:
    return solve(gram(df, features, y))


def nested(df: DataFrame, models: dict[str, Sequence[str]], y: str) -> dict[str, Fit]:
    """Several models over one pass: all are sub-matrices of the widest Gram matrix.

    Rows need every feature of the widest model, so the models compare on equal rows.
    """
    widest = list(dict.fromkeys(f for feats in models.values() for f in feats))
    g = gram(df, widest, y)
    return {name: solve(g.sub(list(feats))) for name, feats in models.items()}


def ols_by(df: DataFrame, features: Sequence[str], y: str, by: Sequence[str], min_rows: int = 0) -> DataFrame:
    """One model per group, solved in tasks: (by..., n, term, coef, std_err, r2).

    What is grouped here is the p(p+1)/2 sums of each group, never its rows.
    """
    by = list(by)
    names = [INTERCEPT, *features, y]
    rows = gram_rows(df, features, y, by)
    cells = rows.groupBy(*by).agg(F.collect_list(F.struct("__i", "__j", "__v")).alias("__g"))
    by_schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cells.schema.fields[:len(by)])

    def solve_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                g = _assemble([(c["__i"], c["__j"], c["__v"]) for c in rec["__g"]], names)
                if g.n < min_rows:
                    continue
                fit = solve(g)
                out += [{**{k: rec[k] for k in by}, "n": fit.n, "term": t, "coef": float(fit.coef[i]),
                         "std_err": float(fit.stderr[i]), "r2": fit.r2} for i, t in enumerate(fit.names)]
            yield pd.DataFrame(out, columns=[*by, "n", "term", "coef", "std_err", "r2"])

    return cells.mapInPandas(solve_groups, by_schema + "n long, term string, coef double, std_err double, r2 double")


def polyfit2(df: DataFrame, x: str, y: str) -> Fit:
    """Least-squares parabola y = a + b x + c x^2, fitted around the mean of x for accuracy."""
    centre = df.agg(F.avg(x)).first()[0]
    shifted = df.select((F.col(x) - centre).alias("x1"), F.col(y).alias("y")) \
        .withColumn("x2", F.col("x1") * F.col("x1"))
    fit = ols(shifted, ["x1", "x2"], "y")
    a, b, c = fit.coef
    coef = np.array([a - b * centre + c * centre * centre, b - 2 * c * centre, c])
    return Fit([INTERCEPT, "x", "x_sq"], coef, np.full(3, np.nan), fit.r2, fit.adj_r2, fit.n, fit.rank)


def effect(fit: Fit, terms: Sequence[str]) -> Column:
    """Sum of coefficient times feature over some terms, as a column."""
    p = fit.params()
    return reduce(lambda a, b: a + b, [F.lit(p[t]) * F.col(t) for t in terms], F.lit(0.0))


def predict(fit: Fit) -> Column:
    return F.lit(fit.params()[INTERCEPT]) + effect(fit, [n for n in fit.names if n != INTERCEPT])


def adjusted_series(df: DataFrame, fit: Fit, y: str, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Predictions, residuals, one effect column per group, and the adjusted series.

    Adjusted = actual - effects + mean effects. The means are a scalar subquery.
    """
    out = df.withColumn("predicted", predict(fit)).withColumn("residual", F.col(y) - F.col("predicted"))
    for name, terms in groups.items():
        out = out.withColumn(f"{name}_effect", effect(fit, list(terms)))
    total = reduce(lambda a, b: a + b, [F.col(f"{g}_effect") for g in groups])
    mean_total = out.agg(F.avg(total)).scalar()
    return out.withColumn(f"adjusted_{y}", F.col(y) - total + mean_total)


def growth_decomposition(annual: DataFrame, total: str, drivers: dict[str, float], base_year: int,
                         days: int = 365) -> DataFrame:
    """Growth since the base year split into driver contributions and the rest.

    ``drivers`` maps a yearly mean column to its coefficient per day.
    """
    base = annual.filter(F.col("year") == base_year).agg(
        F.struct(F.max(total).alias(total), *[F.max(d).alias(d) for d in drivers]).alias("b")).scalar()
    out = annual.withColumn("__base", base)
    out = out.withColumn("total_growth", F.col(total) - F.col(f"__base.{total}"))
    for d, coef in drivers.items():
        out = out.withColumn(f"{d}_contribution", (F.col(d) - F.col(f"__base.{d}")) * coef * days)
    rest = reduce(lambda a, d: a - F.col(f"{d}_contribution"), drivers, F.col("total_growth"))
    return out.withColumn("organic_growth", rest).drop("__base")
