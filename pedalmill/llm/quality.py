"""Quality classifier: Bradley-Terry ranking of documents.

A document has the strength ``w . x`` over features of its whole text. A labelled good document is
preferred to a labelled bad one with probability ``sigmoid(w . (x_good - x_bad))``; ``w`` minimises the
logistic loss on these feature differences (Newton steps, each one Spark pass over the pairs). The cut is
the quantile of labelled strengths at the share of bad labels; scores are ``sigmoid(strength - cut +
logit(0.3))``, so a document at the cut scores 0.3.

Every labelled row takes part: each row of the larger class meets about ``PARTNERS`` rows of the smaller
one, found by an equi join on a hashed bucket, so the number of pairs is linear in the labels.

Defined results: NULL and empty texts have the features of an empty text and are scored like any other;
rows with the same text have the same score; repeated label rows count once, contradicting or NULL labels
not at all; NULL ids are never learned from and count as held out; without labels of both classes all
weights are zero and every score is 0.3. Other columns are carried along untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

CUT_SCORE = 0.3
PARTNERS = 4
STEPS = 8
RIDGE = 1e-3

FEATURES = ["log_words", "mean_word", "upper", "digit", "point", "bang", "pipe", "symbol", "wide", "distinct",
            "repeat", "top_word", "short_word", "lone_mark", "mark_end", "line_repeat", "upper_word", "line_words"]

_SYMBOLS = [ord(c) for c in "*#$%&@^~=+<>\\_{}[]/"]
_POINTS = [ord(c) for c in ".,;:?\"'()-"]
_SPACE = [9, 10, 11, 12, 13, 32]


def text_features(raw: bytes) -> list[float]:
    """Features of one whole text, each in a bounded or logarithmic range."""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    ink = max(1, int(hist.sum() - hist[_SPACE].sum()))
    letters = max(1, int(hist[65:91].sum() + hist[97:123].sum()))
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line]
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    lone = sum(c for w, c in counts.items() if not w.isalnum() and w.isascii() and not any(map(_is_letter, w)))
    ends = sum(c for w, c in counts.items() if w[-1] in b".,;:!?|*#$%&")
    shout = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    return [math.log1p(n), min(ink / n, 50.0) / 10, hist[65:91].sum() / letters, hist[48:58].sum() / ink,
            hist[_POINTS].sum() / ink, hist[33] / ink, hist[124] / ink, hist[_SYMBOLS].sum() / ink,
            hist[128:].sum() / ink, math.log(len(counts)) / math.log(n) if n > 1 else 1.0,
            sum(map(bytes.__eq__, words, words[1:])) / n, max(counts.values()) / n, short / n, lone / n, ends / n,
            1 - len(set(lines)) / max(1, len(lines)), shout / n, min(n / max(1, len(lines)), 200.0) / 100]


def _is_letter(byte: int) -> bool:
    return 48 <= byte < 58 or 65 <= byte < 91 or 97 <= byte < 123


def _featurise():
    def work(texts: list[bytes]) -> list[pa.Array]:
        rows = np.array([text_features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return [pa.array(rows[:, i]) for i in range(len(FEATURES))]
    return work


def features(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and one double column per feature, in one narrow pass over the texts."""
    return common.map_bytes(df, keys, text, _featurise, ", ".join(f"__f_{f} double" for f in FEATURES))


def held_out(ident: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass(frozen=True)
class Ranking:
    """A fitted ranking: a few numbers per feature."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float

    def strength(self) -> Column:
        total = F.lit(0.0)
        for name, m, s, w in zip(FEATURES, self.mean, self.scale, self.weights):
            total = total + (F.col(f"__f_{name}") - F.lit(m)) * F.lit(w / s)
        return total

    def score(self) -> Column:
        shift = F.lit(math.log(CUT_SCORE / (1 - CUT_SCORE)) - self.cut)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(self.strength() + shift)))


def _newton_sums(width: int, weights: np.ndarray):
    def run(batches):
        grad, hess, loss = np.zeros(width), np.zeros((width, width)), 0.0
        for batch in batches:
            d = np.array(batch["d"].tolist(), dtype=float).reshape(len(batch), width)
            p = 1 / (1 + np.exp(np.clip(d @ weights, -500, 500)))  # chance given to the wrong order
            grad += p @ d
            hess += (d * (p * (1 - p))[:, None]).T @ d
            loss += len(batch)
        yield pd.DataFrame({"i": range(width + 1), "v": [[*g, *h] for g, h in zip(grad[:, None], hess)] + [[loss] * (width + 1)]})
    return run


def preference_pairs(labelled: DataFrame, partners: int = PARTNERS) -> DataFrame:
    """(good, bad) feature arrays of rows that share a hashed bucket; linear in the labelled rows."""
    sizes = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max(1, min(sizes.get(0, 0), sizes.get(1, 0)) // partners)
    spot = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(buckets))
    good = labelled.filter("y = 1").select(spot(1).alias("spot"), F.col("x").alias("good"))
    bad = labelled.filter("y = 0").select(spot(2).alias("spot"), F.col("x").alias("bad"))
    return good.join(bad, "spot")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Ranking:
    """Learn the ranking from the labelled rows that are not held out."""
    width = len(FEATURES)
    key, y = F.col(f"`{id_col}`"), F.col(f"`{label}`")
    chosen = (labels.filter(key.isNotNull() & y.isin(0, 1) & ~held_out(key))
              .groupBy(key.alias("id")).agg(F.min(y).cast("int").alias("y"), F.max(y).cast("int").alias("other"))
              .filter("y = other").drop("other"))
    known = features(docs, [id_col], text).withColumnRenamed(id_col, "id").join(chosen, "id")
    known = common.stored(known.select("id", "y", F.array(*[f"__f_{f}" for f in FEATURES]).alias("raw")), "quality-labelled")
    stats = known.agg(F.avg("y").alias("good"), *[g(F.col("raw")[i]).alias(f"{n}{i}") for i in range(width)
                                                  for n, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if stats["good"] is None or stats["good"] in (0.0, 1.0):
        return Ranking((0.0,) * width, (1.0,) * width, (0.0,) * width, 0.0)
    mean = [round(stats[f"m{i}"], 9) for i in range(width)]
    scale = [round(stats[f"s{i}"], 9) or 1.0 for i in range(width)]
    scaled = F.array(*[(F.col("raw")[i] - F.lit(m)) / F.lit(s) for i, (m, s) in enumerate(zip(mean, scale))])
    pairs = preference_pairs(known.select("id", "y", scaled.alias("x")))
    pairs = common.stored(pairs.select(F.zip_with("good", "bad", lambda a, b: a - b).alias("d")), "quality-pairs")
    w = np.zeros(width)
    for _ in range(STEPS):
        parts = pairs.mapInPandas(_newton_sums(width, w), "i int, v array<double>")
        rows = parts.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width + 1)]).collect()
        if not rows:
            break
        sums = np.array([[r[f"v{j}"] for j in range(width + 1)] for r in sorted(rows, key=lambda r: r["i"])])
        n = max(1.0, sums[width, 0])
        grad, hess = sums[:width, 0] / n - RIDGE * w, sums[:width, 1:] / n + RIDGE * np.eye(width)
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    w = np.round(w, 6)
    ranking = Ranking(tuple(mean), tuple(scale), tuple(map(float, w)), 0.0)
    strength = F.lit(0.0)
    for i in range(width):
        strength = strength + (F.col("raw")[i] - F.lit(mean[i])) * F.lit(float(w[i]) / scale[i])
    bad = 1 - stats["good"]
    # between the strengths on both sides of the quantile, so that neither lies on the cut
    around = [max(0.0, bad * 0.995), min(1.0, bad * 1.005)]
    low, high = known.agg(F.percentile_approx(strength, F.array(*map(F.lit, around)), 1_000_000)).first()[0]
    return Ranking(ranking.mean, ranking.scale, ranking.weights, round((low + high) / 2, 6))


def scored(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``__score``; one narrow pass, no shuffle."""
    carried = features(docs.withColumn("__text", F.col(f"`{text}`")), list(docs.columns), "__text")
    return carried.select(*[F.col(f"`{c}`") for c in docs.columns], ranking.score().alias("__score"))
