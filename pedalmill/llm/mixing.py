"""Mixing sources to target weights by iterative proportional fitting.

Tokens (white-space separated words) are summed per cell of source, language and topic. Raking scales the
cells so that their sums follow the target shares of each of the three, in turn, ``ROUNDS`` times. The
ratio of a cell's fitted to its present tokens, divided by the largest ratio, is the chance of its
documents; a document is drawn if a number derived from its id falls below it. The expected tokens of the
drawn documents then have the fitted shares, but the rarest cell decides how many tokens are drawn.

With a token ``budget``, or a ``least`` share of tokens that is drawn at any rate, a cell is kept whole (chance 1)
where the scaled ratio would pass 1, and the other cells are raked again to what is left of the targets, until no
cell passes 1 and the largest gap of a marginal is below ``TOLERANCE`` or stays. A tiny cell then takes nothing
from the others. Values that run out of tokens miss their target; ``report`` lists what is reached.

Targets are the present shares to the power ``TEMPERATURE``, so small values gain weight, unless given.
Only DataFrame functions are used. Documents are never collected in one place; what is fitted is the table
of cells, whose size is the number of distinct value combinations.

Defined results: NULL source, language or topic is a value of its own; documents without words weigh
nothing and get the chance of their cell; values without a target, and cells whose tokens are zero, have the
ratio 0 and are never drawn (with derived targets this touches only values without any words); rows of the
same id are drawn together; NULL ids use the number of the text ``null``; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pedalmill.session import lookup_join

from . import common

DIMENSIONS = ("source", "lang", "topic")
TEMPERATURE = 0.9
ROUNDS = 10
STORE_EVERY = 5
TOLERANCE = 1e-4
#: Raking to a budget stops when the largest gap shrinks by less than this share in ``STORE_EVERY`` rounds.
STALLED = 0.01

# Marks of a topic, as patterns over the text; a document has the topic with the most marks.
TOPICS = {
    "contact": r"@|https?://|www\.",
    "legal": r"[Ll]icens|[Cc]opyright|[Vv]ersion",
    "record": r"[0-9][0-9]+",
}
OTHER_TOPIC = "prose"
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column, topics: dict[str, str] = TOPICS) -> Column:
    """The topic with the most marks, the first by name of several, ``OTHER_TOPIC`` without any."""
    ranked = [F.struct(F.regexp_count(text, F.lit(p)).alias("marks"), F.lit(-n).alias("order"), F.lit(name).alias("name"))
              for n, (name, p) in enumerate(sorted(topics.items()), 1)]
    none = F.struct(F.lit(0).alias("marks"), F.lit(0).alias("order"), F.lit(OTHER_TOPIC).alias("name"))
    return F.array_max(F.array(none, *ranked))["name"]


def uniform(ident: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) that depends on the id alone."""
    text = F.concat(F.coalesce(ident.cast("string"), F.lit("null")), F.lit("/" + seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def _with_cells(docs: DataFrame, text: str, source: str, lang: str) -> list[Column]:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    missing = F.lit("\u0000")  # joins do not match NULL
    return [F.coalesce(F.col(f"`{source}`").cast("string"), missing).alias("__source"),
            F.coalesce(F.col(f"`{lang}`").cast("string"), missing).alias("__lang"), topic_of(body).alias("__topic")]


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimensions and ``weight``) with the fitted weight ``fitted``.

    ``targets[d]`` has the columns ``d`` and ``share``. Each step is a window sum over the table of cells, so
    the plan grows by one window a step; lineage is cut every few rounds.
    """
    total = cells.agg(F.sum("weight").alias("n")).first()["n"] or 0.0
    fitted = cells.withColumn("fitted", F.col("weight"))
    for d, goal in targets.items():
        fitted = fitted.join(goal.select(d, (F.col("share") * F.lit(total)).alias(f"goal{d}")), d, "left")
    keep = fitted.columns
    for n in range(rounds):
        for d in targets:
            margin = F.sum("fitted").over(Window.partitionBy(d))
            factor = F.when(margin > 0, F.col(f"goal{d}") / margin)
            fitted = fitted.withColumn("fitted", F.col("fitted") * F.coalesce(factor, F.lit(0.0)))
        if (n + 1) % STORE_EVERY == 0 or n + 1 == rounds:
            fitted = common.stored(fitted.select(*keep), "mixing-cells")
    return fitted.select(*cells.columns, "fitted")


def rake_within(cells: DataFrame, targets: dict[str, DataFrame], budget: float, tolerance: float = TOLERANCE) -> DataFrame:
    """Like ``rake`` to ``budget`` tokens, with no cell above its weight.

    What whole cells leave of each target goes to the other cells. Values without such cells have run out; the
    others of their dimension share what they leave, as far as they have tokens.
    """
    dims = list(targets)
    state = cells.withColumn("fitted", F.col("weight"))
    for d, goal in targets.items():
        state = state.join(goal.select(d, F.col("share").alias(f"share{d}")), d, "left")
    wanted = F.lit(True)
    for d in dims:
        wanted = wanted & (F.coalesce(f"share{d}", F.lit(0.0)) > 0)
    state = common.stored(state.withColumn("whole", F.lit(False)).withColumn("free", wanted & (F.col("weight") > 0)), "mixing-cells")
    keep = state.columns
    while True:
        taken = F.sum(F.when(F.col("whole"), F.col("weight")).otherwise(0.0))
        rest = budget - (state.agg(taken.alias("n")).first()["n"] or 0.0)
        for d in dims:
            left = state.groupBy(d).agg(F.greatest(F.first(f"share{d}") * F.lit(budget) - taken, F.lit(0.0)).alias("left"),
                                        F.max("free").alias("open")).filter("open AND left > 0")
            left = left.withColumn(f"goal{d}", F.col("left") * F.lit(rest) / left.agg(F.sum("left")).scalar()).select(d, f"goal{d}")
            state = state.join(left, d, "left")
        before, over = None, False
        while not over:
            raked = state.withColumn("fitted", F.when(F.col("free"), F.col("fitted")).otherwise(0.0))
            margins = {d: F.sum("fitted").over(Window.partitionBy(d)) for d in dims}
            for _ in range(STORE_EVERY):
                for d, margin in margins.items():
                    raked = raked.withColumn("fitted", F.col("fitted") * F.coalesce(F.when(margin > 0, F.col(f"goal{d}") / margin), F.lit(0.0)))
            gaps = [F.when(F.col("free") & (F.col(f"goal{d}") > 0), F.abs(m / F.col(f"goal{d}") - 1)) for d, m in margins.items()]
            raked = raked.withColumn("gap", F.greatest(*gaps)).withColumn("over", F.col("free") & (F.col("fitted") > F.col("weight")))
            raked = common.stored(raked, "mixing-cells")
            found = raked.agg(F.max("gap").alias("gap"), F.max("over").alias("over")).first()
            gap, over = found["gap"] or 0.0, bool(found["over"])
            state = raked.drop("gap", "over")
            if not over and (gap <= tolerance or (before is not None and gap > (1 - STALLED) * before)):
                return state.select(*cells.columns, F.when(F.col("whole"), F.col("weight")).otherwise(F.col("fitted")).alias("fitted"))
            before = gap
        state = raked.withColumn("whole", F.col("whole") | F.col("over")).withColumn("free", F.col("free") & ~F.col("over")).select(*keep)


def report(cells: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``dimension``, ``value``, ``weight``, ``drawn`` (expected tokens), ``target``, ``reached`` (shares) and ``gap``.

    ``gap`` is the relative difference between the reached and the target share; ``targets`` as for ``fit``.
    """
    parts = []
    total = cells.agg(F.sum(F.col("weight") * F.col("chance"))).scalar()
    for d in DIMENSIONS:
        goal = (targets or {}).get(d)
        goal = smoothed_targets(cells, f"__{d}") if goal is None else goal.withColumnRenamed(d, f"__{d}")
        sums = cells.groupBy(f"__{d}").agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("chance")).alias("drawn"))
        goal = goal.select(f"__{d}", F.col("share").alias("target"))
        parts.append(sums.join(goal, f"__{d}", "full").select(
            F.lit(d).alias("dimension"), F.col(f"__{d}").alias("value"), F.coalesce("weight", F.lit(0.0)).alias("weight"),
            F.coalesce("drawn", F.lit(0.0)).alias("drawn"), F.coalesce("target", F.lit(0.0)).alias("target")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("reached", F.coalesce(F.try_divide("drawn", total), F.lit(0.0)))
    return rows.withColumn("gap", F.try_divide(F.abs(F.col("reached") - F.col("target")), F.col("target")))


def smoothed_targets(cells: DataFrame, dimension: str, temperature: float = TEMPERATURE) -> DataFrame:
    """Present shares to the power ``temperature``, scaled to 1; values without weight have no target."""
    sums = cells.groupBy(dimension).agg(F.sum("weight").alias("__sum")).filter("__sum > 0")
    raised = sums.select(dimension, F.pow("__sum", F.lit(temperature)).alias("__up"))
    return raised.withColumn("share", F.col("__up") / raised.agg(F.sum("__up")).scalar()).select(dimension, "share")


def fit(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, text: str = "text", source: str = "source",
        lang: str = "lang", budget: float | None = None, least: float | None = None) -> DataFrame:
    """One row per cell: ``__source``, ``__lang``, ``__topic``, ``weight`` (tokens), ``fitted``, ``chance``.

    ``budget`` tokens are drawn, or at least the share ``least`` of all tokens. Without either, or where ``least`` is
    met without it, the rarest cell limits the draw.
    """
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD))
    rows = docs.select(*_with_cells(docs, text, source, lang), words.alias("__tokens"))
    dims = [f"__{d}" for d in DIMENSIONS]
    cells = common.stored(rows.groupBy(*dims).agg(F.sum("__tokens").cast("double").alias("weight")), "mixing-cells")
    goals = {f"__{d}": (targets or {}).get(d) for d in DIMENSIONS}
    goals = {d: common.stored(smoothed_targets(cells, d), "mixing-targets") if g is None else g.withColumnRenamed(d[2:], d) for d, g in goals.items()}
    rated = _rated(rake(cells, goals, rounds))
    largest = rated.agg(F.max("__ratio")).scalar()
    rated = rated.withColumn("chance", F.coalesce(F.round(F.try_divide("__ratio", largest), 9), F.lit(0.0))).drop("__ratio")
    if budget is None and least is None:
        return rated
    rated = common.stored(rated, "mixing-cells")
    sums = rated.agg(F.sum("weight").alias("present"), F.sum(F.col("weight") * F.col("chance")).alias("drawn")).first()
    present, drawn = sums["present"] or 0.0, sums["drawn"] or 0.0
    wanted = min(present, max(float(budget or 0.0), (least or 0.0) * present))
    if budget is None and drawn >= wanted:
        return rated
    chance = F.round(F.least("__ratio", F.lit(1.0)), 9)
    return _rated(rake_within(cells, goals, wanted)).withColumn("chance", chance).drop("__ratio")


def _rated(fitted: DataFrame) -> DataFrame:
    return fitted.withColumn("__ratio", F.when(F.col("weight") > 0, F.col("fitted") / F.col("weight")).otherwise(F.lit(0.0)))


def chances(docs: DataFrame, cells: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
            lang: str = "lang") -> DataFrame:
    """All columns of ``docs`` with ``__source``, ``__lang``, ``__topic``, ``__chance`` and ``__drawn``."""
    dims = [f"__{d}" for d in DIMENSIONS]
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *_with_cells(docs, text, source, lang))
    found = lookup_join(rows, cells.select(*dims, F.col("chance").alias("__chance")), dims, "left")
    chance = F.coalesce("__chance", F.lit(0.0))
    return found.withColumn("__chance", chance).withColumn("__drawn", uniform(F.col(f"`{id_col}`")) < chance)


def sample(docs: DataFrame, cells: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """The drawn rows of ``docs``, columns unchanged; no shuffle of texts when the cells are small."""
    return chances(docs, cells, id_col, text, source, lang).filter("__drawn").select(*[F.col(f"`{c}`") for c in docs.columns])


def comparison_sql(docs: str = "documents", rounds: int = ROUNDS, temperature: float = TEMPERATURE) -> str:
    """The same fit and draw as one SQL statement, for checks: CTEs up to ``fitted`` and ``rated_docs``."""
    kinds = sorted(TOPICS.items())
    counts = ", ".join(f"len(regexp_extract_all(coalesce(text, ''), '{p}')) AS n_{n}" for n, p in kinds)
    most = "greatest(" + ", ".join(f"n_{n}" for n, _ in kinds) + ")"
    topic = f"CASE WHEN {most} = 0 THEN '{OTHER_TOPIC}' " + " ".join(f"WHEN n_{n} = {most} THEN '{n}'" for n, _ in kinds) + " END"
    ctes = [f"counted AS MATERIALIZED (SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_words, {counts} FROM {docs})",
            f"topical AS MATERIALIZED (SELECT doc_id, text, coalesce(source, chr(1)) AS s, coalesce(lang, chr(1)) AS l, {topic} AS t, n_words FROM counted)",
            "c0 AS MATERIALIZED (SELECT s, l, t, CAST(sum(n_words) AS DOUBLE) AS weight, CAST(sum(n_words) AS DOUBLE) AS fitted FROM topical GROUP BY ALL)"]
    for d in "slt":
        ctes.append(f"goal_{d} AS MATERIALIZED (SELECT {d}, up / sum(up) OVER () AS share FROM (SELECT {d}, pow(sum(weight), {temperature}) AS up "
                    f"FROM c0 GROUP BY {d} HAVING sum(weight) > 0))")
    at = 0
    for _ in range(rounds):
        for d in "slt":
            ctes.append(f"c{at + 1} AS MATERIALIZED (SELECT s, l, t, weight, fitted * coalesce(CASE WHEN sum(fitted) OVER (PARTITION BY {d}) > 0 THEN "
                        f"share * (SELECT sum(weight) FROM c0) / sum(fitted) OVER (PARTITION BY {d}) END, 0) AS fitted FROM c{at} LEFT JOIN goal_{d} USING ({d}))")
            at += 1
    ctes.append(f"rated AS MATERIALIZED (SELECT s, l, t, fitted, CASE WHEN weight > 0 THEN fitted / weight ELSE 0 END AS ratio FROM c{at})")
    ctes.append("cell AS MATERIALIZED (SELECT s, l, t, fitted, coalesce(round(ratio / (SELECT max(ratio) FROM rated), 9), 0) AS chance FROM rated)")
    ctes.append("rated_docs AS MATERIALIZED (SELECT d.*, chance, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/mix'), 1, 13) AS BIGINT) "
                f"/ {float(16 ** 13)!r} < chance AS drawn FROM topical d JOIN cell USING (s, l, t))")
    return "WITH " + ",\n".join(ctes)
