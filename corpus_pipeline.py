"""Corpus pipeline: from raw documents to a mixed, deduplicated, encoded training set.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs`` unchanged, extra ones included. Near duplicates are told apart by id and text, so rows
with repeated or without ``doc_id`` take part. Columns that the stages do not read may have any names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.llm import common, exact_dedup, mixing, near_dedup, quality, sentence_pieces
from pedalmill.llm.queries import vocabulary
from pedalmill.session import fits_broadcast, ship_package

#: Share of the tokens that mixing draws at least, however rare the rarest cell is.
LEAST_TOKENS = 0.5
#: Columns that keep their names inside a stage.
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def any_columns(stage: Stage) -> Stage:
    """A stage that returns the columns of ``docs``, for ``docs`` with further columns of any names.

    They carry plain names inside the stage, so none can be taken for one of its own.
    """
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in DOCUMENT else f"extra{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*plain), sf_dir).toDF(*docs.columns)
    return run


@any_columns
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject."""
    ranking = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = quality.scored(docs, ranking)
    return scored.filter(F.col("__score") >= quality.CUT_SCORE).select(*[F.col(f"`{c}`") for c in docs.columns])


@any_columns
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest id of every distinct text."""
    return exact_dedup.distinct_rows(docs)


@any_columns
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate group: the smallest id, then the smallest text digest, NULL ids last."""
    ship_package(spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    groups = near_dedup.near_duplicate_groups(docs, row_keys=True).select("doc_id", "text_digest", "rows", "chosen")
    groups = common.stored(groups.filter("rows IS NOT NULL"), "pipeline-groups")
    keys = ["doc_id", "text_digest"]
    dropped = common.stored(groups.filter("NOT chosen").select(*keys).distinct(), "pipeline-dropped")
    rows = _without(docs, dropped).select(*columns)
    # what is chosen may stand there several times, id and text alike
    repeated = common.stored(groups.filter("chosen").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys), "pipeline-repeated")
    if repeated.isEmpty():
        return rows
    whole = F.struct(*columns)
    same = rows.withColumn("__digest", near_dedup.text_digest()).join(
        repeated, F.col("__digest").eqNullSafe(repeated["text_digest"]) & rows["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi")
    one = same.groupBy(F.col("doc_id").alias("__id"), "__digest").agg(F.min_by(whole, F.to_json(whole)).alias("__row"))
    return _without(rows, repeated).select(*columns).unionByName(one.select("__row.*"))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose id and text digest are not among ``keys``; NULL ids are a value."""
    keys = F.broadcast(keys) if fits_broadcast(keys) else keys
    digested = docs.withColumn("__digest", near_dedup.text_digest())
    return digested.join(keys, digested["doc_id"].eqNullSafe(keys["doc_id"]) & (F.col("__digest") == keys["text_digest"]), "left_anti")


@any_columns
def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the calibrated chances of their source, language and topic, ``LEAST_TOKENS`` of them at least."""
    return mixing.sample(docs, mixing.fit(docs, least=LEAST_TOKENS))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, piece ``ids`` and their number for every document."""
    ship_package(spark)
    rows = sentence_pieces.encode(docs, vocabulary("piece_bpe_32k.model"), ["doc_id", "lang", "source"])
    return rows.withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("target_mixing", mix_to_targets), ("sentence_pieces", encode_pieces)]

#: The first stage is a fitted model and the last one a trained vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
