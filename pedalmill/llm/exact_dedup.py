"""Exact deduplication in three skew-safe combining steps.

1. Local: rows of one input partition with the same content become one row (map-side combine).
2. Salted: the local rows of a digest meet under one of ``SALTS`` salts. A text that fills a third
   of the table arrives as one row per input partition, spread over all salts.
3. Global: at most ``SALTS`` rows per content meet under the bare digest.

Every step groups by digest *and* whole content, so a digest collision cannot merge two texts.
Only DataFrame functions are used.

Defined results: NULL text counts as empty; of equal texts the row with the largest id stays (NULL
ids lose to any id); repeated rows (same id, same text) form one group and carry the same flags; an
empty table gives an empty table; other columns are neither read nor able to clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SALTS = 16


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def combine(docs: DataFrame, text: str, aggregates: list[tuple[str, Column, Column]], digest=sha256,
            salts: int = SALTS) -> DataFrame:
    """One row per distinct content: ``__digest``, ``__content`` and the aggregates.

    ``aggregates`` holds (name, first-step aggregate, merging aggregate over ``name``).
    """
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = (docs.withColumn("__content", content).withColumn("__digest", digest(F.col("__content")))
            .withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts))))
    merged = rows.groupBy("__digest", "__salt", "__content").agg(*[first.alias(n) for n, first, _ in aggregates])
    return merged.groupBy("__digest", "__content").agg(*[again.alias(n) for n, _, again in aggregates])


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest=sha256,
                     salts: int = SALTS) -> DataFrame:
    """Every row of ``docs`` with the row that stays in its place.

    Columns: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.
    """
    ident = F.col(f"`{id_col}`")
    winners = combine(docs, text, [("keep_id", F.max(ident), F.max("keep_id")),
                                   ("group_size", F.count(F.lit(1)), F.sum("group_size"))], digest, salts)
    # Contents held by one row need no lookup; what is left is written once without its text,
    # but for digests shared by different contents (none with SHA-256).
    repeated = common.stored(
        winners.filter("group_size > 1").select("__digest", F.sha2("__content", 512).alias("__content_sha"),
                                                "keep_id", "group_size"), "exact-groups")
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    facts = docs.select(ident.alias("__id"), F.concat_ws("/", digest(content), F.sha2(content, 512)).alias("__class"),
                        sha256(content).alias("__sha"))
    groups = repeated.select(F.concat_ws("/", "__digest", "__content_sha").alias("__class"), "keep_id", "group_size")
    found = common.join_by_hot_key(facts, groups, "__class", "group_size")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("__id")).otherwise(F.col("keep_id"))
    return found.select(F.col("__id").alias(id_col), keep.alias("keep_id"),
                        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        keep.eqNullSafe(F.col("__id")).alias("kept"), F.col("__sha").alias("text_sha256"))


def distinct_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest=sha256,
                  salts: int = SALTS) -> DataFrame:
    """``docs`` with one whole row per distinct content: the one with the largest id.

    The row travels with its content through the combining steps, so no join brings it back.
    Equal ids are told apart by the remaining columns that can be ordered.
    """
    def orderable(kind: str) -> bool:
        return "map<" not in kind and "variant" not in kind

    ranked = [F.col(f"`{id_col}`"), *[F.col(f"`{n}`") for n, kind in docs.dtypes if n not in (id_col, text) and orderable(kind)]]
    row = F.struct(F.col(f"`{text}`").isNull().alias("null_text"),
                   *[F.col(f"`{c}`") for c in docs.columns if c != text])
    order = F.struct(*ranked)
    first = F.max_by(F.struct(order.alias("o"), row.alias("r")), order)
    winners = combine(docs, text, [("__row", first, F.max_by("__row", F.col("__row.o")))], digest, salts)
    back = {c: F.col(f"__row.r.`{c}`") for c in docs.columns if c != text}
    back[text] = F.when(~F.col("__row.r.null_text"), F.col("__content"))
    return winners.select(*[back[c].alias(c) for c in docs.columns])
