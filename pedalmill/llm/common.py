"""Helpers shared by the corpus operators: stored tables, Arrow row mapping and skew-safe joins."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.session import shared_dir, ship_package

#: A key with at least this share of all rows is hot, so there are never more than 1/share hot keys.
HOT_SHARE = 0.001
#: Texts of an Arrow batch that are held as Python objects at a time.
SLICE_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; also makes the package known to Python workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the files.

    Cuts lineage like ``checkpoint()``: a lost executor costs a rerun of its tasks only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(text: str | Column) -> Column:
    """The text as UTF-8 bytes; NULL counts as empty."""
    col = F.col(f"`{text}`") if isinstance(text, str) else text
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")


def map_bytes(df: DataFrame, keys: list[str], text: str, fn: Callable[[], Callable[[list[bytes]], list[pa.Array]]],
              schema: str) -> DataFrame:
    """Run a function over the UTF-8 bytes of ``text`` and append its columns to ``keys``.

    ``fn`` is called once per task and returns the function for a slice of an Arrow batch, so that
    caches and automata live as long as the task. ``schema`` names the appended columns.
    """
    before = df.select(*[F.col(f"`{k}`") for k in keys], utf8(text).alias("__bytes"))
    added = df.sparkSession.createDataFrame([], schema).schema
    out = type(added)(before.schema.fields[:-1] + added.fields)
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                columns = work(batch.column(batch.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    return before.mapInArrow(run, out)


def hot_keys(counts: DataFrame, size: str, share: float = HOT_SHARE) -> DataFrame:
    """Rows whose ``size`` is at least ``share`` of the total: at most ``1/share`` of them."""
    total = counts.agg(F.sum(size)).scalar()
    return counts.filter(F.col(size) >= total * F.lit(share))


def join_by_hot_key(facts: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``facts LEFT JOIN groups USING (key)`` where one key may hold a third of the facts.

    ``groups`` has one row per key with the number of facts in ``size``. Hot keys (at most
    1/HOT_SHARE of them) are answered by broadcast; their facts get a key of their own in the
    shuffle join, which spreads them over all tasks. One scan of the facts.
    """
    values = [c for c in groups.columns if c != key]
    hot = hot_keys(groups, size).select(key, F.struct(*values).alias("__hot"))
    marked = facts.join(F.broadcast(hot), key, "left")
    spread = F.concat(F.lit("\u0001"), F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]).cast("string"))
    marked = marked.withColumn("__key", F.when(F.col("__hot").isNotNull(), spread).otherwise(F.col(key)))
    cold = groups.select(F.col(key).alias("__key"), F.struct(*values).alias("__cold"))
    found = marked.join(cold, "__key", "left").withColumn("__found", F.coalesce("__hot", "__cold"))
    return found.select(*[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"__found.{v}").alias(v) for v in values])
