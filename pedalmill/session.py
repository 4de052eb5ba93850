"""Session settings and the two size-aware helpers every operator shares."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest estimated size of a table that may be sent to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: Row bound used when the estimate says nothing useful (after joins, say).
BROADCAST_LIMIT_ROWS = 200_000
#: A table whose inputs are larger than this is taken as large without counting it.
COUNT_LIMIT_BYTES = 16 * 1024 ** 3
#: Catalyst's estimate for inputs it knows nothing about.
UNKNOWN_BYTES = 2 ** 63 - 1
#: A key with more than this share of the rows is heavy; there are at most 1/share of them.
HEAVY_SHARE = 0.001


def build_session(app: str = "pedalmill", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Times are wall-clock times, so the zone is pinned to UTC. Adaptive
    execution picks partition counts and splits skewed join partitions.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call sites are recorded for every column otherwise, which doubles the time
        # it takes to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they run."""
    context = spark.sparkContext
    if not getattr(context, "_pedalmill_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="pedalmill-"), "pedalmill"), "zip",
                                      root, "pedalmill")
        context.addPyFile(archive)
        context._pedalmill_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) may fall back to a fresh temporary folder;
    on a cluster a machine-local path would be invisible to other executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="pedalmill-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and continue from the written copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


@contextmanager
def wide_projections(spark: SparkSession) -> Iterator[None]:
    """For jobs whose rows have many computed columns: code beyond 8,000 bytes, which the JVM does not optimise, is cut into
    methods instead of being fused into one."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Sizes of the tables a plan reads. Unlike the estimate of a join, they do not multiply;
    inputs of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < UNKNOWN_BYTES)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_LIMIT_BYTES,
                   max_rows: int = BROADCAST_LIMIT_ROWS) -> bool:
    """True when ``df`` is proven small: by the estimate, else by a bounded count of its rows and bytes.

    The count runs only where reading the inputs is cheap.
    """
    if estimated_bytes(df) <= max_bytes:
        return True
    if input_bytes(df) > COUNT_LIMIT_BYTES:
        return False
    # text of a row as JSON is about as long as the row, or longer; fields take 16 bytes beside their contents
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + 16 * len(df.columns)
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def heavy_hashes(facts: DataFrame, keys: list[str], share: float = HEAVY_SHARE) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows, from one scan of the key columns.

    A frequent-items sketch of bounded size finds them; a few slightly lighter keys may be among them. Never more
    than about ``1/share``.
    """
    kept = int(2 / share)
    number = F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("number")
    found = facts.dropna(subset=keys).select(number).agg(
        F.expr(f"approx_top_k(number, {kept}, {4 * kept})").alias("top"), F.count(F.lit(1)).alias("rows")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["rows"]]


def split_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str,
               share: float = HEAVY_SHARE) -> DataFrame:
    """Join in one scan of the facts, with heavy keys spread over all tasks.

    Facts of a heavy key get a salt, and the few lookup rows of these keys (at most about ``1/share``) a copy per salt. Facts
    with a NULL key match nothing and are spread too. All rows are kept as ``how`` demands.
    """
    spark = facts.sparkSession
    heavy = heavy_hashes(facts, keys, share)
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    number = F.xxhash64(*[F.col(f"`{k}`").cast(facts.schema[k].dataType) for k in keys])
    hot = number.isin(heavy) if heavy else F.lit(False)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    salted = facts.withColumn("__salt", F.when(known & ~hot, F.lit(0)).otherwise(spread))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(dim.withColumn("__salt", F.explode(copies)), [*keys, "__salt"], how).drop("__salt")


def lookup_join(facts: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left",
                max_bytes: int = BROADCAST_LIMIT_BYTES,
                max_rows: int = BROADCAST_LIMIT_ROWS) -> DataFrame:
    """Join facts to a lookup table, whatever its size and however skewed the facts.

    A proven-small lookup is broadcast, so the facts do not move. Beyond that the
    join is split by :func:`split_join`: one key that holds a third of the facts
    never ends up in one task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join keeps fact rows, so how={how!r} is not supported")
    if fits_broadcast(dim, max_bytes, max_rows):
        return facts.join(F.broadcast(dim), keys, how)
    return split_join(facts, dim, keys, how)


def same_rows_union(parts: list[DataFrame]) -> DataFrame:
    """Union all by column name, filling columns some parts lack with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
