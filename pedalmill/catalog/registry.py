"""Registration of queries with their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}

_CASTS = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}


def _plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, fractions as double, dates as text: what both sides share."""
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in _CASTS:
            col = col.cast(_CASTS[kind])
        elif kind.startswith("decimal"):
            col = col.cast("double")
        elif kind == "date":
            col = F.date_format(col, "yyyy-MM-dd")
        out.append(col.alias(name))
    return df.select(*out)


def query(*covers: str, sql: str | None = None, name: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under its own name."""
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain_types(fn(spark, sf_dir))

        QUERIES[key] = run
        COVERS[key] = covers
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return register


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is inferred once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def r(col: Column | str, places: int = 6) -> Column:
    return F.round(col, places)
