"""Running sums over a whole table, in parallel.

The table is sorted by ranges over all tasks. Every task sums its rows in order; one total per task goes to the
driver, which turns them into offsets; the offsets are broadcast. No window runs without keys, and a value that
many rows share is split by the rest of the order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable, ship_package


def _summer(value: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = np.cumsum(np.nan_to_num(batch.column(value).to_numpy(zero_copy_only=False)), dtype=None) + before
            before = sums[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sums), task, np.int32)), pa.array(sums)],
                                             [*batch.schema.names, "__task", "__sum"])
    return run


def running_sum(df: DataFrame, value: str, order: Sequence[str | Column], out: str = "running") -> DataFrame:
    """``df`` with the sum of ``value`` (a long or a double, NULL counts as 0) over all rows up to and with each in ``order``.

    The order should be one of all rows; rows that are equal in it come in any order.
    """
    ship_package(df.sparkSession)
    kind = "double" if df.schema[value].dataType.simpleString() in ("double", "float") else "long"
    numbered = df.withColumn("__value", F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields)
    ordered = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    summed = durable(ordered.mapInArrow(_summer(len(numbered.columns) - 1), f"{schema}, __task int, __sum {kind}"))
    totals = {r["__task"]: r["total"] for r in summed.groupBy("__task").agg(F.sum("__value").alias("total")).toLocalIterator()}
    tasks = sorted(totals)
    before = [0, *accumulate(totals[t] for t in tasks)][:len(tasks)]
    zero = 0.0 if kind == "double" else 0
    offsets = df.sparkSession.createDataFrame([(t, zero + b) for t, b in zip(tasks, before)], f"__task int, __before {kind}")
    return (summed.join(F.broadcast(offsets), "__task").withColumn(out, F.col("__sum") + F.col("__before"))
            .select(*df.columns, out))
