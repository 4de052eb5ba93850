"""Ledger of file versions: which raw files were read, in which version, and where their rows are.

The ledger is an append-only log below an output folder. A commit is a Parquet folder that is written under another
name and then renamed; the rename fails if a commit of that number is there already, so of two writers one
wins and the other learns of it. Readers see whole commits only. Every ``COMPACT_EVERY`` commits the current state is
written as a checkpoint, from which later reads start.

An entry names a file by its path, with length, time of change, MD5 of its bytes, schema family, what became of it
(``processed``, ``unknown_header``, ``superseded``) and the ``part`` of the output that holds its rows (NULL: none).
The last entry of a path counts. Rows of parts that no entry names are not part of the table, so rows become
visible with the commit and those of an earlier version vanish with it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fits_broadcast
from . import manifest

SCHEMA = ("system string, path string, file_name string, length long, modified timestamp, md5 string, family string, "
          "status string, part string, run_id string, commit long")
COMPACT_EVERY = 20
#: Bytes of a file that are held while it is hashed.
HASH_BYTES = 8 << 20


class CommitConflict(RuntimeError):
    """Another writer committed the same number first; plan again from the new state."""


def _md5(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = []
        for uri in pdf["path"]:
            digest = hashlib.md5()
            with manifest.open_stream(uri) as stream:
                while chunk := stream.read(HASH_BYTES):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield pdf.assign(md5=found)


def hashes(files: DataFrame) -> DataFrame:
    """``path`` and ``md5`` of files of any size, hashed in tasks."""
    paths = files.select("path")
    tasks = max(1, min(256, files.sparkSession.sparkContext.defaultParallelism))
    return paths.repartition(tasks).mapInPandas(_md5, "path string, md5 string")


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.path = f"{self.root}/_ledger"  # readers of the output pass over names that begin with an underscore

    def _numbers(self, kind: str) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removeprefix(f"{kind}-")) for n in names if n.startswith(f"{kind}-"))

    def last(self) -> int:
        """Number of the last commit, 0 for none."""
        return max(self._numbers("commit"), default=0)

    def entries(self) -> DataFrame:
        """The last checkpoint and all later commits."""
        start = max(self._numbers("checkpoint"), default=0)
        paths = [f"{self.path}/checkpoint-{start:012d}"] if start else []
        paths += [f"{self.path}/commit-{n:012d}" for n in self._numbers("commit") if n > start]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def state(self, system: str | None = None) -> DataFrame:
        """The last entry of every path."""
        rows = self.entries()
        rows = rows if system is None else rows.filter(F.col("system") == system)
        last = rows.groupBy("system", "path").agg(F.max_by(F.struct(*rows.columns), "commit").alias("entry"))
        return last.select("entry.*")

    def _publish(self, rows: DataFrame, name: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        hidden = f"{self.path}/_new-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(hidden)
        source, target = jvm.org.apache.hadoop.fs.Path(hidden), jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), conf).rename(source, target, plain)
        except Exception as e:
            source.getFileSystem(conf).delete(source, True)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(name) from None
            raise

    def commit(self, entries: DataFrame, number: int) -> None:
        """Append ``entries`` as commit ``number``, which must be the one after the last that was read."""
        rows = entries.withColumn("commit", F.lit(number).cast("long"))
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        self._publish(rows.select(*names), f"commit-{number:012d}")
        if number % COMPACT_EVERY == 0:
            self.compact()

    def compact(self) -> None:
        """Write the current state as a checkpoint."""
        number = self.last()
        if number and number not in self._numbers("checkpoint"):
            self._publish(self.state(), f"checkpoint-{number:012d}")

    def drop_parts(self, parts: DataFrame) -> None:
        """Delete the folders of parts that are out of the table; one path pattern per part."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        top = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = top.getFileSystem(conf)
        for row in parts.select("part").distinct().toLocalIterator():
            for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/*/*/part={row['part']}")) or []:
                fs.delete(found.getPath(), True)


def plan(files: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """``files`` with ``md5`` and what to do: ``new``, ``changed``, ``touched`` (another time, the same bytes) or ``unchanged``.

    Files with the length and time of their entry are not opened. Others are hashed in tasks, once. A file that
    a different status takes out or in (``status``) counts as changed; ``force`` takes every file again.
    """
    known = state.select("path", *[F.col(c).alias(f"old_{c}") for c in ("length", "modified", "md5", "status", "part")])
    both = files.join(known, "path", "left")
    same = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified"))
    settled = same & (F.col("status") == F.col("old_status")) & F.lit(not force)
    both = both.withColumn("settled", F.coalesce(settled, F.lit(False)))
    found = both.join(hashes(both.filter(~F.col("settled"))), "path", "left")
    action = (F.when(F.col("settled"), "unchanged").when(F.col("old_status").isNull(), "new").when(F.lit(force), "changed")
              .when((F.col("md5") == F.col("old_md5")) & (F.col("status") == F.col("old_status")), "touched").otherwise("changed"))
    return found.withColumn("action", action).withColumn("md5", F.coalesce("md5", "old_md5")).drop("settled")


def live_rows(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Rows of the parts that the ledger of ``root`` names; all rows where ``root`` keeps no parts."""
    if "part" not in rows.columns:
        return rows
    parts = Ledger(spark, root).state().filter("part IS NOT NULL").select("part").distinct()
    return rows.join(F.broadcast(parts) if fits_broadcast(parts) else parts, "part", "left_semi")
