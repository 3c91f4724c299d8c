"""What a stream keeps between batches: compacted logs and bounded buffers in shared folders.

A version's folder counts once Spark has put its success note there, so a reader never opens
one whose files are still being moved. Folders that no reader can need are removed, so a
store stays as large as its state however long the stream runs. A repeated batch replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def finished(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished folders ``<name>=<number>`` below a path, ascending."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    names = [s.getPath() for s in files.listStatus(top) if s.isDirectory()]
    return sorted(int(p.getName().split("=")[1]) for p in names
                  if "=" in p.getName() and files.exists(hadoop.Path(p, "_SUCCESS")))


def remove(spark: SparkSession, path: str) -> None:
    """A folder with all below it; nothing if it is not there."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(top, True)


def latest(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: the newest row of every key."""
    def merge(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*keys, BATCH)]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(BATCH)).alias("_v"))
        return newest.select(*keys, "_v.*")
    return merge


def added(keys: list[str], **measures: str) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: measures put together by ``sum``, ``min`` or ``max``, per key."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[getattr(F, how)(c).alias(c) for c, how in measures.items()])
    return merge


class CompactedLog:
    """Batches as deltas, merged into a new base every ``every`` batches.

    The base in force is the newest finished one; readers take it and the deltas after
    it. Once a base is finished, the deltas it holds and all bases but the one before it go.
    Readers that started on that one still find its files and the deltas after it.
    """

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame], every: int = 20):
        self.path, self.merge, self.every = path, merge, every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= max(finished(spark, f"{self.path}/base"), default=-1):
            return  # repeated, and held by the base already
        batch.write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self.compact(spark, batch_id)

    def _parts(self, spark: SparkSession, up_to: int | None) -> tuple[int, list[int]]:
        known = finished(spark, f"{self.path}/delta")
        bases = [b for b in finished(spark, f"{self.path}/base") if up_to is None or b <= up_to]
        base = max(bases, default=-1)
        return base, [d for d in known if d > base and (up_to is None or d <= up_to)]

    def state(self, spark: SparkSession, up_to: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """All batches (up to one) merged. Without any, no rows of ``schema``."""
        base, deltas = self._parts(spark, up_to)
        folders = [(f"{self.path}/base/version={base}", base)] if base >= 0 else []
        folders += [(f"{self.path}/delta/batch={d}", d) for d in deltas]
        if not folders:
            if schema is None:
                raise ValueError(f"nothing was written to {self.path} yet")
            return spark.createDataFrame([], schema)
        shape = schema or spark.read.parquet(folders[0][0]).schema
        rows = None
        if base >= 0:
            rows = spark.read.schema(shape).parquet(folders[0][0]).withColumn(BATCH, F.lit(base).cast("long"))
        if deltas:
            read = spark.read.schema(shape).parquet(*[f for f, n in folders if n > base])
            number = F.regexp_extract(F.col("_metadata.file_path"), "/delta/batch=([0-9]+)/", 1).cast("long")
            new = read.withColumn(BATCH, number)
            rows = new if rows is None else rows.unionByName(new)
        return self.merge(rows)

    def compact(self, spark: SparkSession, up_to: int) -> None:
        """A base of everything up to a batch, and the removal of what it replaces."""
        before = [b for b in finished(spark, f"{self.path}/base") if b < up_to]
        self.state(spark, up_to).write.mode("overwrite").parquet(f"{self.path}/base/version={up_to}")
        for b in before[:-1]:
            remove(spark, f"{self.path}/base/version={b}")
        for d in finished(spark, f"{self.path}/delta"):
            if before and d <= before[-1]:
                remove(spark, f"{self.path}/delta/batch={d}")


class RingBuffer:
    """The first ``kept`` rows by ``order`` of all batches, a folder a version.

    A version is the best of the one before it and its batch, so a repeated batch gives the same
    rows again. The version before stays for readers that opened it; older ones go.
    """

    def __init__(self, path: str, kept: int, order: list[Column]):
        self.path, self.kept, self.order = path, kept, order

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in finished(spark, self.path) if v < batch_id]
        rows = batch
        if before:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{self.path}/version={before[-1]}"))
        rows.orderBy(*self.order).limit(self.kept).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
        for v in before[:-1]:
            remove(spark, f"{self.path}/version={v}")

    def rows(self, spark: SparkSession, shown: int | None = None, schema: T.StructType | None = None,
             up_to: int | None = None) -> DataFrame:
        """The newest version's rows (up to a batch), the first ``shown`` of them."""
        known = [v for v in finished(spark, self.path) if up_to is None or v <= up_to]
        if not known:
            if schema is None:
                raise ValueError(f"nothing was written to {self.path} yet")
            return spark.createDataFrame([], schema)
        read = spark.read if schema is None else spark.read.schema(schema)
        rows = read.parquet(f"{self.path}/version={known[-1]}").orderBy(*self.order)
        return rows if shown is None else rows.limit(shown)
