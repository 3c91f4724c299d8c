"""A stream cut by number of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.ordering import number_in_order
from tallyfold.streaming.stores import finished, remove

FLUSH, PLACE = "flush", "place_in_feed"


class CountFlusher:
    """Hands on events in flushes of ``size``, in the order of arrival, the rest at the end.

    A batch's events follow those of the batches before it; within a batch ``order`` counts.
    A batch numbers its events from where the last one stopped, emits all full flushes and keeps
    the remainder, ``size - 1`` events at most, for the next one. ``build`` makes a flush's rows of events with
    their column ``flush`` (the events themselves, if none is given). Everything is kept by batch, so a repeated batch
    replaces its own flushes and remainder.
    """

    def __init__(self, path: str, size: int, order: list[str], build: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.size, self.order, self.build = path, size, order, build

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = finished(spark, f"{self.path}/rest")
        before = [n for n in known if n < batch_id]
        carried, start = None, 0
        if before:
            carried = spark.read.parquet(f"{self.path}/rest/batch={before[-1]}")
            start = spark.read.parquet(f"{self.path}/seen/batch={before[-1]}").first()["seen"]
        staged = f"{self.path}/staged/batch={batch_id}"
        numbered, count = number_in_order(batch, self.order, PLACE, staged, start)
        seen = start + count
        rows = numbered if carried is None else carried.unionByName(numbered)
        full = seen // self.size * self.size
        self._emit(rows.where(F.col(PLACE) < full).withColumn(FLUSH, F.floor(F.col(PLACE) / self.size).cast("long")), batch_id, "full")
        # the count first: a remainder is only read together with it
        spark.range(1).select(F.lit(seen).cast("long").alias("seen")).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/seen/batch={batch_id}")
        rows.where(F.col(PLACE) >= full).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/rest/batch={batch_id}")
        remove(spark, staged)
        for n in before[:-1]:
            remove(spark, f"{self.path}/rest/batch={n}")
            remove(spark, f"{self.path}/seen/batch={n}")

    def finish(self, spark: SparkSession) -> None:
        """The remainder as a last, smaller flush, once the stream has ended."""
        known = finished(spark, f"{self.path}/rest")
        if known:
            rest = spark.read.parquet(f"{self.path}/rest/batch={known[-1]}")
            self._emit(rest.withColumn(FLUSH, F.floor(F.col(PLACE) / self.size).cast("long")), known[-1], "last")

    def flushed(self, spark: SparkSession) -> DataFrame:
        """All flushes so far."""
        parts = [f"{self.path}/full/batch={n}" for n in finished(spark, f"{self.path}/full")]
        parts += [f"{self.path}/last/batch={n}" for n in finished(spark, f"{self.path}/last")]
        return spark.read.parquet(*parts)

    def _emit(self, events: DataFrame, batch_id: int, kind: str) -> None:
        rows = events.drop(PLACE)
        (self.build(rows) if self.build else rows).write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch_id}")
