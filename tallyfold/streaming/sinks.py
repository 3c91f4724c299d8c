"""Idempotent sinks keyed by the micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"


def change_log(path: str) -> Callable[[DataFrame, int], None]:
    """Keeps each batch's changed rows in a folder of its own.

    A repeated batch overwrites its folder, so retries leave no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    return write


def current_state(spark: SparkSession, path: str, keys: list[str], schema) -> DataFrame:
    """Newest row of every key in a change log."""
    log = spark.read.schema(schema).option("basePath", path).parquet(path)
    values = [f.name for f in schema.fields if f.name not in keys and f.name != BATCH]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(BATCH)).alias("_v"))
    return newest.select(*keys, "_v.*")


def snapshots(path: str, build: Callable[[DataFrame], DataFrame] | None = None
              ) -> Callable[[DataFrame, int], None]:
    """Writes every batch as version ``batch_id``; readers take the newest.

    A one-row note of the version follows its data, so a reader never opens a
    version whose files are still being moved into place.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = build(batch) if build else batch
        out.write.mode("overwrite").parquet(f"{path}/data/version={batch_id}")
        note_done(batch.sparkSession, path, batch_id)
    return write


def note_done(spark: SparkSession, path: str, version: int) -> None:
    """Tells readers that all files of a version are in place."""
    note = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    note.coalesce(1).write.mode("overwrite").parquet(f"{path}/done/batch={version}")


def newest_version(spark: SparkSession, path: str) -> int:
    """The latest finished version."""
    return spark.read.schema("version bigint").parquet(f"{path}/done").agg(F.max("version")).first()[0]


def newest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest finished version."""
    return spark.read.parquet(f"{path}/data/version={newest_version(spark, path)}")


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
          mode: str = "update", seconds: int | None = None) -> StreamingQuery:
    """Run a stream over everything available now and return when done; ``seconds`` may limit the wait."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError(f"stream not finished after {seconds} s")
    finally:
        if query.isActive:
            query.stop()
    return query


def follow(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
           mode: str = "update", interval: str = "1.2 seconds") -> StreamingQuery:
    """Keep a stream running with a fixed trigger interval."""
    return (stream.writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(processingTime=interval).start())
