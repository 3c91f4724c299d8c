"""What running streams report about themselves, kept as rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tallyfold.streaming.stores import finished

PROGRESS = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("at", T.StringType()),
    T.StructField("input_rows", T.LongType()), T.StructField("input_rows_per_second", T.DoubleType()),
    T.StructField("processed_rows_per_second", T.DoubleType()), T.StructField("milliseconds", T.LongType()),
    T.StructField("observed_events", T.LongType())])
#: Name of the observation whose count is kept with the progress.
OBSERVED = "feed"


def observed(events: DataFrame) -> DataFrame:
    """``events`` with a count of its own that the progress of every batch carries."""
    return events.observe(OBSERVED, F.count(F.lit(1)).alias("events"))


class ProgressLog(StreamingQueryListener):
    """Stores a row for every batch of every query of the session, some at a time and the rest when a query ends.

    A batch that is repeated after a failure reports again; ``rows`` keeps one report per query and batch.
    """

    def __init__(self, spark: SparkSession, path: str, together: int = 100):
        self.spark, self.path, self.together = spark, path, together
        self.held: list[tuple] = []
        self.lock = threading.Lock()
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED)
        row = (str(p.id), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond,
               p.batchDuration, None if seen is None else seen["events"])
        with self.lock:
            self.held.append(row)
            full = len(self.held) >= self.together
        if full:
            self.store()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.store()
        self._end(str(event.runId)).set()

    def store(self) -> None:
        """What is held as a folder of its own."""
        with self.lock:
            held, self.held = self.held, []
            if held:
                number = max(finished(self.spark, self.path), default=-1) + 1
                self.spark.createDataFrame(held, PROGRESS).coalesce(1).write.parquet(f"{self.path}/part={number}")

    def wait(self, run: str, seconds: float = 60.0) -> bool:
        """Until the end of a run has been reported; reports arrive a little after the fact."""
        return self._end(run).wait(seconds)

    def rows(self) -> DataFrame:
        parts = [f"{self.path}/part={n}" for n in finished(self.spark, self.path)]
        if not parts:
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(*parts).groupBy("query", "batch_id").agg(
            F.max_by(F.struct(*PROGRESS.names[2:]), "at").alias("_v")).select("query", "batch_id", "_v.*")


def operational_rate(progress: DataFrame) -> DataFrame:
    """Rows, batches and rows per second of every query, over the time that its batches took."""
    return progress.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("observed_events").alias("observed_events"),
        F.try_divide(F.sum("input_rows") * 1000.0, F.sum("milliseconds")).alias("rows_per_second"))
