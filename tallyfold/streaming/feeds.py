"""Event sources and encoded sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyfold.schema import EVENT_SCHEMA


def decode_events(raw: DataFrame, schema=EVENT_SCHEMA, column: str = "value") -> DataFrame:
    """Event columns from a JSON text or byte column.

    Text that is no JSON object is no event and is left out (see ``undecodable``); a field of
    another type becomes null.
    """
    parsed = F.from_json(F.col(column).cast("string"), schema, {"mode": "PERMISSIVE"})
    return raw.filter(_is_object(column)).select(parsed.alias("_e")).select("_e.*")


def undecodable(raw: DataFrame, column: str = "value") -> DataFrame:
    """The rows that ``decode_events`` leaves out, as they came, to be kept in a place of their own."""
    return raw.filter(~_is_object(column))


def _is_object(column: str):
    text = F.col(column).cast("string")
    return F.coalesce(F.ltrim(text).startswith("{") & F.try_parse_json(text).isNotNull(), F.lit(False))


def encode_events(events: DataFrame) -> DataFrame:
    """Every event as JSON text in ``value``."""
    return events.select(F.to_json(F.struct("*")).alias("value"))


def broker_events(spark: SparkSession, servers: str, topic: str,
                  per_trigger: int | None = None) -> DataFrame:
    """Events from a Kafka topic, new ones only; offsets live in the checkpoint.

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "latest"))
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return decode_events(reader.load())


def to_broker(events: DataFrame, servers: str, topic: str, checkpoint: str,
              key: str = "state") -> DataStreamWriter:
    """Writer to a Kafka topic that waits for all replicas."""
    keyed = events.select(F.col(key).cast("string").alias("key"),
                          F.to_json(F.struct("*")).alias("value"))
    return (keyed.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("kafka.acks", "all").option("kafka.retries", 3)
            .option("checkpointLocation", checkpoint))


def file_events(spark: SparkSession, folder: str, schema=EVENT_SCHEMA,
                files_per_trigger: int | None = None) -> DataFrame:
    """Events from JSON-line files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode_events(reader.load(folder), schema)


def table_events(spark: SparkSession, folder: str, pattern: str, schema,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Rows of Parquet files matching a pattern as a stream."""
    reader = (spark.readStream.format("parquet").schema(schema)
              .option("pathGlobFilter", pattern))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def to_files(events: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Writer of a stream as JSON lines; Spark's file sink lists what is committed, so readers see every event once."""
    return (encode_events(events).writeStream.format("text").outputMode("append").option("path", folder)
            .option("checkpointLocation", checkpoint))


def raw_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files that arrive in a folder, not decoded yet."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def split_sink(good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None],
               schema=EVENT_SCHEMA) -> Callable[[DataFrame, int], None]:
    """Batch function over raw lines: decoded events to one sink, lines that are none to another, in the same batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good(decode_events(batch, schema), batch_id)
            bad(undecodable(batch), batch_id)
        finally:
            batch.unpersist()
    return write


def replay(events: DataFrame, cap: int = 5000, order: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """The first events of a stored feed, in order; a cap of a test run."""
    return events.orderBy(*order).limit(cap)
