"""Running totals and the live snapshot. All work on static frames as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.text import place_key
from tallyfold.sources.documents import write_json_lines
from tallyfold.streaming.sinks import note_done
from tallyfold.streaming.stores import CompactedLog, RingBuffer, added, finished, remove


def with_event_defaults(events: DataFrame) -> DataFrame:
    """Unknown places and types named, a missing count taken as one."""
    return events.withColumns({
        "state": F.coalesce("state", F.lit("UNKNOWN")),
        "district": F.coalesce("district", F.lit("UNKNOWN")),
        "primary_type": F.coalesce("primary_type", F.lit("OTHER")),
        "incident_count": F.coalesce(F.col("incident_count"), F.lit(1)).cast("bigint")})


def place_totals(events: DataFrame) -> DataFrame:
    return (with_event_defaults(events).groupBy("state", "district")
            .agg(F.sum("incident_count").alias("live_incident_count")))


def type_totals(events: DataFrame) -> DataFrame:
    return (with_event_defaults(events).groupBy("primary_type")
            .agg(F.sum("incident_count").alias("incidents")))


def feed_summary(events: DataFrame) -> DataFrame:
    """Number of events and the span of their times."""
    return events.agg(F.count(F.lit(1)).alias("total_events_consumed"),
                      F.min("timestamp").alias("stream_started_at"),
                      F.max("timestamp").alias("last_updated"))


def top_places(totals: DataFrame, k: int = 20) -> DataFrame:
    return totals.orderBy(F.desc("live_incident_count"), "state", "district").limit(k)


def live_snapshot(places: DataFrame, summary: DataFrame, k: int = 20) -> DataFrame:
    """One row: counters and the ``k`` busiest places. Types may be many, so they stay rows of their own."""
    top = top_places(places, k).agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("live_incident_count")).alias("_o"), "state", "district", "live_incident_count"
    ))).alias("_t")).select(F.transform("_t", lambda x: F.struct(
        x["state"].alias("state"), x["district"].alias("district"),
        x["live_incident_count"].alias("live_incident_count"))).alias("top_live_districts"),
        F.lit(1).alias("_one"))
    # One row each, so the join pairs two rows.
    return summary.withColumn("_one", F.lit(1)).join(top, "_one").drop("_one")


def recent_events(events: DataFrame, shown: int = 12) -> DataFrame:
    """Latest events, newest first."""
    return events.orderBy(*newest_first()).limit(shown)


def place_names(events: DataFrame) -> DataFrame:
    """Events with the combined place key."""
    return with_event_defaults(events).withColumn("place", place_key(F.col("state"), F.col("district")))


COMPACT_EVERY = 100
SNAPSHOT_LISTS = ("recent_events", "active_anomalies")


def newest_first() -> list:
    """Latest events first, by id where times are equal."""
    return [F.desc("timestamp"), F.desc("event_id")]


def feed_rate(events: DataFrame) -> DataFrame:
    """One row: events per second between the first and the last event of a batch, over a second at least."""
    seconds = F.greatest(F.lit(1.0), (F.max("timestamp").cast("double") - F.min("timestamp").cast("double")))
    return events.agg(F.round(F.count(F.lit(1)) / seconds, 4).alias("events_per_second"))


class LiveDocument:
    """Batch function that keeps a feed's totals, its recent events and one document of them all.

    Totals by place and type and the summary are compacted logs of batch sums, recent events a bounded
    buffer. A batch's document has the summary, the batch's rate, the ``k`` busiest places, the recent events shown and, where
    ``alerts`` names their buffer, the recent alerts. It is ``snapshot/version=<batch>``; counts by type, which may be many, are JSON
    lines in ``crime_type_breakdown/version=<batch>``. A note in ``done`` follows both; documents older than the one before it go.
    A repeated batch replaces its own part of everything.
    """

    def __init__(self, path: str, k: int = 20, kept: int = 25, shown: int = 12, every: int = COMPACT_EVERY,
                 alerts: RingBuffer | None = None, alerts_shown: int = 6):
        self.path, self.k, self.shown, self.alerts, self.alerts_shown = path, k, shown, alerts, alerts_shown
        self.logs = {
            "places": CompactedLog(f"{path}/places", added(["state", "district"], live_incident_count="sum"), every),
            "types": CompactedLog(f"{path}/types", added(["primary_type"], incidents="sum"), every),
            "summary": CompactedLog(f"{path}/summary", added(
                [], total_events_consumed="sum", stream_started_at="min", last_updated="max"), every)}
        self.recent = RingBuffer(f"{path}/recent", kept, newest_first())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            for name, part in (("places", place_totals(batch)), ("types", type_totals(batch)), ("summary", feed_summary(batch))):
                self.logs[name](part, batch_id)
            self.recent(batch, batch_id)
            rate = feed_rate(batch).first()[0]
        finally:
            batch.unpersist()
        state = {name: log.state(spark, batch_id) for name, log in self.logs.items()}
        document = live_snapshot(state["places"], state["summary"].withColumn("events_per_second", F.lit(rate)), self.k)
        document = document.withColumn("_one", F.lit(1))
        lists = [self.recent.rows(spark, self.shown, up_to=batch_id)]
        if self.alerts is not None:
            lists.append(self.alerts.rows(spark, self.alerts_shown))
        for name, rows in zip(SNAPSHOT_LISTS, lists):
            # A dozen rows at most, so one row holds them and the join pairs two rows.
            document = document.join(rows.agg(F.collect_list(F.struct("*")).alias(name)).withColumn("_one", F.lit(1)), "_one")
        write_json_lines(state["types"], f"{self.path}/crime_type_breakdown/version={batch_id}")
        write_json_lines(document.drop("_one"), f"{self.path}/snapshot/version={batch_id}")
        note_done(spark, self.path, batch_id)
        for folder in ("crime_type_breakdown", "snapshot"):
            for version in [v for v in finished(spark, f"{self.path}/{folder}") if v < batch_id][:-1]:
                remove(spark, f"{self.path}/{folder}/version={version}")
