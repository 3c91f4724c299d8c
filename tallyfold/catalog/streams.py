"""Streams over the event table, drained to their end and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.catalog.checks import over_incidents, r
from tallyfold.catalog.registry import Query
from tallyfold.plans import trade
from tallyfold.session import scratch_path
from tallyfold.streaming import feeds, flushes, live, progress, sinks, stores, surges

#: Parts of the event table's time that arrive one after the other; the batch in which one repeats.
ARRIVALS = 3
REPEATED = 1
FLUSH_SIZE = 200
BATCHES_PER_BASE = 2
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _schema(spark, folder):
    return trade.table(spark, folder, "events").schema


def _stream(spark, folder):
    """The event table's files as a stream."""
    return trade.as_incidents(feeds.table_events(spark, folder, "events.parquet", _schema(spark, folder)))


def _arrivals(spark, folder, wanted=lambda events: events):
    """A folder into which the event table comes in equal spans of time, handed on after each."""
    events = trade.table(spark, folder, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    path = scratch_path(spark, "arrivals")
    for k in range(ARRIVALS):
        part = F.floor((at - low) * ARRIVALS / (high - low + 1))
        wanted(events.where(part == k)).write.mode("append").parquet(path)
        yield path


def _drain_arrivals(spark, folder, *steps):
    """Every step (frame of events to stream, batch function, output mode) over each arrival, each with a checkpoint."""
    steps = [(build, sink, mode, scratch_path(spark, "checkpoint")) for build, sink, mode in steps]
    for path in _arrivals(spark, folder):
        for build, sink, mode, checkpoint in steps:
            events = trade.as_incidents(feeds.table_events(spark, path, "*.parquet", _schema(spark, folder)))
            sinks.drain(build(events), checkpoint, sink, mode)


def _with_repeat(sink):
    """``sink`` that is given one batch twice, as after a failure."""
    def write(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == REPEATED:
            sink(batch, batch_id)
    return write


def _drained(spark, stream, keys, mode="update"):
    log, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "checkpoint")
    kept = stores.CompactedLog(log, stores.latest(keys), BATCHES_PER_BASE)
    sinks.drain(stream, checkpoint, kept, mode)
    return kept.state(spark, schema=stream.schema)


def _place_totals(spark, folder):
    log = stores.CompactedLog(scratch_path(spark, "log"), stores.latest(["state", "district"]), BATCHES_PER_BASE)
    _drain_arrivals(spark, folder, (live.place_totals, _with_repeat(log), "update"))
    return log.state(spark)


def _timed_totals(spark, folder):
    """Totals of a stream that flushes by the clock, over what has come until then."""
    log = stores.CompactedLog(scratch_path(spark, "log"), stores.latest(["state", "district"]), BATCHES_PER_BASE)
    checkpoint = scratch_path(spark, "checkpoint")
    query = None
    try:
        for path in _arrivals(spark, folder):
            if query is None:
                events = trade.as_incidents(feeds.table_events(spark, path, "*.parquet", _schema(spark, folder)))
                query = sinks.follow(live.place_totals(events), checkpoint, _with_repeat(log), interval="1.2 seconds")
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    return log.state(spark)


def _type_totals(spark, folder):
    return _drained(spark, live.type_totals(_stream(spark, folder)), ["primary_type"])


def _summary(spark, folder):
    stream = live.feed_summary(_stream(spark, folder)).withColumn("feed", F.lit("all"))
    out = _drained(spark, stream, ["feed"])
    return out.select("feed", "total_events_consumed", F.date_format("stream_started_at", STAMP).alias("stream_started_at"),
                      F.date_format("last_updated", STAMP).alias("last_updated"))


def _top_places(spark, folder):
    path = scratch_path(spark, "top_places")
    top = live.top_places(live.place_totals(_stream(spark, folder)))
    sinks.drain(top, scratch_path(spark, "checkpoint"), sinks.snapshots(path), "complete")
    return sinks.newest_snapshot(spark, path)


_runs: dict[tuple[str, str], live.LiveDocument] = {}


def refresh() -> None:
    """Forgets the streams that have run, so that changed tables are read again."""
    _runs.clear()


def _live_run(spark, folder):
    """The live document over all arrivals and the alerts beside it, run once per session and source."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _runs:
        path = scratch_path(spark, "live")
        alerts = stores.RingBuffer(f"{path}/alerts", 10, surges.alert_order())
        history = surges.SurgeHistory(f"{path}/windows", alerts)
        document = live.LiveDocument(f"{path}/document", every=BATCHES_PER_BASE, alerts=alerts)
        _drain_arrivals(spark, folder, (_closed_windows, _with_repeat(history), "append"),
                        (lambda events: events, _with_repeat(document), "append"))
        _runs[key] = document
    return _runs[key]


def _closed_windows(events):
    return surges.windowed_counts(events, "1 day", "1 hour")


DOCUMENT = """total_events_consumed bigint, events_per_second double,
  top_live_districts array<struct<state: string, district: string, live_incident_count: bigint>>,
  recent_events array<struct<event_id: string>>,
  active_anomalies array<struct<window_start: timestamp, state: string, district: string, z_score: double>>"""


def _document(spark, folder):
    run = _live_run(spark, folder)
    version = sinks.newest_version(spark, run.path)
    return run, version, spark.read.schema(DOCUMENT).json(f"{run.path}/snapshot/version={version}")


def _snapshot(spark, folder):
    run, version, newest = _document(spark, folder)
    top = newest.select("total_events_consumed", F.inline("top_live_districts")).select(
        "total_events_consumed", F.concat_ws("::", "state", "district").alias("name"),
        F.col("live_incident_count").alias("incidents"))
    kinds = spark.read.schema("primary_type string, incidents bigint").json(
        f"{run.path}/crime_type_breakdown/version={version}").withColumnRenamed("primary_type", "name")
    # The document is one row, so the join pairs it with the counts.
    total = newest.select("total_events_consumed", F.lit(1).alias("_one"))
    return top.unionByName(kinds.withColumn("_one", F.lit(1)).join(total, "_one").drop("_one"))


def _live_document(spark, folder):
    """Rate, recent events and alerts of the document, a row each."""
    newest = _document(spark, folder)[2]
    rate = newest.select(F.lit("rate").alias("section"), F.lit(0).alias("place"), F.lit("").alias("name"), F.col("events_per_second").alias("amount"))
    events = newest.select(F.posexplode("recent_events").alias("place", "e")).select(
        F.lit("event").alias("section"), "place", F.col("e.event_id").alias("name"), F.lit(None).cast("double").alias("amount"))
    alerts = newest.select(F.posexplode("active_anomalies").alias("place", "a")).select(
        F.lit("alert").alias("section"), "place",
        F.concat_ws("::", F.date_format("a.window_start", "yyyy-MM-dd"), "a.state", "a.district").alias("name"),
        F.col("a.z_score").alias("amount"))
    return rate.unionByName(events).unionByName(alerts)


SNAPSHOT_SQL = over_incidents("""SELECT (SELECT count(*) FROM incidents) AS total_events_consumed, * FROM (
  (SELECT state || '::' || district AS name, CAST(sum(incident_count) AS BIGINT) AS incidents
   FROM incidents GROUP BY state, district ORDER BY incidents DESC, state, district LIMIT 20)
  UNION ALL (SELECT primary_type, CAST(sum(incident_count) AS BIGINT) FROM incidents GROUP BY primary_type))""")


def _flush_sums(spark, folder):
    """Events and incidents of every flush of two hundred, over several arrivals and one repeated."""
    def sums(events):
        return live.with_event_defaults(events).groupBy("flush").agg(
            F.count(F.lit(1)).alias("events"), F.sum("incident_count").alias("incidents"))

    flusher = flushes.CountFlusher(scratch_path(spark, "flushes"), FLUSH_SIZE, ["timestamp", "event_id"], sums)
    _drain_arrivals(spark, folder, (lambda events: events, _with_repeat(flusher), "append"))
    flusher.finish(spark)
    return flusher.flushed(spark)


def _flushed(spark, folder):
    return _flush_sums(spark, folder).agg(F.count(F.lit(1)).alias("flushes"), F.sum("events").cast("bigint").alias("events"))


def _recent(spark, folder):
    return _live_run(spark, folder).recent.rows(spark, 12).select("event_id", F.date_format("timestamp", STAMP).alias("at"))


def _live_recent_alerts(spark, folder):
    return _hour(_live_run(spark, folder).alerts.rows(spark, 6))


def _streamed_alerts(spark, folder):
    """Alerts of every closed window against the place's last windows, kept by batch."""
    log = stores.CompactedLog(scratch_path(spark, "log"), stores.latest(["window_start", "state", "district"]), BATCHES_PER_BASE)
    history = surges.SurgeHistory(scratch_path(spark, "windows"), log)
    _drain_arrivals(spark, folder, (_closed_windows, _with_repeat(history), "append"))
    return _hour(log.state(spark))


def _preceding(spark, folder):
    log = stores.CompactedLog(scratch_path(spark, "log"), stores.latest(["window_start", "state", "district"]), BATCHES_PER_BASE)
    _drain_arrivals(spark, folder, (surges.preceding_surges, _with_repeat(log), "append"))
    return _hour(log.state(spark))


def _progress(spark, folder):
    """What the feed's queries reported: rows that came in, and events that were observed."""
    log = progress.ProgressLog(spark, scratch_path(spark, "progress"))
    spark.streams.addListener(log)
    try:
        checkpoint, runs = scratch_path(spark, "checkpoint"), []
        for path in _arrivals(spark, folder):
            events = trade.as_incidents(feeds.table_events(spark, path, "*.parquet", _schema(spark, folder)))
            query = sinks.drain(progress.observed(events), checkpoint, lambda batch, i: batch.agg(F.count(F.lit(1))).collect(), "append")
            runs.append(str(query.runId))
        for run in runs:
            if not log.wait(run):
                raise TimeoutError(f"no report of the end of {run}")
    finally:
        spark.streams.removeListener(log)
    return progress.operational_rate(log.rows()).select(
        "input_rows", "observed_events", (F.col("rows_per_second") > 0).alias("has_rate"))


def _json_streams(spark, folder):
    """Events written as a stream of JSON lines, some broken on the way, and read as a stream again."""
    lines, written, read = (scratch_path(spark, x) for x in ("lines", "checkpoint", "checkpoint"))
    good = stores.CompactedLog(scratch_path(spark, "events"), stores.latest(["event_id"]), BATCHES_PER_BASE)
    bad = stores.CompactedLog(scratch_path(spark, "broken"), stores.added(["value"], n="sum"), BATCHES_PER_BASE)
    split = _with_repeat(feeds.split_sink(good, lambda batch, i: bad(batch.groupBy("value").agg(F.count(F.lit(1)).alias("n")), i)))
    for path in _arrivals(spark, folder):
        events = trade.as_incidents(feeds.table_events(spark, path, "*.parquet", _schema(spark, folder)))
        breaks = F.col("event_id").cast("long") % 50 == 0
        query = feeds.to_files(events.withColumn("source", F.when(breaks, "BROKEN").otherwise(F.col("source"))), lines, written)
        query.trigger(availableNow=True).start().awaitTermination()
        raw = feeds.raw_lines(spark, lines)
        cut = F.when(F.col("value").contains('"BROKEN"'), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
        sinks.drain(raw.select(cut.alias("value")), read, split, "append")
    kinds = live.type_totals(good.state(spark))
    broken = bad.state(spark).agg(F.lit("broken lines").alias("primary_type"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("incidents"))
    return kinds.unionByName(broken)


def _throughput(spark, folder):
    stream = surges.throughput(_stream(spark, folder), "1 hour", 3600, "1 hour")
    return _hour(_drained(spark, stream, ["window_start"]))


def _hour(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


ALERT_COLUMNS = ["window_start", "state", "district", "current_rate", "baseline_mean", "z_score", "severity", "message"]
SCORED = f"""scored AS (SELECT *, {r('(current_rate - mean) / spread', 2)} AS z_score FROM rated WHERE spread > 0),
alerts AS (SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, state, district, current_rate,
  {r('mean', 1)} AS baseline_mean, z_score,
  CASE WHEN z_score >= 3.0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  'Statistical Surge (' || CASE WHEN z_score >= 3.0 THEN 'CRITICAL' ELSE 'WARNING' END || '): '
    || current_rate || ' incidents in ' || district AS message
  FROM scored WHERE z_score >= 2.5)"""
COUNTED = """counted AS (SELECT date_trunc('day', "timestamp") AS w, state, district,
  CAST(sum(incident_count) AS BIGINT) AS current_rate FROM incidents GROUP BY ALL)"""
MOMENTS = """CAST(s AS DOUBLE) / n AS mean,
  sqrt(greatest(0.0, CAST(q AS DOUBLE) / n - (CAST(s AS DOUBLE) / n) * (CAST(s AS DOUBLE) / n))) AS spread"""
PAST = f"""{COUNTED}, past AS (SELECT *, count(current_rate) OVER p AS n, CAST(sum(current_rate) OVER p AS BIGINT) AS s,
  CAST(sum(current_rate * current_rate) OVER p AS BIGINT) AS q FROM counted
  WINDOW p AS (PARTITION BY state, district ORDER BY w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
rated AS (SELECT *, {MOMENTS} FROM past WHERE n >= 3), {SCORED}"""
FIRST_HALF = "2024-01-16"
STORED = f"""{COUNTED}, sums AS (SELECT state, district, count(*) AS n, CAST(sum(current_rate) AS BIGINT) AS s,
  CAST(sum(current_rate * current_rate) AS BIGINT) AS q FROM counted WHERE w < TIMESTAMP '{FIRST_HALF}' GROUP BY ALL),
base AS (SELECT state, district, {MOMENTS} FROM sums WHERE n >= 3),
rated AS (SELECT c.*, mean, spread FROM counted c JOIN base b ON c.state = b.state AND c.district = b.district), {SCORED}"""


#: Windows that are closed for a stream with an hour's lateness once all events have come.
CLOSED = """w + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM incidents) - INTERVAL 1 HOUR"""
TIMED = PAST.replace("ORDER BY w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING",
                     "ORDER BY w RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING")
PLACED = f"""SELECT *, row_number() OVER (ORDER BY "timestamp", CAST(event_id AS VARCHAR)) - 1 AS place FROM incidents"""
ARRIVED = f"""SELECT *, (epoch_us("timestamp") - min(epoch_us("timestamp")) OVER ()) * {ARRIVALS}
  // (max(epoch_us("timestamp")) OVER () - min(epoch_us("timestamp")) OVER () + 1) AS part FROM incidents"""
DOCUMENT_SQL = f"""SELECT 'rate' AS section, 0 AS place, '' AS name,
  {r("CAST(count(*) AS DOUBLE) / greatest(1.0, CAST(max(epoch_us(t)) - min(epoch_us(t)) AS DOUBLE) / 1000000)", 4)} AS amount
  FROM (SELECT "timestamp" AS t, part FROM ({ARRIVED})) WHERE part = {ARRIVALS - 1}
UNION ALL SELECT 'event', CAST(n AS INTEGER), event_id, NULL FROM (SELECT event_id, row_number() OVER (ORDER BY "timestamp" DESC, event_id DESC) - 1 AS n
  FROM incidents) WHERE n < 12
UNION ALL SELECT 'alert', CAST(n AS INTEGER), window_start[1:10] || '::' || state || '::' || district, z_score FROM (
  SELECT *, row_number() OVER (ORDER BY window_start DESC, z_score DESC, state, district) - 1 AS n FROM alerts WHERE closed) WHERE n < 6"""
CLOSED_ALERTS = f"SELECT {', '.join(ALERT_COLUMNS)} FROM alerts WHERE closed"


def _marked(prepared):
    """The alerts' SQL with a column that says whether a stream has closed the window."""
    return prepared.replace("SELECT strftime(w,", f"SELECT {CLOSED} AS closed, strftime(w,")


def _alerts(spark, folder):
    return surges.surge_alerts(trade.incidents(spark, folder))


def _live_alerts(spark, folder):
    before = trade.incidents(spark, folder).filter(F.col("timestamp") < F.lit(FIRST_HALF).cast("timestamp"))
    stream = surges.live_surges(_stream(spark, folder), surges.baseline_table(before))
    return _hour(_drained(spark, stream, ["window_start", "state", "district"]))


def _ratios(spark, folder):
    events = live.with_event_defaults(trade.incidents(spark, folder))
    last = F.struct("timestamp", "event_id")
    totals = events.groupBy("state", "district").agg(
        F.sum("incident_count").alias("live_incident_count"), F.max_by("incident_count", last).alias("last_count"))
    return surges.surge_ratio(totals)


QUERIES = [
    Query("live_place_totals", "ST1 P22", _place_totals, over_incidents(
        "SELECT state, district, CAST(sum(incident_count) AS BIGINT) AS live_incident_count FROM incidents "
        "GROUP BY state, district")),
    Query("live_type_totals", "ST2", _type_totals, over_incidents(
        "SELECT primary_type, CAST(sum(incident_count) AS BIGINT) AS incidents FROM incidents GROUP BY primary_type")),
    Query("live_summary", "ST3 S11", _summary, over_incidents(
        "SELECT 'all' AS feed, count(*) AS total_events_consumed, "
        "strftime(min(\"timestamp\"), '%Y-%m-%d %H:%M:%S.%f') AS stream_started_at, "
        "strftime(max(\"timestamp\"), '%Y-%m-%d %H:%M:%S.%f') AS last_updated FROM incidents")),
    Query("live_top_places", "K5 S14", _top_places, over_incidents(
        "SELECT state, district, CAST(sum(incident_count) AS BIGINT) AS live_incident_count FROM incidents "
        "GROUP BY state, district ORDER BY live_incident_count DESC, state, district LIMIT 20")),
    Query("live_snapshot", "ST4 S9 S14", _snapshot, SNAPSHOT_SQL),
    Query("live_document", "ST4 ST7 ST8 ST11", _live_document, over_incidents(DOCUMENT_SQL, _marked(PAST))),
    Query("flushed_batches", "ST5", _flushed,
          f"SELECT (count(*) + {FLUSH_SIZE - 1}) // {FLUSH_SIZE} AS flushes, count(*) AS events FROM events"),
    Query("flush_sums", "ST5", _flush_sums, over_incidents(
        f"SELECT CAST(place // {FLUSH_SIZE} AS BIGINT) AS flush, count(*) AS events, CAST(sum(incident_count) AS BIGINT) AS incidents "
        f"FROM ({PLACED}) GROUP BY 1")),
    Query("timed_totals", "ST6 ST1", _timed_totals, over_incidents(
        "SELECT state, district, CAST(sum(incident_count) AS BIGINT) AS live_incident_count FROM incidents "
        "GROUP BY state, district")),
    Query("stream_progress", "ST8", _progress,
          "SELECT count(*) AS input_rows, count(*) AS observed_events, count(*) > 0 AS has_rate FROM events"),
    Query("json_streams", "S11 S13", _json_streams, over_incidents(
        "SELECT primary_type, CAST(sum(incident_count) AS BIGINT) AS incidents FROM incidents WHERE CAST(event_id AS BIGINT) % 50 <> 0 "
        "GROUP BY primary_type UNION ALL SELECT 'broken lines', count(*) FROM incidents WHERE CAST(event_id AS BIGINT) % 50 = 0")),
    Query("recent_events", "ST7", _recent, over_incidents(
        "SELECT event_id, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') AS at FROM incidents "
        "ORDER BY \"timestamp\" DESC, event_id DESC LIMIT 12")),
    Query("throughput_windows", "ST8", _throughput, over_incidents(
        f"""SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, events,
          {r('CAST(events AS DOUBLE) / 3600', 6)} AS events_per_second
        FROM (SELECT date_trunc('hour', "timestamp") AS w, count(*) AS events FROM incidents GROUP BY ALL)""")),
    Query("surge_alerts", "ST9", lambda s, d: _hour(_alerts(s, d)), over_incidents(
        f"SELECT {', '.join(ALERT_COLUMNS)} FROM alerts", PAST)),
    Query("live_surge_alerts", "ST9", _live_alerts, over_incidents(
        f"SELECT {', '.join(ALERT_COLUMNS)} FROM alerts", STORED)),
    Query("streamed_surges", "ST9", _streamed_alerts, over_incidents(CLOSED_ALERTS, _marked(PAST))),
    Query("preceding_surges", "ST9", _preceding, over_incidents(CLOSED_ALERTS, _marked(TIMED))),
    Query("live_recent_alerts", "ST11 ST7", _live_recent_alerts, over_incidents(
        CLOSED_ALERTS + " ORDER BY window_start DESC, z_score DESC, state, district LIMIT 6", _marked(PAST))),
    Query("surge_ratio", "ST10", _ratios, over_incidents(
        f"""SELECT state, district, live_incident_count, last_count,
          greatest(4.0, live_incident_count % 30 + CAST(8 AS DOUBLE)) AS baseline,
          {r('CAST(last_count AS DOUBLE) / greatest(4.0, live_incident_count % 30 + CAST(8 AS DOUBLE))', 4)} AS surge_ratio,
          CAST(CAST(last_count AS DOUBLE) / greatest(4.0, live_incident_count % 30 + CAST(8 AS DOUBLE)) > 2.2 AS INTEGER)
            AS is_surge
        FROM (SELECT state, district, CAST(sum(incident_count) AS BIGINT) AS live_incident_count,
          arg_max(incident_count, ("timestamp", event_id)) AS last_count FROM incidents GROUP BY state, district)""")),
    Query("recent_alerts", "ST11", lambda s, d: _hour(surges.recent_alerts(_alerts(s, d))), over_incidents(
        f"SELECT {', '.join(ALERT_COLUMNS)} FROM alerts ORDER BY window_start DESC, z_score DESC, state, district LIMIT 6",
        PAST)),
]
