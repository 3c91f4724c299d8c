import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyfold.schema import EVENT_SCHEMA
from tallyfold.streaming import feeds, flushes, live, progress, sinks, stores, surges


def event(i, state, district, kind, count, minute=0):
    return {"event_id": f"E{i}", "timestamp": f"2024-01-01T00:{minute:02d}:00Z", "state": state, "district": district,
            "primary_type": kind, "incident_count": count}


EVENTS = [event(1, "Bihar", "Patna", "THEFT", 3, 1), event(2, "Bihar", "Patna", "ROBBERY", 2, 2),
          event(3, "Delhi", "New Delhi", "THEFT", 5, 3)]


def feed(tmp_path, batches):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, events in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
    return str(folder)


def static(spark, events):
    rows = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    return feeds.decode_events(rows)


def test_batch_totals_and_tie(spark):
    e = static(spark, EVENTS)
    assert e.count() == 3
    assert {r.primary_type: r.incidents for r in live.type_totals(e).collect()} == {"THEFT": 8, "ROBBERY": 2}
    top = [(r.district, r.live_incident_count) for r in live.top_places(live.place_totals(e)).collect()]
    assert top == [("Patna", 5), ("New Delhi", 5)]


def test_defaults_for_missing_fields(spark):
    e = static(spark, [{"event_id": "x"}])
    assert tuple(live.place_totals(e).first()) == ("UNKNOWN", "UNKNOWN", 1)
    assert tuple(live.type_totals(e).first()) == ("OTHER", 1)


def test_malformed_lines_do_not_stop_the_feed(spark, tmp_path):
    folder = feed(tmp_path, [[EVENTS[0], "{not json"]])
    log = str(tmp_path / "log")
    totals = live.type_totals(feeds.file_events(spark, folder))
    sinks.drain(totals, str(tmp_path / "cp"), sinks.change_log(log))
    assert {r.primary_type: r.incidents for r in spark.read.parquet(log).collect()} == {"THEFT": 3}
    assert [r.value for r in feeds.undecodable(spark.read.text(folder)).collect()] == ["{not json"]


def test_document_over_batches_and_restart(spark, tmp_path):
    folder = feed(tmp_path, [EVENTS[:1], EVENTS[1:2]])
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = feeds.file_events(spark, folder, files_per_trigger=1)
    sinks.drain(stream, cp, live.LiveDocument(out), "append")
    # A later file continues the same totals from the checkpoint.
    (tmp_path / "in" / "2.json").write_text(json.dumps(EVENTS[2]) + "\n")
    document = live.LiveDocument(out)
    sinks.drain(feeds.file_events(spark, folder, files_per_trigger=1), cp, document, "append")
    snap = json.loads(spark.read.text(f"{out}/snapshot/version=2").first()[0])
    assert snap["total_events_consumed"] == 3 and snap["events_per_second"] == 1.0
    kinds = spark.read.json(f"{out}/crime_type_breakdown/version=2").collect()
    assert {r.primary_type: r.incidents for r in kinds} == {"THEFT": 8, "ROBBERY": 2}
    assert sinks.newest_version(spark, out) == 2
    assert [d["district"] for d in snap["top_live_districts"]] == ["Patna", "New Delhi"]
    assert snap["last_updated"].startswith("2024-01-01T00:03")
    assert [e["event_id"] for e in snap["recent_events"]] == ["E3", "E2", "E1"]
    assert [r.event_id for r in document.recent.rows(spark, 2).collect()] == ["E3", "E2"]
    # documents that no reader needs are gone
    assert stores.finished(spark, f"{out}/snapshot") == [1, 2]


def test_repeated_batch_leaves_no_duplicates(spark, tmp_path):
    out = str(tmp_path / "out")
    write = live.LiveDocument(out)
    write(static(spark, EVENTS), 0)
    write(static(spark, EVENTS), 0)
    assert write.logs["summary"].state(spark).first()["total_events_consumed"] == 3
    assert write.recent.rows(spark).count() == 3


@pytest.mark.parametrize("merge", ["added", "latest"])
def test_log_is_compacted_and_bounded(spark, tmp_path, merge):
    path = str(tmp_path / "log")
    rule = stores.latest(["k"]) if merge == "latest" else stores.added(["k"], v="sum")
    log = stores.CompactedLog(path, rule, every=3)
    want, rows = {}, None
    for i in range(9):
        rows = [(i % 4, i), (9, 1)]
        for _ in range(2 if i in (2, 5, 6) else 1):  # batches that come twice, at a base and beside one
            log(spark.createDataFrame(rows, "k int, v long"), i)
        for k, v in rows:
            want[k] = v if merge == "latest" else want.get(k, 0) + v
        assert {r.k: r.v for r in log.state(spark).collect()} == want
        assert len(stores.finished(spark, f"{path}/base")) <= 2 and len(stores.finished(spark, f"{path}/delta")) <= 6
    # a reader that asks for an older batch still held gets its state
    assert {r.k: r.v for r in log.state(spark, 7).collect()} != want


def test_base_without_its_note_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    log = stores.CompactedLog(path, stores.added([], v="sum"), every=100)
    for i in range(3):
        log(spark.createDataFrame([(1,)], "v long"), i)
    # a base whose writer stopped half-way
    spark.createDataFrame([(99,)], "v long").write.parquet(f"{path}/base/version=1")
    (tmp_path / "log" / "base" / "version=1" / "_SUCCESS").unlink()
    assert log.state(spark).first()["v"] == 3


def test_ring_buffer_keeps_the_best(spark, tmp_path):
    ring = stores.RingBuffer(str(tmp_path / "ring"), 3, [F.desc("x")])
    for i, values in enumerate([[1, 5], [], [4], [9, 2, 8, 7]]):
        for _ in range(1 + (i == 2)):
            ring(spark.createDataFrame([(v,) for v in values], "x int"), i)
    assert [r.x for r in ring.rows(spark).collect()] == [9, 8, 7] and [r.x for r in ring.rows(spark, 1).collect()] == [9]
    assert [r.x for r in ring.rows(spark, up_to=2).collect()] == [5, 4, 1]
    assert stores.finished(spark, str(tmp_path / "ring")) == [2, 3]
    empty = stores.RingBuffer(str(tmp_path / "none"), 3, [F.desc("x")])
    assert empty.rows(spark, schema=ring.rows(spark).schema).count() == 0


def test_flush_by_count(spark, tmp_path):
    flusher = flushes.CountFlusher(str(tmp_path / "flush"), 4, ["x"])
    batches = [[5, 3], [], [1, 2, 9, 8, 7, 6, 0], [4, 4]]
    for i, values in enumerate(batches):
        for _ in range(1 + (i == 2)):  # comes twice
            flusher(spark.createDataFrame([(v,) for v in values], "x int").repartition(3), i)
    flusher.finish(spark)
    flusher.finish(spark)
    got = {}
    for r in flusher.flushed(spark).collect():
        got.setdefault(r.flush, []).append(r.x)
    assert {k: sorted(v) for k, v in got.items()} == {0: [0, 1, 3, 5], 1: [2, 6, 7, 8], 2: [4, 4, 9]}


def test_progress_is_kept_as_rows(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "progress"), together=2)
    spark.streams.addListener(log)
    try:
        folder = feed(tmp_path, [EVENTS[:1], EVENTS[1:2], EVENTS[2:]])
        stream = progress.observed(feeds.file_events(spark, folder, files_per_trigger=1))
        query = sinks.drain(stream, str(tmp_path / "cp"), lambda batch, i: batch.count(), "append")
        assert log.wait(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    row = progress.operational_rate(log.rows()).first()
    assert (row.input_rows, row.observed_events) == (3, 3) and row.rows_per_second > 0


def test_json_stream_out_and_in_again(spark, tmp_path):
    folder = feed(tmp_path, [EVENTS[:2], EVENTS[2:]])
    out = str(tmp_path / "lines")
    writer = feeds.to_files(feeds.file_events(spark, folder, files_per_trigger=1), out, str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start().awaitTermination()
    (tmp_path / "in" / "3.json").write_text("{broken\n")
    good = stores.CompactedLog(str(tmp_path / "good"), stores.latest(["event_id"]))
    bad = stores.CompactedLog(str(tmp_path / "bad"), stores.latest(["value"]))
    broken = F.when(F.col("value").contains("E2"), F.substring("value", 1, 20)).otherwise(F.col("value"))
    raw = feeds.raw_lines(spark, out).select(broken.alias("value"))
    sinks.drain(raw, str(tmp_path / "cp2"), feeds.split_sink(good, bad), "append")
    assert sorted(r.event_id for r in good.state(spark).collect()) == ["E1", "E3"]
    assert bad.state(spark).count() == 1


def test_complete_mode_equals_batch(spark, tmp_path):
    folder = feed(tmp_path, [EVENTS[:2], EVENTS[2:]])
    path = str(tmp_path / "snap")
    sinks.drain(live.place_totals(feeds.file_events(spark, folder, files_per_trigger=1)), str(tmp_path / "cp"),
                sinks.snapshots(path), "complete")
    want = {tuple(r) for r in live.place_totals(static(spark, EVENTS)).collect()}
    assert {tuple(r) for r in sinks.newest_snapshot(spark, path).collect()} == want


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    path = str(tmp_path / "snap")
    write = sinks.snapshots(path)
    write(spark.range(3).select("id"), 0)
    # Data of the next version without its note, as left by a writer that stopped.
    spark.range(9).select("id").write.parquet(f"{path}/data/version=1")
    assert sinks.newest_snapshot(spark, path).count() == 3
    write(spark.range(5).select("id"), 1)
    assert sinks.newest_snapshot(spark, path).count() == 5


def test_json_encoding_round_trip(spark):
    e = static(spark, EVENTS)
    back = feeds.decode_events(feeds.encode_events(e))
    assert back.schema == EVENT_SCHEMA and sorted(back.collect()) == sorted(e.collect())


def hourly(spark, counts, place="P"):
    start = dt.datetime(2024, 1, 1)
    rows = [(f"{place}{i}", start + dt.timedelta(days=i), "S", place, None, "T", c, None) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_surge_needs_history_and_spread(spark):
    flat = surges.surge_alerts(hourly(spark, [10] * 6 + [90]))
    assert flat.count() == 0
    early = surges.surge_alerts(hourly(spark, [1, 2, 900]))
    assert early.count() == 0
    spike = surges.surge_alerts(hourly(spark, [10, 12, 10, 12, 10, 12, 11, 60])).collect()
    assert [(r.current_rate, r.severity) for r in spike] == [(60, "CRITICAL")]
    past = [10, 12, 10, 12, 10, 12, 11]
    mean = sum(past) / 7
    spread = (sum(x * x for x in past) / 7 - mean * mean) ** 0.5
    assert spike[0].z_score == pytest.approx(round((60 - mean) / spread, 2))


def random_feed(seed, days=24, places=3):
    """Events in order of time, several a day, with days without any."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    times = sorted((d * 86400 + rng.randrange(86400), p) for p in range(places) for d in range(days)
                   for _ in range(rng.choice([0, 1, 2, 2]) if d % 9 else 14))
    return [(f"E{i:04d}", start + dt.timedelta(seconds=s), "S", f"P{p}", None, "T", rng.randint(1, 3), None) for i, (s, p) in enumerate(times)]


@pytest.mark.parametrize("kind", ["chained", "stored"])
def test_streamed_surges_equal_the_batch_form(spark, tmp_path, kind):
    rows = random_feed(5)
    log = stores.CompactedLog(str(tmp_path / "log"), stores.latest(["window_start", "state", "district"]), 2)
    sink = log if kind == "chained" else surges.SurgeHistory(str(tmp_path / "windows"), log)

    def build(events):
        if kind == "chained":
            return surges.preceding_surges(events)
        return surges.windowed_counts(events, "1 day", "1 hour")

    def twice(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1:
            sink(batch, batch_id)

    folder = str(tmp_path / "in")
    for at in range(0, len(rows), 90):
        spark.createDataFrame(rows[at:at + 90], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = feeds.table_events(spark, folder, "*.parquet", EVENT_SCHEMA)
        sinks.drain(build(stream), str(tmp_path / "cp"), twice, "append")
    closed = rows[-1][1] - dt.timedelta(hours=1, days=1)
    batch = surges.surge_alerts(spark.createDataFrame(rows, EVENT_SCHEMA), by_time=kind == "chained").where(
        F.col("window_start") <= F.lit(closed))
    got = log.state(spark, schema=batch.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(got.columns).collect())) and batch.count() > 2


def test_closed_windows_are_evaluated_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    day = dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(days=k), "S", f"P{p}", 5 + k % 2 + 90 * (k == 9)) for k in range(10) for p in range(3)]
    closed = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(seen),
                                   "window_start timestamp, state string, district string, current_rate bigint")
    alerts = stores.RingBuffer(str(tmp_path / "alerts"), 10, surges.alert_order())
    surges.SurgeHistory(str(tmp_path / "windows"), alerts)(closed, 0)
    assert read.value == len(rows)
    assert sorted(r.district for r in alerts.rows(spark).collect()) == ["P0", "P1", "P2"]
    assert spark.read.parquet(str(tmp_path / "windows" / "version=0")).count() == 3 * 7


def test_chained_state_is_bounded(spark, tmp_path):
    rows = random_feed(6, days=60, places=1)
    folder = str(tmp_path / "in")
    query = None
    for at in range(0, len(rows), 50):
        spark.createDataFrame(rows[at:at + 50], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        query = sinks.drain(surges.preceding_surges(feeds.table_events(spark, folder, "*.parquet", EVENT_SCHEMA)),
                            str(tmp_path / "cp"), lambda batch, i: batch.count(), "append")
    # open windows, open histories and windows that may still meet: none grows with the days
    assert all(op["numRowsTotal"] < 80 for op in query.lastProgress["stateOperators"])


def test_surge_ratio(spark):
    df = spark.createDataFrame([(65, 50), (10, 1)], "live_incident_count bigint, last_count bigint")
    assert [(r.baseline, r.is_surge) for r in surges.surge_ratio(df).collect()] == [(13.0, 1), (18.0, 0)]


def test_throughput_counts(spark):
    got = surges.throughput(static(spark, EVENTS), "1 hour", 3600).collect()
    assert [(r.events, r.events_per_second) for r in got] == [(3, round(3 / 3600, 6))]


def test_window_state_is_bounded(spark, tmp_path):
    """Windows older than the watermark leave the state."""
    early = [event(i, "S", "D", "T", 1, i) for i in range(3)]
    late = [dict(event(9, "S", "D", "T", 1), timestamp="2024-01-09T00:00:00Z")]
    last = [dict(event(10, "S", "D", "T", 1), timestamp="2024-01-10T00:00:00Z")]
    folder = feed(tmp_path, [early, late, last])
    query = sinks.drain(surges.windowed_counts(feeds.file_events(spark, folder, files_per_trigger=1), "1 day", "1 hour"),
                        str(tmp_path / "cp"), sinks.change_log(str(tmp_path / "log")))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_replay_cap(spark):
    assert [r.event_id for r in feeds.replay(static(spark, EVENTS), 2).collect()] == ["E1", "E2"]


def test_place_key(spark):
    assert live.place_names(static(spark, EVENTS[:1])).select("place").first()[0] == "Bihar::Patna"
    assert static(spark, EVENTS).filter(F.col("timestamp").isNull()).count() == 0


def test_timed_trigger(spark, tmp_path):
    folder = feed(tmp_path, [EVENTS])
    log = str(tmp_path / "log")
    query = sinks.follow(live.type_totals(feeds.file_events(spark, folder)), str(tmp_path / "cp"),
                         sinks.change_log(log), interval="1 second")
    try:
        query.processAllAvailable()
        assert {r.primary_type: r.incidents for r in spark.read.parquet(log).collect()} == {"THEFT": 8, "ROBBERY": 2}
    finally:
        query.stop()
