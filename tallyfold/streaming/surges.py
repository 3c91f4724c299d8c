"""Throughput windows, baselines and surge alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.ordering import top_within
from tallyfold.streaming.live import with_event_defaults
from tallyfold.streaming.stores import finished, remove


def throughput(events: DataFrame, width: str = "1 hour", seconds: int = 3600,
               lateness: str | None = None) -> DataFrame:
    """Events per window and per second. ``lateness`` bounds a stream's state."""
    timed = events.withWatermark("timestamp", lateness) if lateness else events
    counted = timed.groupBy(F.window("timestamp", width).alias("w")).agg(
        F.count(F.lit(1)).alias("events"))
    return counted.select(F.col("w.start").alias("window_start"), "events",
                          F.round(F.col("events").cast("double") / seconds, 6).alias("events_per_second"))


def windowed_counts(events: DataFrame, width: str = "1 day", lateness: str | None = None) -> DataFrame:
    """Incidents per place and window."""
    timed = with_event_defaults(events)
    if lateness:
        timed = timed.withWatermark("timestamp", lateness)
    return (timed.groupBy(F.window("timestamp", width).alias("w"), "state", "district")
            .agg(F.sum("incident_count").alias("current_rate"))
            .select(F.col("w.start").alias("window_start"), "state", "district", "current_rate"))


def _severity(z: Column, warning: float, critical: float) -> Column:
    return F.when(z >= critical, F.lit("CRITICAL")).when(z >= warning, F.lit("WARNING"))


def _moments(values: str, count: str, squares: str):
    mean = F.col(values).cast("double") / F.col(count)
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col(squares).cast("double") / F.col(count) - mean * mean))
    return mean, spread


def score_surges(rated: DataFrame, warning: float = 2.5, critical: float = 3.0) -> DataFrame:
    """Alerts of windows whose rate stands out from ``baseline_mean`` and ``_std``.

    Places without spread raise none.
    """
    z = F.try_divide(F.col("current_rate") - F.col("baseline_mean"), F.col("baseline_std"))
    scored = rated.withColumn("z_score", F.round(z, 2)).withColumn("baseline_mean", F.round("baseline_mean", 1))
    alerts = scored.withColumn("severity", _severity(F.col("z_score"), warning, critical))
    return alerts.filter(F.col("severity").isNotNull()).select(
        "window_start", "state", "district", "current_rate", "baseline_mean", "z_score", "severity",
        F.concat(F.lit("Statistical Surge ("), F.col("severity"), F.lit("): "), F.col("current_rate"),
                 F.lit(" incidents in "), "district").alias("message"))


def _rated(past: DataFrame, at_least: int) -> DataFrame:
    """Rows with ``_n``, ``_s`` and ``_q`` of enough windows before them, as means and spreads."""
    mean, spread = _moments("_s", "_n", "_q")
    return past.filter(F.col("_n") >= at_least).withColumns({"baseline_mean": mean, "baseline_std": spread})


def _with_past(counts: DataFrame, by) -> DataFrame:
    return counts.withColumns({
        "_n": F.count("current_rate").over(by), "_s": F.sum("current_rate").over(by),
        "_q": F.sum(F.col("current_rate") * F.col("current_rate")).over(by)})


def surge_alerts(events: DataFrame, width: str = "1 day", history: int = 7, at_least: int = 3,
                 warning: float = 2.5, critical: float = 3.0, by_time: bool = False) -> DataFrame:
    """Windows compared with the same place's preceding windows (batch form).

    Events are summed per place and window first; the row window then holds one
    row per time window. Whole-number sums make the moments independent of order. The
    preceding windows are the last ``history`` in which the place had events; with ``by_time``
    those of the last ``history`` window widths, of which some may be empty.
    """
    counts = windowed_counts(events, width)
    by = Window.partitionBy("state", "district")
    if by_time:
        seconds = _seconds(width)
        by = by.orderBy(F.unix_seconds("window_start")).rangeBetween(-history * seconds, -1)
    else:
        by = by.orderBy("window_start").rowsBetween(-history, -1)
    return score_surges(_rated(_with_past(counts, by), at_least), warning, critical)


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(width: str) -> int:
    """Seconds of a window width like ``"1 day"``."""
    number, unit = width.split()
    return int(number) * _UNITS[unit.removesuffix("s")]


def preceding_surges(events: DataFrame, width: str = "1 day", history: int = 7, at_least: int = 3,
                     lateness: str = "1 hour", warning: float = 2.5, critical: float = 3.0) -> DataFrame:
    """Surges of a stream against the windows before them, in one query of chained stateful operators.

    Incidents are counted per window; closed windows feed a second, sliding window of ``history`` widths that adds
    up their number, sum and squares; and a window meets the history that ends where it begins in a stream-stream join.
    The watermark reaches all three: their state is the open windows, the open histories, and the
    windows that may still meet one. Append mode only. Equal to ``surge_alerts(by_time=True)`` over all windows
    that are closed when the stream stops.
    """
    seconds = _seconds(width)

    def counts():
        timed = with_event_defaults(events).withWatermark("timestamp", lateness)
        return timed.groupBy(F.window("timestamp", width).alias("w"), "state", "district").agg(
            F.sum("incident_count").alias("current_rate"))

    now = counts().select(
        F.window_time("w").alias("_closed"), F.col("w.start").alias("window_start"), "state", "district", "current_rate")
    span = F.window(F.window_time("w"), f"{history * seconds} seconds", f"{seconds} seconds").alias("h")
    past = counts().groupBy(span, F.col("state").alias("_state"), F.col("district").alias("_district")).agg(
        F.count("current_rate").alias("_n"), F.sum("current_rate").alias("_s"),
        F.sum(F.col("current_rate") * F.col("current_rate")).alias("_q")).select(
        F.window_time("h").alias("_ended"), F.col("h.end").alias("_until"), "_state", "_district", "_n", "_s", "_q")
    # the same moment as an equal key and as a bound on event time: the first finds, the second frees the state
    step = F.expr(f"interval {seconds} seconds")
    met = now.join(past, (F.col("state") == F.col("_state")) & (F.col("district") == F.col("_district"))
                   & (F.col("window_start") == F.col("_until"))
                   & (F.col("_ended") >= F.col("_closed") - step) & (F.col("_ended") <= F.col("_closed") - step))
    return score_surges(_rated(met, at_least), warning, critical)


class SurgeHistory:
    """Batch function over closed windows that keeps the last ``history`` of every place.

    Takes ``windowed_counts`` of a stream in append mode. Each batch's windows are compared with the kept ones and with each
    other, alerts go to ``sink``, and the last windows of every place are stored as the batch's version. Whatever gaps a place
    has, the alerts are those of ``surge_alerts`` over all closed windows. A repeated batch starts from the
    version before it.
    """

    def __init__(self, path: str, sink: Callable[[DataFrame, int], None], history: int = 7, at_least: int = 3,
                 warning: float = 2.5, critical: float = 3.0):
        self.path, self.sink, self.history, self.at_least = path, sink, history, at_least
        self.limits = warning, critical

    def __call__(self, closed: DataFrame, batch_id: int) -> None:
        spark = closed.sparkSession
        before = [v for v in finished(spark, self.path) if v < batch_id]
        rows = closed.withColumn("_new", F.lit(True))
        if before:
            kept = spark.read.schema(closed.schema).parquet(f"{self.path}/version={before[-1]}")
            rows = rows.unionByName(kept.withColumn("_new", F.lit(False)))
        by = Window.partitionBy("state", "district").orderBy("window_start").rowsBetween(-self.history, -1)
        # Alerts and the last windows are two actions: kept, the batch's state is read and stored once, and its rows shuffled once.
        placed = _with_past(rows, by).persist()
        try:
            self.sink(score_surges(_rated(placed.where("_new"), self.at_least), *self.limits), batch_id)
            last = top_within(placed, ["state", "district"], [F.desc("window_start")], self.history, "_nth")
            last.select(*closed.columns).write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
        finally:
            placed.unpersist()
        for v in before[:-1]:
            remove(spark, f"{self.path}/version={v}")


def baseline_table(events: DataFrame, width: str = "1 day", at_least: int = 3) -> DataFrame:
    """Mean and spread of every place's windows, for the streaming form."""
    sums = windowed_counts(events, width).groupBy("state", "district").agg(
        F.count("current_rate").alias("_n"), F.sum("current_rate").alias("_s"),
        F.sum(F.col("current_rate") * F.col("current_rate")).alias("_q"))
    mean, spread = _moments("_s", "_n", "_q")
    return sums.filter(F.col("_n") >= at_least).select(
        "state", "district", mean.alias("baseline_mean"), spread.alias("baseline_std"))


def live_surges(events: DataFrame, baseline: DataFrame, width: str = "1 day",
                lateness: str | None = "1 hour", warning: float = 2.5, critical: float = 3.0) -> DataFrame:
    """Windowed rates of a stream against a stored baseline.

    The stream-static join keys on the place; state is only the open windows.
    """
    rated = windowed_counts(events, width, lateness).join(baseline, ["state", "district"])
    return score_surges(rated, warning, critical)


def surge_ratio(totals: DataFrame, limit: float = 2.2) -> DataFrame:
    """Simple baseline ``max(4, n mod 30 + 8)`` of a running count, and the surge test."""
    base = F.greatest(F.lit(4.0), F.pmod(F.col("live_incident_count"), F.lit(30)) + F.lit(8.0))
    ratio = F.col("last_count").cast("double") / base
    return totals.withColumns({
        "baseline": base, "surge_ratio": F.round(ratio, 4), "is_surge": (ratio > limit).cast("int")})


def recent_alerts(alerts: DataFrame, shown: int = 6) -> DataFrame:
    """Latest alerts, newest first, strongest first within a window."""
    return alerts.orderBy(*alert_order()).limit(shown)


def alert_order() -> list[Column]:
    """Newest first, the strongest first within a window."""
    return [F.desc("window_start"), F.desc("z_score"), F.asc("state"), F.asc("district")]
