"""Seasonal and weekly distributions, apportioned and measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.constants import (
    DAY_WEIGHT, DAY_WEIGHTS, DAYS, NIGHT_HOURS, NIGHT_WEIGHT, REST_WEIGHT, SEASON_WEIGHTS,
    WORK_HOURS,
)


def apportion_seasons(totals: DataFrame, total: str = "total_crimes") -> DataFrame:
    """Seasonal shares of each row's total; the weights ride in the row."""
    seasons = F.array(*[F.struct(F.lit(n).alias("season"), F.lit(w).alias("weight"),
                                 F.lit(d).alias("description")) for n, w, d in SEASON_WEIGHTS])
    keep = [c for c in totals.columns if c != total]
    return totals.select(*keep, total, F.inline(seasons)).select(
        *keep, "season", F.floor(F.col(total) * F.col("weight")).alias("estimated_crimes"),
        F.round(F.col("weight") * 100, 1).alias("percentage"), "description")


def hour_weight(hour: Column) -> Column:
    return (F.when(hour.isin(*NIGHT_HOURS), NIGHT_WEIGHT)
            .when(hour.isin(*WORK_HOURS), DAY_WEIGHT).otherwise(REST_WEIGHT))


def apportion_week(totals: DataFrame, total: str = "total_crimes") -> DataFrame:
    """Expected count of every hour and weekday, from fixed weights."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    days = F.array(*[F.struct(F.lit(i).alias("day"), F.lit(n).alias("day_name"),
                              F.lit(w).alias("day_weight"))
                     for i, (n, w) in enumerate(zip(DAYS, DAY_WEIGHTS))])
    keep = [c for c in totals.columns if c != total]
    grid = totals.select(*keep, total, hours.alias("hour")).select(
        *keep, total, "hour", F.inline(days))
    value = F.floor(F.col(total) * hour_weight(F.col("hour")) * F.col("day_weight") / 52)
    return grid.select(*keep, "hour", F.format_string("%02d:00", "hour").alias("hour_label"),
                       "day", "day_name", value.alias("expected"))


def week_matrix(cells: DataFrame, value: str) -> DataFrame:
    """One row per hour with the seven weekday values as an array, Monday first."""
    by_day = [F.coalesce(F.sum(F.when(F.col("day") == d, F.col(value))), F.lit(0)).cast("bigint")
              for d in range(7)]
    return cells.groupBy("hour").agg(F.array(*by_day).alias("row"))


def measured_week(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Counted events per hour of day and weekday (0 = Monday)."""
    at = F.col(ts)
    return events.groupBy(F.hour(at).alias("hour"), F.weekday(at).alias("day")).agg(
        F.count(F.lit(1)).alias("events"))


def measured_seasons(facts: DataFrame, ts: str) -> DataFrame:
    """Counted rows per season of the year."""
    month = F.month(F.col(ts))
    names = [s for s, _, _ in SEASON_WEIGHTS]
    season = (F.when(month.isin(12, 1, 2), names[0]).when(month.between(3, 5), names[1])
              .when(month.between(6, 8), names[2]).otherwise(names[3]))
    return facts.groupBy(season.alias("season")).agg(F.count(F.lit(1)).alias("rows"))
