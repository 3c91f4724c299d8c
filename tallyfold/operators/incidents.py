"""Yearly counts turned into typed incident events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.constants import EVENT_COUNT_CAP, EVENT_TYPES
from tallyfold.functions.hashing import stable_bucket
from tallyfold.operators.ordering import number_in_order
from tallyfold.schema import DISTRICT, EVENT_SCHEMA, STATE, YEAR
from tallyfold.session import scratch_path


def unpivot_heads(facts: DataFrame, heads: list[str] | None = None,
                  cap: int | None = EVENT_COUNT_CAP) -> DataFrame:
    """One row per place, year and head with a positive count."""
    long = facts.unpivot([STATE, DISTRICT, YEAR], heads or EVENT_TYPES, "primary_type", "n")
    count = F.least(F.col("n"), F.lit(cap)) if cap is not None else F.col("n")
    return long.filter(F.col("n") > 0).select(
        F.col(STATE).alias("state"), F.col(DISTRICT).alias("district"),
        F.col(YEAR).alias("year"), "primary_type", count.cast("bigint").alias("incident_count"))


def incident_events(facts: DataFrame, prefix: str = "EV-", first: int = 100001,
                    buckets: int = 4096) -> DataFrame:
    """Unpivoted events with gapless, reproducible ids.

    Events are numbered by (hash bucket of the key, key) in ranges over all tasks, however many buckets there are.
    """
    key = ["state", "district", "year", "primary_type"]
    hashed = unpivot_heads(facts).withColumn("_bucket", stable_bucket(buckets, *[F.col(k) for k in key]))
    numbered, _ = number_in_order(hashed, ["_bucket", *key], "_n", scratch_path(facts.sparkSession, "numbered-events"), first)
    return numbered.withColumn("event_id", F.concat(F.lit(prefix), F.col("_n"))).drop("_n", "_bucket")


def as_feed(events: DataFrame, source: str, at: Column | None = None) -> DataFrame:
    """Events in the shape of the feed: with a time (now, if none is given) and the name of their source."""
    stamp = F.current_timestamp() if at is None else at.cast("timestamp")
    named = events.withColumns({"timestamp": stamp, "source": F.lit(source), "year": F.col("year").cast("int"),
                                "state": F.trim("state"), "district": F.trim("district")})
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])
