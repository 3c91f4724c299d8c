"""Dimension lookups with defaults."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.constants import (
    BOUNDARY_ALIASES, DEFAULT_REGION, DEMOGRAPHIC_DEFAULTS, POLICE_DEFAULTS, STATE_REGIONS,
)
from tallyfold.functions.text import name_key
from tallyfold.schema import DISTRICT, STATE, YEAR
from tallyfold.sources.literals import constant_table


def lookup(df: DataFrame, dim: DataFrame, keys: list[str], defaults: dict[str, object],
           names: list[str] | None = None, left: list[str] | None = None) -> DataFrame:
    """Left join on case-insensitive names, defaults where nothing matches.

    ``names`` are the keys compared as place names; the others compare as they
    are. ``left`` names columns that hold the keys in comparison form already, so
    that a partitioning by them is reused. The dimension is expected to have one
    row per key. No broadcast is forced: Spark compares its size with the
    threshold, and a hot key in the shuffled case is split by the adaptive skew
    join.
    """
    names = keys if names is None else names

    def norm(frame, key):
        return name_key(F.col(key)) if key in names else F.col(key)

    right = dim.select(*[norm(dim, k).alias(f"_k_{k}") for k in keys],
                       *[F.col(c).alias(f"_d_{c}") for c in defaults])
    temporary = []
    if left is None:
        left = temporary = [f"_l_{k}" for k in keys]
        df = df.withColumns(dict(zip(left, [norm(df, k) for k in keys])))
    on = reduce(lambda a, b: a & b, [F.col(a) == F.col(f"_k_{k}") for a, k in zip(left, keys)])
    joined = df.join(right, on, "left")
    return joined.withColumns({
        c: F.coalesce(F.col(f"_d_{c}"), F.lit(v)) for c, v in defaults.items()
    }).drop(*temporary, *[f"_k_{k}" for k in keys], *[f"_d_{c}" for c in defaults])


def with_demographics(df: DataFrame, dim: DataFrame, left: list[str] | None = None) -> DataFrame:
    return lookup(df, dim, [STATE, DISTRICT], DEMOGRAPHIC_DEFAULTS, left=left)


def with_police(df: DataFrame, dim: DataFrame, left: list[str] | None = None) -> DataFrame:
    return lookup(df, dim, [STATE, DISTRICT], POLICE_DEFAULTS, left=left)


def with_cyber(df: DataFrame, dim: DataFrame, left: list[str] | None = None) -> DataFrame:
    return lookup(df, dim, [STATE, DISTRICT, YEAR], {"CYBER_CRIMES": 0}, [STATE, DISTRICT], left)


def with_matches(df: DataFrame, dim: DataFrame, alias: str, defaults: dict[str, object],
                 left: list[str] | None = None) -> DataFrame:
    """Adds how many rows a place's ``lookup`` in ``dim`` gives for each row, without giving them; at least one.

    The columns of ``defaults`` are summed up over these rows, in decimals.
    """
    value = {c: F.coalesce(F.col(c), F.lit(v)).cast("decimal(28,6)") for c, v in defaults.items()}
    counts = dim.groupBy(*[name_key(F.col(k)).alias(k) for k in (STATE, DISTRICT)]).agg(
        F.count(F.lit(1)).alias(alias), *[F.sum(v).alias(c) for c, v in value.items()])
    return lookup(df, counts, [STATE, DISTRICT], {alias: 1, **{c: Decimal(str(v)) for c, v in defaults.items()}}, left=left)


def with_region(df: DataFrame, regions: DataFrame | None = None, state: str = STATE,
                default: str = DEFAULT_REGION) -> DataFrame:
    """Adds ``region``. ``regions`` has (state_key, region), upper-case keys."""
    if regions is None:
        # Written in the code, so its size is bounded.
        regions = F.broadcast(constant_table(
            df.sparkSession, ["state_key", "region"], list(STATE_REGIONS.items())))
    joined = df.join(regions, name_key(F.col(state)) == F.col("state_key"), "left")
    return joined.withColumn("region", F.coalesce("region", F.lit(default))).drop("state_key")


def boundary_key(df: DataFrame, column: str, alias: str = "state_key",
                 aliases: dict[str, str] | None = None) -> DataFrame:
    """Statistics spelling of a boundary name."""
    aliases = BOUNDARY_ALIASES if aliases is None else aliases
    dim = constant_table(df.sparkSession, ["_from", "_to"], list(aliases.items()))
    joined = df.join(F.broadcast(dim), name_key(F.col(column)) == F.col("_from"), "left")
    return joined.withColumn(alias, F.coalesce("_to", name_key(F.col(column)))).drop("_from", "_to")


def boundary_statistics(boundaries: DataFrame, stats: DataFrame, regions: DataFrame,
                        boundary: str, measures: list[str],
                        aliases: dict[str, str] | None = None) -> DataFrame:
    """Every boundary with its statistics, zeros and region ``Other`` if none."""
    keyed = boundary_key(boundaries, boundary, aliases=aliases)
    right = stats.select(F.col("state_key"), *measures)
    return (keyed.join(right, "state_key", "left").join(regions, "state_key", "left")
            .withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})
            .withColumn("region", F.coalesce("region", F.lit("Other"))))


def group_statistic(df: DataFrame, keys: list[str], statistic: Column, alias: str) -> DataFrame:
    """A statistic of each row's group next to the row; rows with null keys are a group as well."""
    stats = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(statistic.alias(alias))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return df.join(stats, same, "left").select(*keys, *[c for c in df.columns if c not in keys], alias)
