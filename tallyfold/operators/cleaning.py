"""Row filters, deduplication and repair of fact rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.constants import STATE_ALIASES
from tallyfold.functions.numbers import parse_double, total_of
from tallyfold.functions.text import name_key, title_case
from tallyfold.schema import DISTRICT, HEADS, RECONCILED_HEADS, STATE, TOTAL, YEAR
from tallyfold.sources.literals import constant_table

SUBTOTAL_MARKS = ("TOTAL", "DELHI UT")


def drop_subtotals(df: DataFrame, district: str = DISTRICT,
                   marks: tuple[str, ...] = SUBTOTAL_MARKS) -> DataFrame:
    """Without empty district names and rows that sum up others."""
    name = name_key(F.col(district))
    keep = F.length(name) > 0
    for mark in marks:
        keep = keep & ~F.contains(name, F.lit(mark))
    return df.filter(keep)


def from_year(df: DataFrame, first: int = 2000, year: str = YEAR) -> DataFrame:
    return df.filter(F.col(year) >= first)


def normalize_states(df: DataFrame, column: str = STATE,
                     aliases: dict[str, str] | None = None) -> DataFrame:
    """Official state names; unknown ones in title case.

    The alias table is written in the code, so broadcasting it is bounded.
    """
    aliases = STATE_ALIASES if aliases is None else aliases
    spark = df.sparkSession
    dim = constant_table(spark, ["_alias", "_official"], list(aliases.items()))
    joined = df.join(F.broadcast(dim), name_key(F.col(column)) == F.col("_alias"), "left")
    return joined.withColumn(
        column, F.coalesce("_official", title_case(F.trim(F.col(column))))
    ).drop("_alias", "_official")


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of every key in the given order.

    ``row_number() = 1`` is pre-limited on each map task before the shuffle, so
    a key holding a large part of all rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def any_wins(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, whichever comes."""
    return df.dropDuplicates(keys)


def fill_missing(df: DataFrame, columns: list[str], value: int = 0) -> DataFrame:
    """Absent columns and missing values as ``value``."""
    have = set(df.columns)
    return df.withColumns({
        c: (F.coalesce(F.col(c), F.lit(value)) if c in have else F.lit(value)).cast("bigint")
        for c in columns})


def reconcile_total(df: DataFrame, heads: list[str] | None = None, total: str = TOTAL) -> DataFrame:
    """Total raised to the sum of its main heads where it falls short."""
    return df.withColumn(total, F.greatest(
        F.coalesce(F.col(total), F.lit(0)).cast("bigint"), total_of(heads or RECONCILED_HEADS)))


def all_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as numbers; a row with any unparsable one is left out.

    Missing and empty fields count as zero, as opposed to malformed ones.
    """
    def number(c: str) -> Column:
        text = F.trim(F.col(c).cast("string"))
        return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(parse_double(F.col(c)))

    parsed = df.withColumns({c: number(c) for c in columns})
    return parsed.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Sources stacked by column name, each row with its source's rank."""
    ranked = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def clean_facts(df: DataFrame, order: list, first_year: int = 2000,
                aliases: dict[str, str] | None = None) -> DataFrame:
    """Raw canonical rows to clean ones, without coordinates.

    ``order`` decides which of several rows of one (state, district, year)
    survives. ``STATE_RAW`` keeps the source spelling for the coordinate lookup.
    """
    kept = from_year(drop_subtotals(df), first_year)
    named = normalize_states(
        kept.withColumn("STATE_RAW", name_key(F.col(STATE)))
            .withColumn(DISTRICT, title_case(F.trim(F.col(DISTRICT)))),
        STATE, aliases)
    once = first_wins(named, [STATE, DISTRICT, YEAR], order)
    return reconcile_total(fill_missing(once, HEADS + [TOTAL]))
