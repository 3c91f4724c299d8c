"""Numeric column expressions: parsing, shares, rates, clamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_double(value: Column) -> Column:
    """Text with optional thousands commas to double, null if unparsable.

    The pattern guard keeps out spellings the JVM parser alone would take,
    such as ``12d``.
    """
    text = F.trim(F.replace(value.cast("string"), F.lit(","), F.lit("")))
    return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))


def lenient_int(value: Column) -> Column:
    """Whole part of a number in text form; anything else counts as zero."""
    return F.coalesce(parse_double(value).try_cast("bigint"), F.lit(0).cast("bigint"))


def total_of(names: list[str]) -> Column:
    """Sum of columns with missing values taken as zero."""
    return reduce(lambda a, b: a + b,
                  [F.coalesce(F.col(n), F.lit(0)).cast("bigint") for n in names])


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Ratio to a total that is never below one."""
    return F.round(part.cast("double") / F.greatest(whole, F.lit(1)).cast("double"), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, zero where the whole is not positive."""
    ratio = F.try_divide(part.cast("double") * 100, whole.cast("double"))
    return F.when(whole > 0, F.round(ratio, digits)).otherwise(F.lit(0.0))


def per_population(count: Column, population: Column, floor: int = 50000,
                   per: int = 100000, digits: int = 2) -> Column:
    """Count per ``per`` inhabitants with a floor under the population."""
    people = F.greatest(population, F.lit(floor)).cast("double")
    return F.round(count.cast("double") / people * per, digits)


def rescale(amount: Column, divisor: float = 1e7, digits: int = 2) -> Column:
    """Amount in a larger currency unit."""
    return F.round(amount.cast("double") / divisor, digits)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def half_up(value: Column) -> Column:
    """Nearest integer, halves towards positive infinity."""
    return F.floor(value + 0.5)


def money(value: Column) -> Column:
    """Exact two-decimal amount, so that sums do not depend on row order."""
    return value.cast("decimal(18,2)")
