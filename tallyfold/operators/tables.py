"""Side tables in text form brought into typed shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import parse_double
from tallyfold.functions.text import first_given, name_key, title_case
from tallyfold.operators.cleaning import all_numeric, drop_subtotals, first_wins
from tallyfold.schema import DISTRICT, STATE, YEAR

# Source headers of the side tables.
RECOVERY_HEADERS = {
    "value_stolen": "Value_of_Property_Stolen", "value_recovered": "Value_of_Property_Recovered",
    "cases_stolen": "Cases_Property_Stolen", "cases_recovered": "Cases_Property_Recovered",
}
WOMEN_HEADERS = {
    "RAPE": "Rape", "KIDNAPPING_ABDUCTION": "Kidnapping and Abduction", "DOWRY_DEATHS": "Dowry Deaths",
    "ASSAULT_ON_WOMEN": "Assault on women with intent to outrage her modesty",
    "CRUELTY_BY_HUSBAND": "Cruelty by Husband or his Relatives",
}
DIMENSION_COLUMNS = {
    "demographics": {"POPULATION": "bigint", "POPULATION_DENSITY": "double", "LITERACY_RATE": "double",
                     "URBAN_PERCENTAGE": "double"},
    "police": {"POLICE_PER_LAKH": "double", "CHARGESHEET_RATE": "double", "CONVICTION_RATE": "double"},
    "cyber": {"CYBER_CRIMES": "bigint"},
}
DIMENSION_HEADERS = {
    "POLICE_PER_LAKH": "POLICE_PER_LAKH_POPULATION", "CHARGESHEET_RATE": "CHARGESHEET_RATE_PCT",
    "CONVICTION_RATE": "CONVICTION_RATE_PCT", "CYBER_CRIMES": "TOTAL_CYBER_CRIMES",
}


def _either(df: DataFrame, *names: str):
    """The first given of several header spellings, of those the table has."""
    present = [F.col(f"`{n}`") for n in names if n in df.columns]
    return first_given(*present) if present else F.lit(None).cast("string")


def recovery_rows(raw: DataFrame) -> DataFrame:
    """Yearly amounts and cases; rows with a malformed number or year are left out."""
    year = F.trim(_either(raw, "Year", "YEAR"))
    named = raw.select(F.when(year.rlike("^[+-]?[0-9]+$"), year.try_cast("int")).alias("year"), *[
        (F.col(f"`{h}`") if h in raw.columns else F.lit(None).cast("string")).alias(n)
        for n, h in RECOVERY_HEADERS.items()]).filter(F.col("year").isNotNull())
    return all_numeric(named, list(RECOVERY_HEADERS)).withColumns({
        c: F.col(c).try_cast("bigint") for c in ("cases_stolen", "cases_recovered")})


def women_rows(raw: DataFrame, keep_subtotals: bool = False) -> DataFrame:
    """Counts per state row; ``keep_subtotals`` also lets rows in that sum up others."""
    if not keep_subtotals:
        for name in ("DISTRICT", "District"):
            if name in raw.columns:
                raw = drop_subtotals(raw, name)
    state = title_case(F.trim(F.coalesce(_either(raw, "STATE/UT", "State/UT"), F.lit("UNKNOWN"))))
    named = raw.select(state.alias(STATE), *[
        (F.col(f"`{h}`") if h in raw.columns else F.lit(None).cast("string")).alias(n)
        for n, h in WOMEN_HEADERS.items()])
    return all_numeric(named, list(WOMEN_HEADERS)).withColumns({
        c: F.col(c).try_cast("bigint") for c in WOMEN_HEADERS})


def dimension_rows(raw: DataFrame, kind: str, order: list) -> DataFrame:
    """A typed dimension with one row per key; of several rows the last one counts.

    ``order`` gives the reading order. Unparsable figures become null, so that the
    lookup falls back to its default.
    """
    keys = [STATE, DISTRICT] + ([YEAR] if kind == "cyber" else [])
    figures = {}
    for name, kind_of in DIMENSION_COLUMNS[kind].items():
        header = DIMENSION_HEADERS.get(name, name)
        text = F.col(header) if header in raw.columns else F.lit(None).cast("string")
        figures[name] = parse_double(text).try_cast(kind_of)
    typed = raw.withColumns({STATE: name_key(F.col(STATE)), DISTRICT: name_key(F.col(DISTRICT)), **figures})
    if kind == "cyber":
        typed = typed.withColumn(YEAR, parse_double(F.col(YEAR).cast("string")).try_cast("int"))
    return first_wins(typed, keys, [F.desc(c) for c in order]).select(*keys, *figures)
