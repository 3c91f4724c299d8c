"""Category totals, shares, risk scores and the severity label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.constants import DEMOGRAPHIC_DEFAULTS, POLICE_DEFAULTS
from tallyfold.functions.numbers import per_population, share, total_of
from tallyfold.functions.text import name_key
from tallyfold.operators.enrich import with_demographics, with_matches, with_police
from tallyfold.operators.ordering import approx_upper_quartile, upper_quartile
from tallyfold.schema import (
    CATEGORIES, COPIES, DISTRICT, FEATURE_GROUP_SCHEMA, FEATURE_SCHEMA, LABEL, OTHER, STATE, SUM_OF, SUMMED_COLUMNS, TOTAL, YEAR,
)

_PLACE = ["_state", "_district"]
#: What smaller populations count as.
FEWEST_PEOPLE = 50000


def category_totals(df: DataFrame, total: str = TOTAL) -> DataFrame:
    """Category sums and the remainder of the total, never negative."""
    summed = df.withColumns({name: total_of(heads) for name, heads in CATEGORIES.items()})
    known = total_of(list(CATEGORIES))
    return summed.withColumn(OTHER, F.greatest(F.lit(0).cast("bigint"), F.col(total) - known))


def category_ratios(df: DataFrame, total: str = TOTAL) -> DataFrame:
    return df.withColumns({
        name.replace("_CRIMES", "_CRIME_RATIO"): share(F.col(name), F.col(total))
        for name in CATEGORIES})


def district_risk(df: DataFrame, by_name_only: bool = False, total: str = TOTAL) -> DataFrame:
    """Mean yearly volume of the row's district.

    One row per district and year, so a district's window holds at most one row
    per year. ``by_name_only`` merges equal names of different states; those
    groups have no such bound and are averaged before joining back.
    """
    if by_name_only:
        means = df.groupBy(DISTRICT).agg(F.round(F.avg(total), 2).alias("DISTRICT_RISK_SCORE"))
        return df.join(means, DISTRICT, "left")
    by = Window.partitionBy(STATE, DISTRICT)
    return df.withColumn("DISTRICT_RISK_SCORE", F.round(F.avg(total).over(by), 2))


def state_risk(df: DataFrame, total: str = TOTAL) -> DataFrame:
    """Mean yearly district volume of the row's state.

    A state may hold much of the table, so it is averaged with map-side partial
    sums and joined back instead of being gathered in a window.
    """
    means = df.groupBy(STATE).agg(F.round(F.avg(total), 2).alias("STATE_RISK_SCORE"))
    return df.join(means, STATE, "left")


def severity_label(df: DataFrame, total: str = TOTAL, approximate: bool = False,
                   source: DataFrame | None = None) -> DataFrame:
    """1 for rows at or above the year's upper quartile of the total.

    Rows without a year are a group of their own. Thresholds are one short row per year;
    whether they are small enough to broadcast is left to Spark's size check. ``source`` has the
    same rows in a form that is cheaper to read, with the totals the thresholds come from.
    """
    known = df if source is None else source
    quartile = approx_upper_quartile if approximate else upper_quartile
    group = F.coalesce(F.col(YEAR).cast("string"), F.lit(""))
    cuts = quartile(known.select(group.alias("_year"), total), "_year", total, "_p75")
    joined = df.withColumn("_year", group).join(cuts, "_year", "left").drop("_year")
    hit = F.col(total) >= F.coalesce("_p75", F.col(total).cast("double"))
    return joined.withColumn(LABEL, F.when(hit, 1).otherwise(0)).drop("_p75")


def trailing_risk(df: DataFrame, years: int = 5, total: str = TOTAL,
                  alias: str = "TRAILING_RISK") -> DataFrame:
    """Mean of the district's preceding years, the current one left out.

    A range over the year value keeps the span right where years are missing.
    """
    by = Window.partitionBy(STATE, DISTRICT).orderBy(YEAR).rangeBetween(-years, -1)
    return df.withColumn(alias, F.round(F.avg(total).over(by), 2))


def year_over_year(df: DataFrame, value: str, year: str = YEAR,
                   keys: list[str] | None = None) -> DataFrame:
    """Change against the previous reported year, absolute and in percent."""
    by = Window.partitionBy(*(keys or [])).orderBy(year)
    before = F.lag(value).over(by)
    return df.withColumns({
        "previous": before,
        "change": F.col(value) - before,
        "change_pct": F.round(F.try_divide((F.col(value) - before).cast("double") * 100,
                                           before.cast("double")), 2)})


def place_attributes(totals: DataFrame, demographics: DataFrame, police: DataFrame,
                     cyber: DataFrame, by_name_only: bool = False, grouped: bool = False) -> DataFrame:
    """One row per place with its risk scores, dimensions and yearly cyber counts.

    Where a dimension has several rows of a place, the place has a row for each, and for each pair of both
    dimensions' rows. With ``grouped`` it has one, with their number and the sums of the dimensions' columns over them.

    Keys are ``_state`` and ``_district`` in comparison form. All of this meets
    here, where rows are fewer by the number of years and narrow. The cyber counts
    become a map by year; rows without a year are left out and several of one year add up.
    """
    keyed = totals.select(name_key(F.col(STATE)).alias("_state"),
                          name_key(F.col(DISTRICT)).alias("_district"), TOTAL)
    mean = F.round(F.avg(TOTAL), 2)
    rows = keyed.groupBy("_state", "_district").agg(mean.alias("DISTRICT_RISK_SCORE"))
    if grouped:
        summed = [{c: v for c, v in d.items() if c in SUMMED_COLUMNS} for d in (DEMOGRAPHIC_DEFAULTS, POLICE_DEFAULTS)]
        people = F.greatest(F.coalesce("POPULATION", F.lit(DEMOGRAPHIC_DEFAULTS["POPULATION"])), F.lit(FEWEST_PEOPLE))
        rows = with_matches(rows, demographics.withColumn("POPULATION", people), "_people", summed[0], _PLACE)
        rows = with_matches(rows, police, "_police", summed[1], _PLACE)
        # each row of one dimension meets every row of the other
        rows = rows.withColumns({
            COPIES: F.col("_people") * F.col("_police"),
            **{SUM_OF + c: F.col(c) * F.col(times).cast("decimal(20,0)")
               for own, times in zip(summed, ("_police", "_people")) for c in own}}).drop(
            "_people", "_police", *summed[0], *summed[1])
    else:
        rows = with_police(with_demographics(rows, demographics, _PLACE), police, _PLACE)
    per_year = cyber.filter(F.col(YEAR).isNotNull()).groupBy(
        name_key(F.col(STATE)).alias("_state"), name_key(F.col(DISTRICT)).alias("_district"), YEAR).agg(
        F.sum("CYBER_CRIMES").alias("CYBER_CRIMES"))
    by_year = per_year.groupBy(*_PLACE).agg(
        F.map_from_entries(F.collect_list(F.struct(YEAR, "CYBER_CRIMES"))).alias("_cyber"))
    rows = rows.join(by_year, _PLACE, "left")
    if by_name_only:
        rows = rows.drop("DISTRICT_RISK_SCORE").join(
            keyed.groupBy("_district").agg(mean.alias("DISTRICT_RISK_SCORE")), "_district", "left")
    return rows.join(keyed.groupBy("_state").agg(mean.alias("STATE_RISK_SCORE")), "_state", "left")


def _featured(clean: DataFrame, totals: DataFrame, places: DataFrame) -> DataFrame:
    """Clean rows with their places' columns, category sums and shares, cyber counts and label."""
    keyed = clean.withColumns({"_state": name_key(F.col(STATE)), "_district": name_key(F.col(DISTRICT))})
    placed = keyed.join(places, _PLACE, "left").withColumn(
        "CYBER_CRIMES", F.coalesce(F.try_element_at("_cyber", F.col(YEAR)), F.lit(0)))
    # Statistics look at the reported totals, all else at totals of at least one.
    floored = placed.withColumn(TOTAL, F.greatest(F.col(TOTAL), F.lit(1).cast("bigint")))
    labelled = severity_label(category_ratios(category_totals(floored)), source=totals)
    return labelled.withColumn("LOCATION_CLUSTER", F.lit(0))


def build_feature_groups(clean: DataFrame, demographics: DataFrame, police: DataFrame, cyber: DataFrame,
                         by_name_only: bool = False, totals: DataFrame | None = None) -> DataFrame:
    """``build_features`` with one row for all feature rows of a clean row, and their number.

    Feature rows of one clean row differ in the dimensions' columns only, of which sums are kept. Their number grows with
    the product of the dimensions' rows of a place; sums over them do not have to.
    """
    totals = clean if totals is None else totals
    places = place_attributes(totals, demographics, police, cyber, by_name_only, grouped=True)
    people = SUM_OF + "POPULATION"
    rows = _featured(clean, totals, places).withColumns({
        COPIES: F.coalesce(COPIES, F.lit(1)), people: F.coalesce(people, F.lit(FEWEST_PEOPLE))})
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in FEATURE_GROUP_SCHEMA.fields])


def build_features(clean: DataFrame, demographics: DataFrame, police: DataFrame,
                   cyber: DataFrame, by_name_only: bool = False,
                   totals: DataFrame | None = None) -> DataFrame:
    """The full feature row of every clean (state, district, year).

    Attributes are gathered per place and yearly thresholds per year first, where rows are few and narrow; wide rows then
    meet each in one join, by place and by year, which shuffles them unless Spark finds the other side small enough. Group statistics come from ``totals``, by default the clean
    rows; give the rows before the coordinate lookup where it is not stored.
    """
    totals = clean if totals is None else totals
    labelled = _featured(clean, totals, place_attributes(totals, demographics, police, cyber, by_name_only))
    people = F.greatest(F.col("POPULATION"), F.lit(FEWEST_PEOPLE))
    rated = labelled.withColumns({
        "POPULATION": people,
        "CRIME_RATE_PER_100K": per_population(F.col(TOTAL), people),
        "VIOLENT_RATE_PER_100K": per_population(F.col("VIOLENT_CRIMES"), people)})
    return rated.select(*[F.col(f.name).cast(f.dataType) for f in FEATURE_SCHEMA.fields])
