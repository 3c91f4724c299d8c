"""Aggregations over places, years and regions, and their rankings.

Sums and numbers of rows take feature rows, or feature groups, whose rows each stand for several equal ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.labels import risk_tier, snapshot_tier
from tallyfold.functions.numbers import money, percent, rescale
from tallyfold.functions.text import name_key
from tallyfold.operators.ordering import percent_ranks, top_within
from tallyfold.schema import COPIES, DISTRICT, LAT, LON, OTHER, STATE, TOTAL, YEAR

# Output name -> feature column.
MAIN_SUMS = {
    "total_crimes": TOTAL, "violent_crimes": "VIOLENT_CRIMES",
    "property_crimes": "PROPERTY_CRIMES", "women_crimes": "WOMEN_CRIMES",
}
ALL_SUMS = {**MAIN_SUMS, "economic_crimes": "ECONOMIC_CRIMES", "other_crimes": OTHER}


def summed(rows: DataFrame, column: str):
    """A column's sum, each row as often as it stands for."""
    return F.sum(F.col(column) * F.col(COPIES) if COPIES in rows.columns else F.col(column)).cast("bigint")


def _number(rows: DataFrame):
    return F.coalesce(F.sum(COPIES), F.lit(0)) if COPIES in rows.columns else F.count(F.lit(1))


def _sums(rows: DataFrame, mapping: dict[str, str]):
    return [summed(rows, column).alias(name) for name, column in mapping.items()]


def district_rollup(features: DataFrame) -> DataFrame:
    """Sums per district, years reported, coordinates of the first year."""
    return features.groupBy(F.col(DISTRICT).alias("district"), F.col(STATE).alias("state")).agg(
        F.min_by(LAT, YEAR).alias("lat"), F.min_by(LON, YEAR).alias("lon"),
        *_sums(features, MAIN_SUMS), _number(features).alias("years_reported"))


def state_rollup(features: DataFrame) -> DataFrame:
    return features.groupBy(F.col(STATE).alias("state")).agg(*_sums(features, MAIN_SUMS))


def year_rollup(features: DataFrame) -> DataFrame:
    return features.groupBy(F.col(YEAR).alias("year")).agg(*_sums(features, ALL_SUMS))


def year_rollup_with_total(features: DataFrame) -> DataFrame:
    """Yearly sums and, with a null year, the grand total; one pass."""
    return features.rollup(F.col(YEAR).alias("year")).agg(*_sums(features, ALL_SUMS))


def grand_total(features: DataFrame) -> DataFrame:
    return features.agg(summed(features, TOTAL).alias("total_national_crimes"))


def top_districts(features: DataFrame, k: int = 20) -> DataFrame:
    return district_rollup(features).orderBy(F.desc("total_crimes"), "state", "district").limit(k)


def hotspots(features: DataFrame, k: int = 50) -> DataFrame:
    """Largest districts with their shares and tier."""
    violent = percent(F.col("violent_crimes"), F.col("total_crimes"))
    return (top_districts(features, k)
            .withColumn("violent_percentage", violent)
            .withColumn("women_crime_pct", percent(F.col("women_crimes"), F.col("total_crimes")))
            .withColumn("risk_level", risk_tier(F.col("violent_percentage"), F.col("total_crimes")))
            .drop("years_reported"))


def filter_hotspots(rows: DataFrame, tier: str = "ALL", minimum: int = 0) -> DataFrame:
    kept = rows.filter(F.col("total_crimes") >= minimum)
    return kept if tier == "ALL" else kept.filter(F.col("risk_level") == tier)


def filter_region(rows: DataFrame, region: str, everything: str = "All India") -> DataFrame:
    return rows if region == everything else rows.filter(F.col("region") == region)


def state_ranking(features: DataFrame) -> DataFrame:
    return state_rollup(features).orderBy(F.desc("total_crimes"), "state")


def property_recovery(facts: DataFrame) -> DataFrame:
    """Yearly amounts and cases stolen and recovered, with recovery rates.

    ``facts`` has year, value_stolen, value_recovered, cases_stolen,
    cases_recovered.
    """
    yearly = facts.groupBy("year").agg(
        F.sum(money(F.col("value_stolen"))).alias("_stolen"),
        F.sum(money(F.col("value_recovered"))).alias("_recovered"),
        F.sum("cases_stolen").cast("bigint").alias("cases_stolen"),
        F.sum("cases_recovered").cast("bigint").alias("cases_recovered"))
    return yearly.select(
        "year",
        rescale(F.col("_stolen")).alias("stolen_inr_crores"),
        rescale(F.col("_recovered")).alias("recovered_inr_crores"),
        percent(F.col("_recovered"), F.col("_stolen")).alias("financial_recovery_rate_pct"),
        "cases_stolen", "cases_recovered",
        percent(F.col("cases_recovered"), F.col("cases_stolen")).alias("case_recovery_rate_pct"))


def mean_recovery_rate(recovery: DataFrame) -> DataFrame:
    return recovery.agg(F.round(F.avg("financial_recovery_rate_pct"), 2).alias("mean_recovery_rate_pct"))


# Output name -> fact column.
WOMEN_HEADS = {
    "rape": "RAPE", "kidnapping": "KIDNAPPING_ABDUCTION", "dowry_deaths": "DOWRY_DEATHS",
    "assault": "ASSAULT_ON_WOMEN", "cruelty_by_husband": "CRUELTY_BY_HUSBAND",
}


def women_ranking(facts: DataFrame, heads: dict[str, str] | None = None) -> DataFrame:
    """States by crimes against women, with each head's sum."""
    heads = heads or WOMEN_HEADS
    summed = facts.groupBy(F.col(STATE).alias("state")).agg(*_sums(facts, heads))
    whole = sum((F.col(h) for h in heads), F.lit(0).cast("bigint"))
    return (summed.withColumn("total_crimes_against_women", whole)
            .orderBy(F.desc("total_crimes_against_women"), "state"))


def region_states(features: DataFrame) -> DataFrame:
    """States with their region; ``features`` carries ``region``."""
    return (features.groupBy("region", F.col(STATE).alias("state")).agg(*_sums(features, MAIN_SUMS))
            .withColumn("violent_pct", percent(F.col("violent_crimes"), F.col("total_crimes"), 1)))


def region_totals(features: DataFrame) -> DataFrame:
    """Region sums and number of states, from the state sums."""
    return region_states(features).groupBy("region").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in MAIN_SUMS],
        F.count(F.lit(1)).alias("states_count"))


def regional_year(features: DataFrame) -> DataFrame:
    """Sums and member states per (year, region), from yearly state sums."""
    sums = {k: v for k, v in MAIN_SUMS.items() if k != "property_crimes"}
    by_state = features.groupBy(F.col(YEAR).alias("year"), "region", STATE).agg(*_sums(features, sums))
    return by_state.groupBy("year", "region").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in sums],
        F.count(F.lit(1)).alias("states_count"))


def yearly_grains(features: DataFrame) -> DataFrame:
    """National and state sums of every year in one pass (national: null state)."""
    rows = (features.groupBy(F.col(YEAR).alias("year"), name_key(F.col(STATE)).alias("state"))
            .agg(*_sums(features, MAIN_SUMS)))
    # Partial sums per state first, so that the second level reads few rows.
    both = rows.groupingSets([["year", "state"], ["year"]], "year", "state").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in MAIN_SUMS])
    return both.withColumn("violent_pct", F.round(
        F.col("violent_crimes").cast("double") * 100
        / F.greatest(F.col("total_crimes"), F.lit(1)).cast("double"), 1))


def yearly_top_districts(features: DataFrame, k: int = 10, raw_risk: bool = False) -> DataFrame:
    """Largest districts within each year.

    The tier expects a risk in [0, 1]. The risk score is a volume, so its percent
    rank within the year is tested; ``raw_risk`` tests the volume itself, which
    puts every row in the upper tier.
    """
    # Risk scores have two decimals: hundredths are whole numbers.
    risky = features.withColumn("_cents", F.round(F.col("DISTRICT_RISK_SCORE") * 100).cast("bigint"))
    order = [F.desc(TOTAL), F.asc(STATE), F.asc(DISTRICT)]
    ranked = top_within(risky, [YEAR], order, k)
    copies = COPIES if COPIES in features.columns else None
    if copies:  # the rows that lead, each as often as it stands for, up to the k that can be shown
        each = F.sequence(F.lit(1).cast("bigint"), F.least(F.col(copies), F.lit(k).cast("bigint")))
        ranked = top_within(ranked.drop("rank").withColumn("_copy", F.explode(each)), [YEAR], order, k)
    if raw_risk:
        ranked = ranked.withColumn("_risk", F.col("DISTRICT_RISK_SCORE"))
    else:
        ranked = ranked.join(percent_ranks(risky, YEAR, "_cents", copies), [YEAR, "_cents"], "left")
        ranked = ranked.withColumnRenamed("percent_rank", "_risk")
    return ranked.select(
        F.col(YEAR).alias("year"), "rank", F.col(DISTRICT).alias("district"),
        F.col(STATE).alias("state"), F.round(LAT, 4).alias("lat"), F.round(LON, 4).alias("lon"),
        F.col(TOTAL).alias("total_crimes"), F.col("VIOLENT_CRIMES").alias("violent_crimes"),
        F.col("WOMEN_CRIMES").alias("women_crimes"),
        F.round(F.col("VIOLENT_CRIME_RATIO") * 100, 1).alias("violent_pct"),
        snapshot_tier(F.col("_risk")).alias("risk_level"))


def last_seen(facts: DataFrame, value: str = TOTAL) -> DataFrame:
    """Distinct places with their latest volume and first coordinates."""
    return facts.groupBy(F.col(STATE).alias("state"), F.col(DISTRICT).alias("district")).agg(
        F.min_by(LAT, YEAR).alias("lat"), F.min_by(LON, YEAR).alias("lon"),
        F.max_by(value, YEAR).alias("recent_crimes"))


def latest_year(features: DataFrame) -> DataFrame:
    """The last year with its total."""
    yearly = features.groupBy(YEAR).agg(summed(features, TOTAL).alias("_total"))
    return yearly.agg(F.max(YEAR).alias("year"), F.max_by("_total", YEAR).alias("total_crimes"))


def cluster_summary(points: DataFrame, cluster: str, district: str, state: str, volume: str,
                    states_shown: int = 3) -> DataFrame:
    """Volume, distinct districts and leading states of every cluster."""
    by_place = points.groupBy(cluster, state, district).agg(F.sum(volume).alias("_v"))
    by_state = by_place.groupBy(cluster, state).agg(F.sum("_v").alias("_v"))
    # One row per cluster and state reaches these windows.
    whole = Window.partitionBy(cluster)
    by_volume = whole.orderBy(F.desc("_v"), F.asc(state))
    leading = (by_state.withColumns({"_total": F.sum("_v").over(whole), "_r": F.row_number().over(by_volume)})
               .filter(F.col("_r") <= states_shown)
               .groupBy(cluster).agg(
                   F.max("_total").alias("total_crimes"),
                   F.sort_array(F.collect_list(F.struct("_r", F.col(state).alias("s")))).alias("_s")))
    # A district name counts once per cluster, whichever states use it.
    names = by_place.groupBy(cluster).agg(F.countDistinct(district).alias("distinct_districts"))
    return (leading.join(names, cluster)
            .select(cluster, "total_crimes", "distinct_districts",
                    F.transform("_s", lambda x: x["s"]).alias("dominant_states"))
            .orderBy(F.desc("total_crimes"), cluster))
