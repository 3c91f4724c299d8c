"""Place profiles, their comparison, search and what-if projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.constants import PROFILE_DEFAULTS
from tallyfold.functions.labels import archetype, safety_score, tier_of_score
from tallyfold.functions.numbers import clamp, half_up, per_population
from tallyfold.functions.text import contains_any
from tallyfold.operators.ordering import percent_ranks
from tallyfold.operators.rollups import summed
from tallyfold.schema import COPIES, DISTRICT, LAT, LON, STATE, SUM_OF, TOTAL, YEAR

SHARES = ["violent_pct", "property_pct", "women_pct", "economic_pct", "cyber_pct", "other_pct"]


def _mean(rows: DataFrame, column: str):
    # Decimal sums do not depend on row order.
    if COPIES not in rows.columns:
        value, number = F.col(column).cast("decimal(28,6)"), F.count(column)
    else:
        value = (F.col(SUM_OF + column) if SUM_OF + column in rows.columns
                 else F.col(column).cast("decimal(28,6)") * F.col(COPIES).cast("decimal(20,0)"))
        number = F.sum(F.when(value.isNotNull(), F.col(COPIES)))
    return F.sum(value).cast("double") / number.cast("double")


def profile_totals(features: DataFrame) -> DataFrame:
    """Sums, means and first coordinates of every place over all years, from feature rows or groups."""
    sums = {"total_crimes": TOTAL, "violent": "VIOLENT_CRIMES", "property": "PROPERTY_CRIMES",
            "women": "WOMEN_CRIMES", "economic": "ECONOMIC_CRIMES", "cyber": "CYBER_CRIMES"}
    means = ["POPULATION", "POLICE_PER_LAKH", "CONVICTION_RATE", "CHARGESHEET_RATE",
             "LITERACY_RATE", "URBAN_PERCENTAGE", "DISTRICT_RISK_SCORE"]
    return features.groupBy(F.col(STATE).alias("state"), F.col(DISTRICT).alias("district")).agg(
        *[summed(features, c).alias(n) for n, c in sums.items()],
        F.min_by(LAT, YEAR).alias("lat"), F.min_by(LON, YEAR).alias("lon"),
        *[_mean(features, m).alias(f"_{m}") for m in means])


def place_profiles(features: DataFrame, k: int = 150, raw_risk: bool = False) -> DataFrame:
    """The ``k`` largest places with shares, archetype and safety score.

    The score expects a risk in [0, 1]; the mean volume is turned into its
    percent rank among all places, so it does not change with ``k``; an unknown mean ranks
    lowest. ``raw_risk`` keeps the volume, which pins every score to the lower bound.
    """
    totals = profile_totals(features)
    # Millionths, as the mean is rounded to: whole numbers are ranked by their counts.
    micro = F.round(F.col("_DISTRICT_RISK_SCORE") * 1_000_000).cast("bigint")
    top = totals.orderBy(F.desc("total_crimes"), "state", "district").limit(k).withColumn("_micro", micro)
    if raw_risk:
        risk = F.col("_DISTRICT_RISK_SCORE")
    else:
        ranks = percent_ranks(totals.select(F.lit(0).alias("_all"), micro.alias("_value"))
                              .filter(F.col("_value").isNotNull()), "_all", "_value")
        top = top.join(ranks, F.col("_micro") == F.col("_value"), "left")
        risk = F.coalesce("percent_rank", F.lit(0.0))

    def pct(column, digits=1):
        return F.round(F.col(column).cast("double") * 100
                       / F.greatest(F.col("total_crimes"), F.lit(1)).cast("double"), digits)

    def known(column):
        return F.coalesce(F.col(f"_{column}"), F.lit(float(PROFILE_DEFAULTS[column])))

    shaped = top.withColumns({
        "_risk": risk,
        "population": F.floor(known("POPULATION")),
        "violent_pct": pct("violent"), "property_pct": pct("property"),
        "women_pct": pct("women"), "economic_pct": pct("economic"),
        "cyber_pct": F.coalesce(pct("cyber", 2), F.lit(0.0))})
    known_share = sum((F.col(c) for c in SHARES[1:4]), F.col(SHARES[0]))
    return shaped.select(
        "district", "state", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"),
        "population", "total_crimes",
        per_population(F.col("total_crimes"), F.col("population"), 100000, 100000, 1)
        .alias("crime_rate_per_100k"),
        safety_score(F.col("_risk"), F.col("violent_pct"), known("CONVICTION_RATE"),
                     known("POLICE_PER_LAKH")).alias("safety_score"),
        archetype(*[F.col(c) for c in ("violent_pct", "women_pct", "property_pct",
                                       "economic_pct", "cyber_pct")]).alias("archetype"),
        F.round(known("POLICE_PER_LAKH"), 1).alias("police_per_lakh"),
        F.round(known("CONVICTION_RATE"), 1).alias("conviction_rate"),
        F.round(known("CHARGESHEET_RATE"), 1).alias("chargesheet_rate"),
        F.round(known("LITERACY_RATE"), 1).alias("literacy_rate"),
        F.round(known("URBAN_PERCENTAGE"), 1).alias("urban_pct"),
        *SHARES[:5],
        F.round(F.greatest(F.lit(0.0), F.lit(100.0) - known_share), 1).alias("other_pct"))


def search_profiles(profiles: DataFrame, query: str, k: int = 50) -> DataFrame:
    """First ``k`` profiles whose district, state or archetype has the text."""
    hit = contains_any(["district", "state", "archetype"], query)
    return profiles.filter(hit).orderBy(F.desc("total_crimes"), "state", "district").limit(k)


def compare_places(profiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both profiles of every asked pair side by side, with differences.

    ``pairs`` has state_a, district_a, state_b, district_b.
    """
    metrics = SHARES + ["crime_rate_per_100k", "safety_score", "total_crimes",
                        "police_per_lakh", "conviction_rate"]

    def side(mark):
        return profiles.select(
            F.col("state").alias(f"state_{mark}"), F.col("district").alias(f"district_{mark}"),
            F.col("archetype").alias(f"archetype_{mark}"),
            *[F.col(m).alias(f"{m}_{mark}") for m in metrics])

    both = (pairs.join(side("a"), ["state_a", "district_a"])
            .join(side("b"), ["state_b", "district_b"]))
    return both.withColumns({
        f"{m}_diff": F.round(F.col(f"{m}_a").cast("double") - F.col(f"{m}_b").cast("double"), 2)
        for m in metrics})


def neighbour_pairs(profiles: DataFrame) -> DataFrame:
    """Each profile with the next smaller one; profiles are few by construction."""
    by = Window.orderBy(F.desc("total_crimes"), "state", "district")
    return profiles.select(
        F.col("state").alias("state_a"), F.col("district").alias("district_a"),
        F.lead("state").over(by).alias("state_b"),
        F.lead("district").over(by).alias("district_b")).filter(F.col("district_b").isNotNull())


LEVERS = ("police_density", "patrol_saturation", "response_minutes", "conviction_target",
          "surveillance")


def project_scenarios(profiles: DataFrame, scenarios: list[dict], years: int = 14) -> DataFrame:
    """Projected effect of every scenario on every profile.

    A scenario has a ``name`` and the five ``LEVERS``. Scenarios ride along as an
    array of each row, so profiles are not shuffled or paired by a join.
    """
    rows = F.array(*[F.struct(F.lit(s["name"]).alias("scenario"),
                              *[F.lit(float(s[lever])).alias(lever) for lever in LEVERS])
                     for s in scenarios])
    df = profiles.select("*", F.inline(rows))
    police = (F.col("police_density") - F.coalesce("police_per_lakh", F.lit(120.0))) / 100.0
    patrol = (F.col("patrol_saturation") - 45) / 100.0
    response = (F.lit(20.0) - F.col("response_minutes")) / 20.0
    conviction = (F.col("conviction_target") - F.coalesce("conviction_rate", F.lit(45.0))) / 100.0
    watch = (F.col("surveillance") - 30) / 100.0
    # Lever weights, base effects and bounds.
    deterrence = clamp(police * 16.0 + patrol * 12.0 + response * 10.0
                       + conviction * 9.0 + watch * 7.0 + 12.5, 2.0, 48.0)
    apprehension = clamp(response * 18.0 + watch * 14.0 + police * 10.0 + 14.0, 3.0, 55.0)
    annual = half_up(F.col("total_crimes").cast("double") / years)
    scored = df.withColumns({"_det": deterrence, "_app": apprehension, "_annual": annual})
    score = clamp(F.col("safety_score") + F.col("_det") * 0.65, 20.0, 95.0)
    return scored.select(
        "state", "district", "scenario",
        F.round("_det", 1).alias("deterrence_pct"),
        F.round("_app", 1).alias("apprehension_pct"),
        half_up(F.col("_annual") * (F.col("_det") / 100.0)).alias("incidents_prevented"),
        F.round(score, 1).alias("new_safety_score"),
        tier_of_score(score).alias("new_risk_level"))
