"""Tier, archetype and score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.numbers import clamp


def risk_tier(violent_pct: Column, total: Column, pct_limit: float = 20,
              total_limit: int = 200000) -> Column:
    hot = (violent_pct > pct_limit) | (total > total_limit)
    return F.when(hot, F.lit("CRITICAL")).otherwise(F.lit("HIGH"))


def snapshot_tier(risk: Column, limit: float = 0.6) -> Column:
    return F.when(risk > limit, F.lit("CRITICAL")).otherwise(F.lit("ELEVATED"))


def archetype(violent: Column, women: Column, prop: Column,
              economic: Column, cyber: Column) -> Column:
    """Dominant pattern of a place from its category percentages."""
    # Thresholds and names, tested in this order.
    return (
        F.when(violent > 26, F.lit("Violent Hotspot Corridor"))
        .when(women > 18, F.lit("High Women Safety Vulnerability"))
        .when(prop > 40, F.lit("High-Density Property Theft Hub"))
        .when((economic > 8) | (cyber > 1.5), F.lit("Commercial & Cyber Fraud Zone"))
        .otherwise(F.lit("Mixed Urban IPC Density"))
    )


def safety_score(risk: Column, violent_pct: Column, conviction: Column,
                 police: Column) -> Column:
    """Score in [15, 95]; ``risk`` is expected in [0, 1]."""
    # The weights of the score.
    raw = (F.lit(100.0) - risk * 50.0 - violent_pct * 0.8
           + conviction * 0.25 + F.least(police, F.lit(200.0)) * 0.05)
    return clamp(F.round(raw, 1), 15.0, 95.0)


def metric_class(value: Column, limits: list[float]) -> Column:
    """Class 4..0; ``limits`` run from the highest boundary down."""
    out = None
    for rank, limit in zip(range(len(limits), 0, -1), limits):
        out = (F.when(value > limit, F.lit(rank)) if out is None
               else out.when(value > limit, F.lit(rank)))
    return out.otherwise(F.lit(0))


def heat_weight(total: Column) -> Column:
    return F.least(total.cast("double") / 10000.0, F.lit(10.0))


def marker_radius(total: Column, scale: float = 20000, low: float = 6, high: float = 18) -> Column:
    return clamp(total.cast("double") / scale, float(low), float(high))


def driver_label(violent_ratio: Column, risk: Column) -> Column:
    return (
        F.when(violent_ratio > 0.25, F.lit("High Violent Crime Ratio"))
        .when(risk > 6000, F.lit("High Historical District Baseline"))
        .otherwise(F.lit("Normal Baseline Distribution"))
    )


def logistic(score: Column, slope: float = 6.0, middle: float = 0.45) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-slope) * (score - F.lit(middle))))


def weighted_risk(weights: dict[str, float], scale: float = 5000.0) -> Column:
    """Logistic of weighted inputs; inputs above one are first scaled down."""
    score = F.lit(0.0)
    for name, weight in weights.items():
        x = F.col(name).cast("double")
        score = score + F.lit(weight) * F.least(
            F.when(x > 1.0, x / scale).otherwise(x), F.lit(1.0))
    return logistic(score)


# Weight and full-scale value of the short risk score.
SHORT_SCORE = {
    "DISTRICT_RISK_SCORE": (0.8429, 5000.0),
    "VIOLENT_CRIME_RATIO": (0.0377, 0.35),
    "PROPERTY_CRIME_RATIO": (0.0357, 0.40),
    "WOMEN_CRIME_RATIO": (0.0356, 0.15),
}


def short_risk(parts: dict[str, tuple[float, float]] = SHORT_SCORE) -> Column:
    """Logistic of the four-input score."""
    score = F.lit(0.0)
    for name, (weight, full) in parts.items():
        score = score + F.lit(weight) * F.least(F.col(name).cast("double") / full, F.lit(1.0))
    return logistic(score)


def tier_of_score(score: Column) -> Column:
    """Label of a projected safety score."""
    return (
        F.when(score < 45, F.lit("CRITICAL"))
        .when(score < 65, F.lit("ELEVATED"))
        .when(score < 80, F.lit("MODERATE"))
        .otherwise(F.lit("CONTROLLED"))
    )
