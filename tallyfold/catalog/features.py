"""Categories, shares, risk scores, thresholds and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.catalog.checks import (
    CLEAN, QUARTILES, over_clean, over_features, over_incidents, r, rate, total,
)
from tallyfold.catalog.registry import Query
from tallyfold.functions import labels
from tallyfold.functions.numbers import per_population
from tallyfold.operators import features as fx
from tallyfold.operators import sketches
from tallyfold.operators.ordering import approx_upper_quartile, equal_chunks, trailing_rows, upper_quartile
from tallyfold.plans import trade
from tallyfold.plans.stages import clean_stage, direct_features, feature_stage
from tallyfold.session import scratch_path
from tallyfold.schema import CATEGORIES, DISTRICT, FEATURE_SCHEMA, LABEL, OTHER, STATE, TOTAL, YEAR
from tallyfold.streaming.live import with_event_defaults

COLUMNS = [f.name for f in FEATURE_SCHEMA.fields]
KEY = "STATE_UT, DISTRICT, YEAR"


def _categories(spark, folder):
    out = fx.category_ratios(fx.category_totals(clean_stage(spark, folder)))
    return out.select(STATE, DISTRICT, YEAR, *CATEGORIES, OTHER,
                      *[c.replace("_CRIMES", "_CRIME_RATIO") for c in CATEGORIES])


_SUMS = ", ".join(f"{total(h)} AS {n}" for n, h in CATEGORIES.items())
_RATIO = ", ".join(r(f"CAST({total(h)} AS DOUBLE) / {TOTAL}", 4) + f" AS {n.replace('_CRIMES', '_CRIME_RATIO')}"
                   for n, h in CATEGORIES.items())


def _rates(spark, folder):
    joined = feature_stage(spark, folder)
    return joined.select(STATE, DISTRICT, YEAR,
                         per_population(F.col(TOTAL), F.col("POPULATION"), 100000, digits=1).alias("rate_100k"),
                         labels.heat_weight(F.col(TOTAL)).alias("heat"),
                         F.round(labels.marker_radius(F.col(TOTAL), 20, 2, 6), 4).alias("radius"))


def _risks(spark, folder, by_name_only=False):
    facts = clean_stage(spark, folder)
    if by_name_only:
        # Shortened names, so that districts of several states share one.
        facts = facts.withColumn(DISTRICT, F.substring(DISTRICT, -1, 1))
        scored = fx.district_risk(facts, True)
        return scored.groupBy(DISTRICT).agg(F.max("DISTRICT_RISK_SCORE").alias("risk"), F.count(F.lit(1)).alias("n"))
    return fx.state_risk(fx.district_risk(facts)).select(
        STATE, DISTRICT, YEAR, "DISTRICT_RISK_SCORE", "STATE_RISK_SCORE")


def _flag(spark, folder, approximate):
    return fx.severity_label(clean_stage(spark, folder), approximate=approximate).select(
        STATE, DISTRICT, YEAR, TOTAL, LABEL)


LOWER_RANK = f"""cuts AS (SELECT YEAR, CAST(min(x) AS DOUBLE) AS p75 FROM (
  SELECT YEAR, {TOTAL} AS x, row_number() OVER (PARTITION BY YEAR ORDER BY {TOTAL}) AS i,
    count(*) OVER (PARTITION BY YEAR) AS n FROM clean) WHERE i >= 0.75 * n GROUP BY YEAR)"""


def _changes_as_doubles(df):
    """The first year has none; as doubles the gaps look alike on both engines."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("previous", "change")})


def _national_change(spark, folder):
    yearly = clean_stage(spark, folder).groupBy(YEAR).agg(F.sum(TOTAL).cast("bigint").alias("total_crimes"))
    return _changes_as_doubles(fx.year_over_year(yearly, "total_crimes"))


def _place_change(spark, folder):
    changed = fx.year_over_year(clean_stage(spark, folder), TOTAL, YEAR, [STATE, DISTRICT])
    return _changes_as_doubles(changed).select(STATE, DISTRICT, YEAR, "previous", "change", "change_pct")


def _scores(spark, folder):
    """Both logistic scores and the driver label."""
    weights = {"VIOLENT_CRIME_RATIO": 0.5, "PROPERTY_CRIME_RATIO": 0.3, "CRIME_RATE_PER_100K": 0.4}
    return feature_stage(spark, folder).select(
        STATE, DISTRICT, YEAR, F.round(labels.weighted_risk(weights), 6).alias("weighted"),
        F.round(labels.short_risk(), 6).alias("short"),
        labels.driver_label(F.col("VIOLENT_CRIME_RATIO"), F.col("DISTRICT_RISK_SCORE") * 60).alias("driver"))


#: Events of a district that one task's window takes.
CHUNK = 5000


def _sketched(spark, folder):
    """Third quartile of every year from sketches stored per part of the data and merged, with its exact rank.

    ``within`` says whether the rank lies within the sketch's error bound of three quarters of the rows.
    """
    facts = clean_stage(spark, folder).select(STATE, YEAR, TOTAL)
    store = sketches.SketchStore(scratch_path(spark, "sketches"), [YEAR], TOTAL)
    part = F.pmod(F.xxhash64(STATE), F.lit(3))
    for k in range(3):
        store.add(facts.where(part == k), f"delivery{k}")
    cuts = store.quantiles(spark, 0.75, "p75")
    # One row per year.
    ranks = facts.join(F.broadcast(cuts), YEAR).groupBy(YEAR, "n").agg(
        F.count_if(F.col(TOTAL) < F.col("p75")).alias("_below"), F.count_if(F.col(TOTAL) <= F.col("p75")).alias("_up_to"))
    slack = F.lit(sketches.rank_error()) * F.col("n") + 1
    return ranks.select(YEAR, "n", ((F.col("_below") - slack <= 0.75 * F.col("n")) & (F.col("_up_to") + slack >= 0.75 * F.col("n"))).alias("within"))


def _last_events(spark, folder):
    """Mean and number of the last 25 events of every district, per event."""
    events = with_event_defaults(trade.incidents(spark, folder)).select(
        "district", "timestamp", "event_id", "incident_count")
    cut = equal_chunks(events, ["district"], "timestamp", CHUNK)
    rows = trailing_rows(cut, ["district"], ["timestamp", "event_id"], F.col("chunk"), 25, {
        "seen": ("count", "incident_count"), "summed": ("sum", "incident_count"),
        "largest": ("max", "incident_count")})
    return rows.select("event_id", "district", "seen", "summed", "largest")


def _capped(x, scale):
    return f"least(CASE WHEN {x} > 1.0 THEN {x} / {scale} ELSE {x} END, 1.0)"


def _logistic(score):
    return f"1.0 / (1.0 + exp(-6.0 * (({score}) - CAST(0.45 AS DOUBLE))))"



QUERIES = [
    Query("feature_table", "P5 P7 P10 P11 P12 P13 A11 A12 J4 J5 J6 J7 W1", lambda s, d: feature_stage(s, d).select(COLUMNS),
          over_features(f"SELECT {', '.join(COLUMNS)} FROM features")),
    Query("feature_table_direct", "P10 P11 P12 P13 A11 A12", lambda s, d: direct_features(s, d).select(COLUMNS),
          over_features(f"SELECT {', '.join(COLUMNS)} FROM features")),
    Query("category_totals", "P10 P11 P12", _categories, over_clean(
        f"SELECT {KEY}, {_SUMS}, greatest(0, {TOTAL} - ({total([total(h) for h in CATEGORIES.values()])})) AS {OTHER}, "
        f"{_RATIO} FROM clean")),
    Query("population_rates", "P13 P21", _rates, over_features(
        f"""SELECT {KEY}, {rate(TOTAL, 'POPULATION', 100000, 1)} AS rate_100k,
          least(CAST({TOTAL} AS DOUBLE) / 10000, 10.0) AS heat,
          {r(f'greatest(2.0, least(6.0, CAST({TOTAL} AS DOUBLE) / 20))', 4)} AS radius FROM features""")),
    Query("risk_scores", "A11 W1 J7", _risks, over_clean(
        f"""SELECT {KEY}, {r(f'avg({TOTAL}) OVER (PARTITION BY STATE_UT, DISTRICT)', 2)} AS DISTRICT_RISK_SCORE,
          {r(f'avg({TOTAL}) OVER (PARTITION BY STATE_UT)', 2)} AS STATE_RISK_SCORE FROM clean""")),
    Query("risk_by_name_only", "A11", lambda s, d: _risks(s, d, True), over_clean(
        f"SELECT right(DISTRICT, 1) AS DISTRICT, {r(f'avg({TOTAL})', 2)} AS risk, count(*) AS n FROM clean "
        "GROUP BY right(DISTRICT, 1)")),
    Query("upper_quartiles", "A12", lambda s, d: upper_quartile(clean_stage(s, d), YEAR, TOTAL),
          f"WITH {CLEAN}, {QUARTILES} SELECT YEAR, p75 FROM quartiles"),
    Query("approx_quartiles", "A13", lambda s, d: approx_upper_quartile(clean_stage(s, d), YEAR, TOTAL),
          f"WITH {CLEAN}, {LOWER_RANK} SELECT YEAR, p75 FROM cuts"),
    Query("sketched_quartiles", "A13", _sketched,
          f"WITH {CLEAN} SELECT YEAR, count(*) AS n, bool_and({TOTAL} IS NOT NULL) AS within FROM clean GROUP BY YEAR"),
    Query("severity_flag", "A12 J7", lambda s, d: _flag(s, d, False),
          f"WITH {CLEAN}, {QUARTILES} SELECT k.STATE_UT, k.DISTRICT, k.YEAR, {TOTAL}, "
          f"CASE WHEN {TOTAL} >= p75 THEN 1 ELSE 0 END AS {LABEL} FROM clean k JOIN quartiles q ON k.YEAR = q.YEAR"),
    Query("severity_flag_approx", "W2 A13", lambda s, d: _flag(s, d, True),
          f"WITH {CLEAN}, {LOWER_RANK} SELECT k.STATE_UT, k.DISTRICT, k.YEAR, {TOTAL}, "
          f"CASE WHEN {TOTAL} >= p75 THEN 1 ELSE 0 END AS {LABEL} FROM clean k JOIN cuts q ON k.YEAR = q.YEAR"),
    Query("trailing_risk", "W3", lambda s, d: fx.trailing_risk(clean_stage(s, d)).select(
        STATE, DISTRICT, YEAR, "TRAILING_RISK"), over_clean(
        f"""SELECT {KEY}, {r(f'avg({TOTAL}) OVER (PARTITION BY STATE_UT, DISTRICT ORDER BY YEAR '
                             'RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING)', 2)} AS TRAILING_RISK FROM clean""")),
    Query("national_change", "W6", _national_change, over_clean(
        f"""SELECT YEAR, total_crimes, CAST(previous AS DOUBLE) AS previous,
          CAST(total_crimes - previous AS DOUBLE) AS change,
          {r('CAST(total_crimes - previous AS DOUBLE) * 100 / CAST(previous AS DOUBLE)', 2)} AS change_pct
        FROM (SELECT *, lag(total_crimes) OVER (ORDER BY YEAR) AS previous FROM (
          SELECT YEAR, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes FROM clean GROUP BY YEAR))""")),
    Query("place_change", "W6", _place_change, over_clean(
        f"""SELECT {KEY}, CAST(previous AS DOUBLE) AS previous, CAST({TOTAL} - previous AS DOUBLE) AS change,
          {r(f'CAST({TOTAL} - previous AS DOUBLE) * 100 / CAST(previous AS DOUBLE)', 2)} AS change_pct
        FROM (SELECT *, lag({TOTAL}) OVER (PARTITION BY STATE_UT, DISTRICT ORDER BY YEAR) AS previous FROM clean)""")),
    Query("logistic_scores", "P26 P27", _scores, over_features(
        f"""SELECT {KEY},
          {r(_logistic(' + '.join(f"CAST({w} AS DOUBLE) * {_capped(c, 5000.0)}" for c, w in (
              ('VIOLENT_CRIME_RATIO', 0.5), ('PROPERTY_CRIME_RATIO', 0.3), ('CRIME_RATE_PER_100K', 0.4)))), 6)} AS weighted,
          {r(_logistic(' + '.join(f"CAST({w} AS DOUBLE) * least({c} / CAST({full} AS DOUBLE), 1.0)" for c, w, full in (
              ('DISTRICT_RISK_SCORE', 0.8429, 5000), ('VIOLENT_CRIME_RATIO', 0.0377, 0.35),
              ('PROPERTY_CRIME_RATIO', 0.0357, 0.4), ('WOMEN_CRIME_RATIO', 0.0356, 0.15)))), 6)} AS short,
          CASE WHEN VIOLENT_CRIME_RATIO > 0.25 THEN 'High Violent Crime Ratio'
            WHEN DISTRICT_RISK_SCORE * 60 > 6000 THEN 'High Historical District Baseline'
            ELSE 'Normal Baseline Distribution' END AS driver FROM features""")),
    Query("last_events_window", "W7", _last_events, over_incidents(
        """SELECT event_id, district, count(*) OVER w AS seen, CAST(sum(incident_count) OVER w AS BIGINT) AS summed,
          max(incident_count) OVER w AS largest FROM incidents
        WINDOW w AS (PARTITION BY district ORDER BY "timestamp", event_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)""")),
]
