"""Aggregations, rankings, profiles, calendars and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.catalog.checks import REGIONS, over_clean, over_features, r
from tallyfold.catalog.registry import Query
from tallyfold.catalog.storage import HOTSPOT_SQL
from tallyfold.constants import DAY_WEIGHTS, DAYS, METRIC_CLASSES, SEASON_WEIGHTS
from tallyfold.functions import labels
from tallyfold.functions.text import hour_label
from tallyfold.operators import calendar, profiles, rollups
from tallyfold.operators.enrich import with_region
from tallyfold.plans import trade
from tallyfold.plans.stages import clean_stage, feature_group_stage
from tallyfold.schema import OTHER, TOTAL

SUMS = {"total_crimes": TOTAL, "violent_crimes": "VIOLENT_CRIMES",
        "property_crimes": "PROPERTY_CRIMES", "women_crimes": "WOMEN_CRIMES"}
ALL_SUMS = {**SUMS, "economic_crimes": "ECONOMIC_CRIMES", "other_crimes": OTHER}


def _sum_sql(sums):
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in sums.items())


def _share(part, whole, digits):
    return r(f"CAST({part} AS DOUBLE) * 100 / CAST({whole} AS DOUBLE)", digits)


def on_groups(fn):
    """For what sums feature rows up or shows a few of them."""
    return lambda spark, folder: fn(feature_group_stage(spark, folder))


def _regional(fn):
    return lambda spark, folder: fn(with_region(feature_group_stage(spark, folder), trade.regions(spark, folder)))


REGIONAL = f"""{REGIONS}, regional AS (SELECT f.*, coalesce(region, 'Northern') AS region
  FROM features f LEFT JOIN state_regions ON upper(STATE_UT) = state_key)"""


def over_regional(select):
    return over_features(select, REGIONAL)


def _classes(spark, folder):
    """Map classes of every state, on limits scaled to the table's volume."""
    known = with_region(feature_group_stage(spark, folder), trade.regions(spark, folder))
    states = rollups.region_states(known)
    return states.select(
        "state",
        labels.metric_class(F.col("violent_pct"), METRIC_CLASSES["violent_pct"]).alias("violent_class"),
        labels.metric_class(F.col("women_crimes") * 100, METRIC_CLASSES["women_crimes"]).alias("women_class"),
        labels.metric_class(F.col("total_crimes") * 1000, METRIC_CLASSES["total_crimes"]).alias("total_class"))


def _class_sql(value, metric):
    limits = METRIC_CLASSES[metric]
    return "CASE " + " ".join(f"WHEN {value} > {x} THEN {4 - i}" for i, x in enumerate(limits)) + " ELSE 0 END"


def _recovery(spark, folder):
    return rollups.property_recovery(trade.recovery_facts(spark, folder))


RECOVERY_SQL = f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  {r("CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1e7", 2)} AS stolen_inr_crores,
  {r("CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) / 1e7", 2)}
    AS recovered_inr_crores,
  {_share("coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0)",
          "sum(CAST(o_totalprice AS DECIMAL(18,2)))", 2)} AS financial_recovery_rate_pct,
  count(*) AS cases_stolen, count(*) FILTER (WHERE o_orderstatus = 'F') AS cases_recovered,
  {_share("count(*) FILTER (WHERE o_orderstatus = 'F')", "count(*)", 2)} AS case_recovery_rate_pct
FROM orders GROUP BY year(o_orderdate)"""


def _place_table(spark, folder, k=150):
    return profiles.place_profiles(feature_group_stage(spark, folder), k)


def _mean(c):
    return f"CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) / CAST(count({c}) AS DOUBLE)"


def _part(c, d=1):
    return _share(f"sum({c})", f"sum({TOTAL})", d)


PROFILES = f"""grouped AS (
  SELECT STATE_UT AS state, DISTRICT AS district, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes,
    round(arg_min(LATITUDE, YEAR), 4) AS lat, round(arg_min(LONGITUDE, YEAR), 4) AS lon,
    CAST(floor({_mean('POPULATION')}) AS BIGINT) AS population,
    {_mean('POLICE_PER_LAKH')} AS police, {_mean('CONVICTION_RATE')} AS conviction,
    {_mean('CHARGESHEET_RATE')} AS chargesheet, {_mean('LITERACY_RATE')} AS literacy,
    {_mean('URBAN_PERCENTAGE')} AS urban, {_mean('DISTRICT_RISK_SCORE')} AS risk,
    {_part('VIOLENT_CRIMES')} AS violent_pct, {_part('PROPERTY_CRIMES')} AS property_pct,
    {_part('WOMEN_CRIMES')} AS women_pct, {_part('ECONOMIC_CRIMES')} AS economic_pct,
    {_part('CYBER_CRIMES', 2)} AS cyber_pct
  FROM features GROUP BY STATE_UT, DISTRICT),
profiles AS (
  SELECT district, state, lat, lon, population, total_crimes,
    {r('CAST(total_crimes AS DOUBLE) / CAST(greatest(population, 100000) AS DOUBLE) * 100000', 1)} AS crime_rate_per_100k,
    greatest(15.0, least(95.0, {r("100.0 - percent_rank() OVER (ORDER BY risk) * CAST(50.0 AS DOUBLE) "
        "- violent_pct * CAST(0.8 AS DOUBLE) + conviction * CAST(0.25 AS DOUBLE) "
        "+ least(police, 200.0) * CAST(0.05 AS DOUBLE)", 1)})) AS safety_score,
    CASE WHEN violent_pct > 26 THEN 'Violent Hotspot Corridor'
      WHEN women_pct > 18 THEN 'High Women Safety Vulnerability'
      WHEN property_pct > 40 THEN 'High-Density Property Theft Hub'
      WHEN economic_pct > 8 OR cyber_pct > 1.5 THEN 'Commercial & Cyber Fraud Zone'
      ELSE 'Mixed Urban IPC Density' END AS archetype,
    {r('police', 1)} AS police_per_lakh, {r('conviction', 1)} AS conviction_rate,
    {r('chargesheet', 1)} AS chargesheet_rate, {r('literacy', 1)} AS literacy_rate, {r('urban', 1)} AS urban_pct,
    violent_pct, property_pct, women_pct, economic_pct, cyber_pct,
    {r('greatest(0.0, 100.0 - (violent_pct + property_pct + women_pct + economic_pct))', 1)} AS other_pct
  FROM grouped ORDER BY total_crimes DESC, state, district LIMIT 150)"""

COMPARED = ["violent_pct", "property_pct", "women_pct", "economic_pct", "cyber_pct", "other_pct",
            "crime_rate_per_100k", "safety_score", "total_crimes", "police_per_lakh", "conviction_rate"]

SCENARIOS = [
    {"name": "steady", "police_density": 150, "patrol_saturation": 45, "response_minutes": 15,
     "conviction_target": 45, "surveillance": 30},
    {"name": "surge", "police_density": 320, "patrol_saturation": 85, "response_minutes": 6,
     "conviction_target": 70, "surveillance": 80},
    {"name": "lean", "police_density": 60, "patrol_saturation": 20, "response_minutes": 28,
     "conviction_target": 30, "surveillance": 10},
]
_SCENARIO_ROWS = ", ".join(
    "(" + ", ".join([f"'{s['name']}'"] + [f"CAST({s[k]} AS DOUBLE)" for k in profiles.LEVERS]) + ")"
    for s in SCENARIOS)
PROJECTION_SQL = f"""SELECT state, district, scenario, {r('det', 1)} AS deterrence_pct, {r('app', 1)} AS apprehension_pct,
  CAST(floor(annual * (det / 100.0) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS incidents_prevented,
  {r('score', 1)} AS new_safety_score,
  CASE WHEN score < 45 THEN 'CRITICAL' WHEN score < 65 THEN 'ELEVATED' WHEN score < 80 THEN 'MODERATE'
    ELSE 'CONTROLLED' END AS new_risk_level
FROM (SELECT *, greatest(20.0, least(95.0, safety_score + det * CAST(0.65 AS DOUBLE))) AS score FROM (
  SELECT state, district, scenario, safety_score,
    floor(CAST(total_crimes AS DOUBLE) / 7 + CAST(0.5 AS DOUBLE)) AS annual,
    greatest(2.0, least(48.0, p * 16.0 + a * 12.0 + e * 10.0 + c * 9.0 + w * 7.0 + 12.5)) AS det,
    greatest(3.0, least(55.0, e * 18.0 + w * 14.0 + p * 10.0 + 14.0)) AS app
  FROM (SELECT *, (police_density - police_per_lakh) / CAST(100 AS DOUBLE) AS p,
      (patrol - 45) / CAST(100 AS DOUBLE) AS a, (20 - response) / CAST(20 AS DOUBLE) AS e,
      (target - conviction_rate) / CAST(100 AS DOUBLE) AS c, (watch - 30) / CAST(100 AS DOUBLE) AS w
    FROM profiles, (VALUES {_SCENARIO_ROWS}) AS v(scenario, police_density, patrol, response, target, watch))))"""


def _compare(spark, folder):
    table = _place_table(spark, folder)
    return profiles.compare_places(table, profiles.neighbour_pairs(table))


def _week(spark, folder):
    events = trade.table(spark, folder, "events")
    return calendar.week_matrix(calendar.measured_week(events), "events").select(
        "hour", *[F.col("row")[i].alias(d.lower()) for i, d in enumerate(DAYS)])


def _apportioned_week(spark, folder):
    yearly = rollups.year_rollup(feature_group_stage(spark, folder)).select(
        "year", (F.col("total_crimes") * 1000).alias("total_crimes"))
    return calendar.apportion_week(yearly)


def _apportioned_seasons(spark, folder):
    latest = rollups.latest_year(feature_group_stage(spark, folder))
    return calendar.apportion_seasons(latest)


_WEEK_ROWS = ", ".join(f"({i}, '{n}', CAST({w} AS DOUBLE))" for i, (n, w) in enumerate(zip(DAYS, DAY_WEIGHTS)))
_SEASON_ROWS = ", ".join(f"('{n}', CAST({w} AS DOUBLE), '{d}')" for n, w, d in SEASON_WEIGHTS)
_MONTHS = "month(o_orderdate)"

TOP_YEARLY_SQL = f"""SELECT YEAR AS year, CAST(rank AS INTEGER) AS rank, DISTRICT AS district, STATE_UT AS state,
  round(LATITUDE, 4) AS lat, round(LONGITUDE, 4) AS lon, {TOTAL} AS total_crimes,
  VIOLENT_CRIMES AS violent_crimes, WOMEN_CRIMES AS women_crimes, {r('VIOLENT_CRIME_RATIO * 100', 1)} AS violent_pct,
  CASE WHEN risk > 0.6 THEN 'CRITICAL' ELSE 'ELEVATED' END AS risk_level
FROM (SELECT *, row_number() OVER (PARTITION BY YEAR ORDER BY {TOTAL} DESC, STATE_UT, DISTRICT) AS rank,
        percent_rank() OVER (PARTITION BY YEAR ORDER BY DISTRICT_RISK_SCORE) AS risk FROM features)
WHERE rank <= 10"""

QUERIES = [
    Query("district_rollup", "A1", on_groups(rollups.district_rollup), over_features(
        f"SELECT DISTRICT AS district, STATE_UT AS state, arg_min(LATITUDE, YEAR) AS lat, "
        f"arg_min(LONGITUDE, YEAR) AS lon, {_sum_sql(SUMS)}, count(*) AS years_reported "
        "FROM features GROUP BY DISTRICT, STATE_UT")),
    Query("state_rollup", "A2 K2", on_groups(rollups.state_ranking), over_features(
        f"SELECT STATE_UT AS state, {_sum_sql(SUMS)} FROM features GROUP BY STATE_UT")),
    Query("year_rollup", "A3 K3", on_groups(lambda f: rollups.year_rollup(f).orderBy("year")), over_features(
        f"SELECT YEAR AS year, {_sum_sql(ALL_SUMS)} FROM features GROUP BY YEAR")),
    Query("year_rollup_with_total", "A3 A4", on_groups(
        lambda f: rollups.year_rollup_with_total(f).withColumn(
            "year", F.coalesce(F.col("year").cast("string"), F.lit("all")))), over_features(
        f"SELECT coalesce(CAST(YEAR AS VARCHAR), 'all') AS year, {_sum_sql(ALL_SUMS)} FROM features GROUP BY ROLLUP (YEAR)")),
    Query("grand_total", "A4", on_groups(rollups.grand_total), over_features(
        f"SELECT CAST(sum({TOTAL}) AS BIGINT) AS total_national_crimes FROM features")),
    Query("top_districts", "K1 K7", on_groups(rollups.top_districts), over_features(
        f"SELECT DISTRICT AS district, STATE_UT AS state, arg_min(LATITUDE, YEAR) AS lat, "
        f"arg_min(LONGITUDE, YEAR) AS lon, {_sum_sql(SUMS)}, count(*) AS years_reported "
        "FROM features GROUP BY DISTRICT, STATE_UT ORDER BY total_crimes DESC, state, district LIMIT 20")),
    Query("hotspots", "K1 P14 P15", on_groups(rollups.hotspots), over_features(HOTSPOT_SQL)),
    Query("filtered_hotspots", "F5", on_groups(lambda f: rollups.filter_hotspots(
        rollups.hotspots(f), "CRITICAL", 600)), over_features(
        f"SELECT * FROM ({HOTSPOT_SQL}) WHERE total_crimes >= 600 AND risk_level = 'CRITICAL'")),
    Query("property_recovery", "A5 P14 P19", _recovery, RECOVERY_SQL),
    Query("mean_recovery_rate", "A21", lambda s, d: rollups.mean_recovery_rate(_recovery(s, d)),
          f"SELECT {r('avg(financial_recovery_rate_pct)', 2)} AS mean_recovery_rate_pct FROM ({RECOVERY_SQL})"),
    Query("women_ranking", "A6 K2", lambda s, d: rollups.women_ranking(clean_stage(s, d)), over_clean(
        f"""SELECT STATE_UT AS state, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {n}' for n, c in rollups.WOMEN_HEADS.items())},
          CAST(sum({' + '.join(rollups.WOMEN_HEADS.values())}) AS BIGINT) AS total_crimes_against_women
        FROM clean GROUP BY STATE_UT""")),
    Query("region_states", "A7", _regional(rollups.region_states), over_regional(
        f"SELECT region, STATE_UT AS state, {_sum_sql(SUMS)}, "
        f"{_share('sum(VIOLENT_CRIMES)', f'sum({TOTAL})', 1)} AS violent_pct FROM regional GROUP BY region, STATE_UT")),
    Query("region_totals", "A7", _regional(rollups.region_totals), over_regional(
        f"SELECT region, {_sum_sql(SUMS)}, count(DISTINCT STATE_UT) AS states_count FROM regional GROUP BY region")),
    Query("regional_year", "A22", _regional(rollups.regional_year), over_regional(
        f"SELECT YEAR AS year, region, {_sum_sql({k: SUMS[k] for k in ('total_crimes', 'violent_crimes', 'women_crimes')})}, "
        "count(DISTINCT STATE_UT) AS states_count FROM regional GROUP BY YEAR, region")),
    Query("region_filter", "F6", _regional(lambda f: rollups.filter_region(rollups.region_states(f), "ASIA")),
          over_regional(
        f"SELECT region, STATE_UT AS state, {_sum_sql(SUMS)}, "
        f"{_share('sum(VIOLENT_CRIMES)', f'sum({TOTAL})', 1)} AS violent_pct FROM regional "
        "WHERE region = 'ASIA' GROUP BY region, STATE_UT")),
    Query("yearly_grains", "A8 P14", on_groups(rollups.yearly_grains), over_features(
        f"SELECT YEAR AS year, upper(STATE_UT) AS state, {_sum_sql(SUMS)}, "
        f"{_share('sum(VIOLENT_CRIMES)', f'sum({TOTAL})', 1)} AS violent_pct FROM features "
        "GROUP BY GROUPING SETS ((YEAR, upper(STATE_UT)), (YEAR))")),
    Query("yearly_top_districts", "W4 A8 P15", on_groups(rollups.yearly_top_districts), over_features(TOP_YEARLY_SQL)),
    Query("last_seen", "A14 U4", lambda s, d: rollups.last_seen(clean_stage(s, d)), over_clean(
        f"SELECT STATE_UT AS state, DISTRICT AS district, arg_min(LATITUDE, YEAR) AS lat, "
        f"arg_min(LONGITUDE, YEAR) AS lon, arg_max({TOTAL}, YEAR) AS recent_crimes FROM clean GROUP BY STATE_UT, DISTRICT")),
    Query("latest_year", "A20", on_groups(rollups.latest_year), over_features(
        f"SELECT YEAR AS year, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes FROM features GROUP BY YEAR "
        "ORDER BY YEAR DESC LIMIT 1")),
    Query("map_classes", "P20", _classes, over_features(
        f"SELECT STATE_UT AS state, {_class_sql(_share('sum(VIOLENT_CRIMES)', f'sum({TOTAL})', 1), 'violent_pct')} AS violent_class, "
        f"{_class_sql('sum(WOMEN_CRIMES) * 100', 'women_crimes')} AS women_class, "
        f"{_class_sql(f'sum({TOTAL}) * 1000', 'total_crimes')} AS total_class FROM features GROUP BY STATE_UT")),
    Query("place_profiles", "A9 K4 P13 P14 P16 P17 P18", _place_table, over_features("SELECT * FROM profiles", PROFILES)),
    Query("profile_search", "F7 K7", lambda s, d: profiles.search_profiles(_place_table(s, d), "Nation_1"), over_features(
        "SELECT * FROM profiles WHERE contains(lower(district), 'nation_1') OR contains(lower(state), 'nation_1') "
        "OR contains(lower(archetype), 'nation_1') ORDER BY total_crimes DESC, state, district LIMIT 50", PROFILES)),
    Query("profile_comparison", "J10", _compare, over_features(
        f"""SELECT a.state AS state_a, a.district AS district_a, b.state AS state_b, b.district AS district_b,
          a.archetype AS archetype_a, b.archetype AS archetype_b,
          {', '.join(f'a.{m} AS {m}_a, b.{m} AS {m}_b, ' + r(f'CAST(a.{m} AS DOUBLE) - CAST(b.{m} AS DOUBLE)', 2)
                     + f' AS {m}_diff' for m in COMPARED)}
        FROM numbered a JOIN numbered b ON b.n = a.n + 1""",
        PROFILES + """, numbered AS (SELECT *, row_number() OVER (
          ORDER BY total_crimes DESC, state, district) AS n FROM profiles)""")),
    Query("scenario_projection", "X1", lambda s, d: profiles.project_scenarios(_place_table(s, d), SCENARIOS, years=7),
          over_features(PROJECTION_SQL, PROFILES)),
    Query("seasonal_shares", "P29 J12 A20", _apportioned_seasons, over_features(
        f"""SELECT YEAR AS year, season, CAST(floor(total * weight) AS BIGINT) AS estimated_crimes,
          {r('weight * 100', 1)} AS percentage, description
        FROM (SELECT YEAR, CAST(sum({TOTAL}) AS DOUBLE) AS total FROM features GROUP BY YEAR ORDER BY YEAR DESC LIMIT 1),
          (VALUES {_SEASON_ROWS}) AS v(season, weight, description)""")),
    Query("expected_week", "P29 J12", _apportioned_week, over_features(
        f"""SELECT YEAR AS year, CAST(hour AS INTEGER) AS hour, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS hour_label,
          day, day_name, CAST(floor(total * CASE WHEN hour >= 20 OR hour <= 2 THEN CAST(0.065 AS DOUBLE)
            WHEN hour BETWEEN 9 AND 19 THEN CAST(0.045 AS DOUBLE) ELSE CAST(0.015 AS DOUBLE) END * w / 52) AS BIGINT) AS expected
        FROM (SELECT YEAR, CAST(sum({TOTAL}) * 1000 AS DOUBLE) AS total FROM features GROUP BY YEAR),
          range(24) AS h(hour), (VALUES {_WEEK_ROWS}) AS v(day, day_name, w)""")),
    Query("measured_week", "A19", _week,
          "SELECT CAST(hour(ts) AS INTEGER) AS hour, " + ", ".join(
              f"count(*) FILTER (WHERE isodow(ts) = {i + 1}) AS {d.lower()}" for i, d in enumerate(DAYS))
          + " FROM events GROUP BY hour(ts)"),
    Query("hour_labels", "P23 A19", lambda s, d: trade.table(s, d, "events").groupBy(
        hour_label(F.col("ts")).alias("hour_label"), "event_type").agg(F.count(F.lit(1)).alias("events")),
        "SELECT lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS hour_label, event_type, count(*) AS events "
        "FROM events GROUP BY hour(ts), event_type"),
    Query("measured_seasons", "A19", lambda s, d: calendar.measured_seasons(trade.table(s, d, "orders"), "o_orderdate"),
          f"""SELECT CASE WHEN {_MONTHS} IN (12, 1, 2) THEN 'Winter (Dec-Feb)'
            WHEN {_MONTHS} BETWEEN 3 AND 5 THEN 'Summer (Mar-May)' WHEN {_MONTHS} BETWEEN 6 AND 8
            THEN 'Monsoon (Jun-Aug)' ELSE 'Festive / Autumn (Sep-Nov)' END AS season, count(*) AS "rows"
          FROM orders GROUP BY ALL"""),
]
