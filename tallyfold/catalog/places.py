"""Coordinate and dimension lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.catalog.checks import (
    CLEAN, DIMENSIONS, LOCATED, RAW, REGIONS, bucket, over_clean, r, title,
)
from tallyfold.catalog.registry import Query
from tallyfold.functions.hashing import name_jitter
from tallyfold.operators import coordinates, enrich
from tallyfold.plans import trade
from tallyfold.plans.stages import clean_stage, raw_stage
from tallyfold.schema import DISTRICT, LAT, LON, STATE, TOTAL, YEAR


def _exact(spark, folder):
    places, _ = trade.gazetteer(spark, folder)
    names = trade.places(spark, folder).select("s_suppkey", F.upper(DISTRICT).alias("name"))
    return coordinates.exact_places(names, places, "name").select("s_suppkey", "name", "gaz_lat", "gaz_lon")


def _nation_gazetteer(spark, folder):
    """Every third nation as an entry, listed from the last key to the first."""
    nation = trade.table(spark, folder, "nation").filter(F.col("n_nationkey") % 3 == 1)
    return nation.select(
        (F.lit(100) - F.col("n_nationkey")).cast("bigint").alias("position"), F.col("n_name").alias("gaz_name"),
        F.concat(F.lit("ZONE "), F.col("n_nationkey") % 2).alias("gaz_state"),
        (F.lit(10.0) + F.col("n_nationkey")).alias("gaz_lat"), (F.lit(70.0) + F.col("n_nationkey")).alias("gaz_lon"))


def _overlaps(spark, folder, scoped):
    """Supplier names made of their nation's name, some cut short."""
    s = trade.table(spark, folder, "supplier")
    n = trade.table(spark, folder, "nation")
    name = F.when(F.pmod("s_suppkey", F.lit(7)) == 0, F.lit("NATION_1")).otherwise(
        F.concat(F.col("n_name"), F.lit(" CITY")))
    asked = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", name.alias("name"), F.concat(F.lit("ZONE "), F.pmod("s_suppkey", F.lit(2))).alias("zone"))
    near = coordinates.containing_places(asked, _nation_gazetteer(spark, folder), "name",
                                         "zone" if scoped else None)
    return asked.join(near, ["name"] + (["zone"] if scoped else [])).select("s_suppkey", "name", "gaz_name", "gaz_lat")


def _overlap_sql(scoped):
    test = "a.zone = g.zone AND " if scoped else ""
    return f"""WITH asked AS (SELECT s_suppkey, 'ZONE ' || (s_suppkey % 2) AS zone,
      CASE WHEN s_suppkey % 7 = 0 THEN 'NATION_1' ELSE n_name || ' CITY' END AS name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    g AS (SELECT 100 - n_nationkey AS position, n_name AS gaz_name, 'ZONE ' || (n_nationkey % 2) AS zone,
      CAST(10 + n_nationkey AS DOUBLE) AS gaz_lat FROM nation WHERE n_nationkey % 3 = 1)
    SELECT s_suppkey, name, arg_min(gaz_name, position) AS gaz_name, arg_min(gaz_lat, position) AS gaz_lat
    FROM asked a JOIN g ON {test}(contains(a.name, g.gaz_name) OR contains(g.gaz_name, a.name))
    GROUP BY s_suppkey, name"""


def _located(spark, folder):
    places, centroids = trade.gazetteer(spark, folder)
    facts = raw_stage(spark, folder).withColumn("STATE_RAW", F.col(STATE))
    return coordinates.locate(facts, places, centroids).select(STATE, DISTRICT, YEAR, LAT, LON, "LOCATED_BY")


def _jitter(spark, folder):
    return trade.table(spark, folder, "customer").select(
        "c_custkey", F.round(name_jitter(F.col("c_name")), 4).alias("jitter"))


def _regions(spark, folder):
    facts = raw_stage(spark, folder)
    return enrich.with_region(facts, trade.regions(spark, folder)).select(STATE, DISTRICT, YEAR, "region")


def _boundaries(spark, folder):
    nation = trade.table(spark, folder, "nation")
    shapes = nation.select(F.when(F.col("n_nationkey") == 4, F.lit("Old Four")).otherwise(
        F.initcap("n_name")).alias("boundary"))
    stats = (raw_stage(spark, folder).filter(F.col(STATE) < "NATION_7")
             .groupBy(F.upper(STATE).alias("state_key")).agg(F.sum(TOTAL).cast("bigint").alias("total_crimes")))
    return enrich.boundary_statistics(shapes, stats, trade.regions(spark, folder), "boundary", ["total_crimes"],
                                      {"OLD FOUR": "NATION_4"})


def _enriched(kind):
    def run(spark, folder):
        clean = clean_stage(spark, folder).select(STATE, DISTRICT, YEAR, TOTAL)
        if kind == "demographics":
            out = enrich.with_demographics(clean, trade.demographics(spark, folder))
        elif kind == "police":
            out = enrich.with_police(clean, trade.police(spark, folder))
        else:
            out = enrich.with_cyber(clean, trade.cyber(spark, folder))
        return out.drop(TOTAL)
    return run


def _enriched_sql(columns, dim, on):
    return (f"WITH {CLEAN}, {DIMENSIONS}\nSELECT k.STATE_UT, k.DISTRICT, k.YEAR, {columns} "
            f"FROM clean k LEFT JOIN {dim} d ON {on}")


def _group_statistic(spark, folder):
    facts = clean_stage(spark, folder).select(STATE, DISTRICT, YEAR, TOTAL)
    return enrich.group_statistic(facts, [YEAR], F.max(TOTAL), "year_max")


QUERIES = [
    Query("exact_places", "J1", _exact,
          """SELECT s_suppkey, upper(s_name) AS name,
             CASE WHEN s_suppkey % 2 = 0 THEN CAST(800 + (s_suppkey * 37) % 2900 AS DOUBLE) / 100 END AS gaz_lat,
             CASE WHEN s_suppkey % 2 = 0 THEN CAST(6800 + (s_suppkey * 53) % 2900 AS DOUBLE) / 100 END AS gaz_lon
             FROM supplier"""),
    Query("overlapping_places", "J2", lambda s, d: _overlaps(s, d, False), _overlap_sql(False)),
    Query("overlapping_places_in_state", "J2", lambda s, d: _overlaps(s, d, True), _overlap_sql(True)),
    Query("located_facts", "J3 P28", _located, f"""WITH {RAW}, {LOCATED}
        SELECT STATE_UT, DISTRICT, YEAR, LATITUDE, LONGITUDE, LOCATED_BY
        FROM raw_facts JOIN located ON raw_facts.s_suppkey = located.s_suppkey"""),
    Query("name_jitter", "P28", _jitter,
          f"SELECT c_custkey, {r('(' + bucket('c_name', 100) + ' - 50) * 0.005', 4)} AS jitter FROM customer"),
    Query("within_box", "F9", lambda s, d: coordinates.within_box(clean_stage(s, d), 12.0, 30.0, 72.0, 90.0).select(
        STATE, DISTRICT, YEAR), over_clean(
        "SELECT STATE_UT, DISTRICT, YEAR FROM clean WHERE LATITUDE BETWEEN 12 AND 30 AND LONGITUDE BETWEEN 72 AND 90")),
    Query("demographics_joined", "J4 P18", _enriched("demographics"), _enriched_sql(
        "coalesce(POPULATION, 1500000) AS POPULATION, coalesce(POPULATION_DENSITY, 500.0) AS POPULATION_DENSITY, "
        "coalesce(LITERACY_RATE, 74.0) AS LITERACY_RATE, coalesce(URBAN_PERCENTAGE, 30.0) AS URBAN_PERCENTAGE",
        "demographics", "k.s_suppkey = d.s_suppkey")),
    Query("police_joined", "J5", _enriched("police"), _enriched_sql(
        "coalesce(POLICE_PER_LAKH, 160.0) AS POLICE_PER_LAKH, coalesce(CHARGESHEET_RATE, 78.0) AS CHARGESHEET_RATE, "
        "coalesce(CONVICTION_RATE, 45.0) AS CONVICTION_RATE", "police", "k.s_suppkey = d.s_suppkey")),
    Query("cyber_joined", "J6", _enriched("cyber"), _enriched_sql(
        "coalesce(CYBER_CRIMES, 0) AS CYBER_CRIMES", "cyber", "k.s_suppkey = d.s_suppkey AND k.YEAR = d.YEAR")),
    Query("group_statistic", "J7", _group_statistic, over_clean(
        f"SELECT STATE_UT, DISTRICT, YEAR, {TOTAL}, max({TOTAL}) OVER (PARTITION BY YEAR) AS year_max FROM clean")),
    Query("regions_joined", "J8", _regions, f"""WITH {RAW}, {REGIONS}
        SELECT STATE_UT, DISTRICT, YEAR, coalesce(region, 'Northern') AS region
        FROM raw_facts LEFT JOIN state_regions ON upper(STATE_UT) = state_key"""),
    Query("boundary_statistics", "J11", _boundaries, f"""WITH {RAW}, {REGIONS},
        shapes AS (SELECT CASE WHEN n_nationkey = 4 THEN 'Old Four' ELSE {title('n_name')} END AS boundary,
          n_name AS state_key FROM nation),
        stats AS (SELECT STATE_UT AS state_key, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes
          FROM raw_facts WHERE STATE_UT < 'NATION_7' GROUP BY STATE_UT)
        SELECT s.state_key, boundary, coalesce(total_crimes, 0) AS total_crimes, coalesce(region, 'Other') AS region
        FROM shapes s LEFT JOIN stats t ON s.state_key = t.state_key
        LEFT JOIN state_regions g ON s.state_key = g.state_key"""),
]
