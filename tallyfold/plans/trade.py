"""The yearly fact table and its dimensions derived from order-line tables.

States are nations, districts are suppliers, years are shipping years. A line
counts towards one of the eighteen heads by its part type and return flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.schema import DISTRICT, HEADS, LAT, LON, STATE, TOTAL, YEAR

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
RETURN_FLAGS = ["A", "N", "R"]
HEAD_SOURCES = dict(zip(HEADS, [(t, r) for t in PART_TYPES for r in RETURN_FLAGS]))


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table. Its schema is read from the footers once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier, nation and region names."""
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", "s_acctbal", "n_nationkey", "r_regionkey",
                    F.col("s_name").alias(DISTRICT), F.col("n_name").alias(STATE),
                    F.col("r_name").alias("region")))


def raw_facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (state, district, year) with eighteen heads and the total.

    Lines meet parts on the part key and are then counted per supplier and year
    with partial counts on the map side, so a supplier with very many lines
    sends one row per task and year. Names join the few counted rows.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_returnflag", F.year("l_shipdate").alias(YEAR))
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    typed = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    counted = typed.groupBy("l_suppkey", YEAR).agg(
        *[F.count_if((F.col("p_type") == t) & (F.col("l_returnflag") == r)).alias(h)
          for h, (t, r) in HEAD_SOURCES.items()],
        F.count(F.lit(1)).alias(TOTAL))
    named = counted.join(places(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
    return named.select(STATE, DISTRICT, YEAR, *HEADS, TOTAL)


def demographics(spark: SparkSession, folder: str) -> DataFrame:
    """Census-like figures of the suppliers in credit; the others go without."""
    key = F.col("s_suppkey")
    return places(spark, folder).filter(F.col("s_acctbal") > 0).select(
        STATE, DISTRICT,
        (F.lit(20000) + F.pmod(key * 7919, F.lit(2000000))).cast("bigint").alias("POPULATION"),
        (F.lit(100) + F.pmod(key, F.lit(900))).cast("double").alias("POPULATION_DENSITY"),
        (F.lit(50) + F.pmod(key, F.lit(45))).cast("double").alias("LITERACY_RATE"),
        (F.lit(10) + F.pmod(key, F.lit(80))).cast("double").alias("URBAN_PERCENTAGE"))


def police(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return places(spark, folder).filter(F.col("s_acctbal") > 2000).select(
        STATE, DISTRICT,
        (F.lit(80) + F.pmod(key, F.lit(200))).cast("double").alias("POLICE_PER_LAKH"),
        (F.lit(50) + F.pmod(key, F.lit(45))).cast("double").alias("CHARGESHEET_RATE"),
        (F.lit(20) + F.pmod(key, F.lit(60))).cast("double").alias("CONVICTION_RATE"))


def cyber(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly counts of open discounted lines since 1997."""
    lines = table(spark, folder, "lineitem").filter(
        (F.col("l_linestatus") == "O") & (F.col("l_discount") >= 0.05)
        & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")))
    counted = lines.groupBy("l_suppkey", F.year("l_shipdate").alias(YEAR)).agg(
        F.count(F.lit(1)).alias("CYBER_CRIMES"))
    return (counted.join(places(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(STATE, DISTRICT, YEAR, "CYBER_CRIMES"))


def gazetteer(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Coordinates of half the suppliers, and of the nations of four regions."""
    key = F.col("s_suppkey")
    known = places(spark, folder).filter(F.pmod(key, F.lit(2)) == 0).select(
        key.alias("position"), F.upper(DISTRICT).alias("gaz_name"), F.upper(STATE).alias("gaz_state"),
        (F.lit(800) + F.pmod(key * 37, F.lit(2900))).cast("double").alias("_lat"),
        (F.lit(6800) + F.pmod(key * 53, F.lit(2900))).cast("double").alias("_lon"))
    districts = known.select("position", "gaz_name", "gaz_state",
                             (F.col("_lat") / 100).alias("gaz_lat"), (F.col("_lon") / 100).alias("gaz_lon"))
    nation = table(spark, folder, "nation").filter(F.col("n_regionkey") < 4)
    states = nation.select(
        F.upper("n_name").alias("centroid_state"),
        (F.lit(10.0) + F.col("n_nationkey")).alias("centroid_lat"),
        (F.lit(70.0) + F.col("n_nationkey")).alias("centroid_lon"))
    return districts, states


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """State to region, without the last region so that the default is used."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region").filter(F.col("r_regionkey") < 4)
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.upper("n_name").alias("state_key"), F.col("r_name").alias("region"))


def recovery_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Order values per year; finished orders count as recovered."""
    done = F.col("o_orderstatus") == "F"
    return table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("value_stolen"),
        F.when(done, F.col("o_totalprice")).otherwise(0.0).alias("value_recovered"),
        F.lit(1).alias("cases_stolen"), F.when(done, 1).otherwise(0).alias("cases_recovered"))


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Click events as incident events: the user is the district."""
    return as_incidents(table(spark, folder, "events"))


def as_incidents(events: DataFrame) -> DataFrame:
    """``events`` rows, static or streaming, in the incident shape."""
    user = F.col("user_id")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("S"), F.pmod(user, F.lit(10))).alias("state"),
        F.when(F.pmod(user, F.lit(29)) != 0, F.concat(F.lit("U"), user)).alias("district"),
        F.year("ts").alias("year"),
        F.when(F.col("event_type") != "view", F.upper("event_type")).alias("primary_type"),
        F.when(F.col("value") >= 1, F.floor("value")).alias("incident_count"),
        F.lit("FEED").alias("source"))
