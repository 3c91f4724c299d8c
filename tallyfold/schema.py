"""Column names and schemas of the fact table at its three stages."""

from __future__ import annotations

from pyspark.sql import types as T

# The canonical column names of the yearly fact table.
STATE = "STATE_UT"
DISTRICT = "DISTRICT"
YEAR = "YEAR"
TOTAL = "TOTAL_IPC_CRIMES"
LAT = "LATITUDE"
LON = "LONGITUDE"

HEADS = [
    "MURDER", "ATTEMPT_TO_MURDER", "CULPABLE_HOMICIDE", "RAPE",
    "KIDNAPPING_ABDUCTION", "DACOITY", "ROBBERY", "BURGLARY", "THEFT",
    "AUTO_THEFT", "RIOTS", "CHEATING", "ARSON", "HURT", "DOWRY_DEATHS",
    "ASSAULT_ON_WOMEN", "INSULT_TO_MODESTY_OF_WOMEN", "CRUELTY_BY_HUSBAND",
]

# Which heads make up each category.
CATEGORIES = {
    "VIOLENT_CRIMES": ["MURDER", "ATTEMPT_TO_MURDER", "CULPABLE_HOMICIDE",
                       "DACOITY", "ROBBERY", "HURT", "KIDNAPPING_ABDUCTION"],
    "PROPERTY_CRIMES": ["BURGLARY", "THEFT", "AUTO_THEFT"],
    "WOMEN_CRIMES": ["RAPE", "DOWRY_DEATHS", "ASSAULT_ON_WOMEN",
                     "INSULT_TO_MODESTY_OF_WOMEN", "CRUELTY_BY_HUSBAND"],
    "ECONOMIC_CRIMES": ["CHEATING", "ARSON"],
}
OTHER = "OTHER_CRIMES"

# Heads whose sum the reported total must not undercut.
RECONCILED_HEADS = [
    "MURDER", "ATTEMPT_TO_MURDER", "RAPE", "KIDNAPPING_ABDUCTION", "DACOITY",
    "ROBBERY", "BURGLARY", "THEFT", "RIOTS", "CHEATING", "ARSON", "HURT",
]

# The twelve model inputs.
MODEL_FEATURES = [
    "DISTRICT_RISK_SCORE", "CRIME_RATE_PER_100K", "POPULATION_DENSITY",
    "LITERACY_RATE", "URBAN_PERCENTAGE", "POLICE_PER_LAKH", "CHARGESHEET_RATE",
    "VIOLENT_CRIME_RATIO", "PROPERTY_CRIME_RATIO", "WOMEN_CRIME_RATIO",
    "ECONOMIC_CRIME_RATIO", "YEAR",
]
LABEL = "HIGH_SEVERITY_FLAG"


def _measures(names):
    # Counts are 64-bit: one busy place at large scale passes the 32-bit range.
    return [T.StructField(name, T.LongType(), True) for name in names]


_KEYS = [
    T.StructField(STATE, T.StringType(), False),
    T.StructField(DISTRICT, T.StringType(), False),
    T.StructField(YEAR, T.IntegerType(), False),
]
_POINT = [T.StructField(LAT, T.DoubleType(), True), T.StructField(LON, T.DoubleType(), True)]

RAW_SCHEMA = T.StructType(_KEYS + _measures(HEADS + [TOTAL]))
CLEAN_SCHEMA = T.StructType(_KEYS + _POINT + _measures(HEADS + [TOTAL]))
FEATURE_SCHEMA = T.StructType(
    _KEYS + _POINT
    + _measures([TOTAL, *CATEGORIES, OTHER])
    + [T.StructField(n, T.DoubleType(), True) for n in (
        "VIOLENT_CRIME_RATIO", "PROPERTY_CRIME_RATIO", "WOMEN_CRIME_RATIO",
        "ECONOMIC_CRIME_RATIO", "DISTRICT_RISK_SCORE", "STATE_RISK_SCORE")]
    + [T.StructField("POPULATION", T.LongType(), True)]
    + [T.StructField(n, T.DoubleType(), True) for n in (
        "POPULATION_DENSITY", "LITERACY_RATE", "URBAN_PERCENTAGE",
        "CRIME_RATE_PER_100K", "VIOLENT_RATE_PER_100K", "POLICE_PER_LAKH",
        "CHARGESHEET_RATE", "CONVICTION_RATE")]
    + [T.StructField("CYBER_CRIMES", T.LongType(), True),
       T.StructField(LABEL, T.IntegerType(), True),
       T.StructField("LOCATION_CLUSTER", T.IntegerType(), True)]
)

#: How many feature rows a row of ``FEATURE_GROUP_SCHEMA`` stands for.
COPIES = "FEATURE_ROWS"
#: Columns of a feature row that come from dimensions with possibly several rows of a place.
DIMENSION_COLUMNS = [
    "POPULATION", "POPULATION_DENSITY", "LITERACY_RATE", "URBAN_PERCENTAGE", "CRIME_RATE_PER_100K",
    "VIOLENT_RATE_PER_100K", "POLICE_PER_LAKH", "CHARGESHEET_RATE", "CONVICTION_RATE",
]
#: Those of which a feature group holds the sum over its feature rows, named with ``SUM_OF``.
SUMMED_COLUMNS = ["POPULATION", "LITERACY_RATE", "URBAN_PERCENTAGE", "POLICE_PER_LAKH", "CHARGESHEET_RATE", "CONVICTION_RATE"]
SUM_OF = "SUM_OF_"
FEATURE_GROUP_SCHEMA = T.StructType(
    [f for f in FEATURE_SCHEMA.fields if f.name not in DIMENSION_COLUMNS] + _measures([COPIES])
    + [T.StructField(SUM_OF + c, T.DecimalType(38, 6), True) for c in SUMMED_COLUMNS])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("primary_type", T.StringType()),
    T.StructField("incident_count", T.LongType()),
    T.StructField("source", T.StringType()),
])
