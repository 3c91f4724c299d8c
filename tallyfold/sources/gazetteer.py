"""Place coordinates kept as one nested JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.text import name_key

GAZETTEER_TYPE = (
    "districts map<string, struct<lat: double, lon: double, state: string>>, "
    "state_fallbacks map<string, array<double>>"
)


def read_gazetteer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(districts, states) as flat tables.

    ``position`` is the entry's place in the document: where several entries
    match a name, the earliest one counts.
    """
    doc = spark.read.schema(GAZETTEER_TYPE).option("multiLine", True).json(path)
    districts = doc.select(F.posexplode("districts").alias("position", "name", "at")).select(
        F.col("position").cast("bigint").alias("position"),
        name_key(F.col("name")).alias("gaz_name"),
        name_key(F.col("at.state")).alias("gaz_state"),
        F.col("at.lat").alias("gaz_lat"),
        F.col("at.lon").alias("gaz_lon"),
    )
    states = doc.select(F.explode("state_fallbacks").alias("name", "at")).select(
        name_key(F.col("name")).alias("centroid_state"),
        F.element_at("at", 1).alias("centroid_lat"),
        F.element_at("at", 2).alias("centroid_lon"),
    )
    return districts, states
