"""Small tables whose rows are written in the code."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def constant_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Local relation of fixed rows; its size is known to the optimizer."""
    data = {c: [row[i] for row in rows] for i, c in enumerate(columns)}
    return spark.createDataFrame(pa.table(data))
