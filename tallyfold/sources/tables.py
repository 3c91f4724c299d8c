"""Columnar tables: scan, partitioned write, catalog registration, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.schema import CLEAN_SCHEMA, FEATURE_SCHEMA, RAW_SCHEMA, STATE, YEAR


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a given schema saves the footer read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_partitioned(df: DataFrame, path: str,
                      keys: tuple[str, ...] = (YEAR, STATE)) -> None:
    """Overwrite Parquet, one folder per key combination.

    REBALANCE brings rows of one folder together, and adaptive execution then
    splits an oversized folder over several tasks and merges tiny ones.
    """
    (df.hint("rebalance", *[F.col(k) for k in keys])
     .write.mode("overwrite").partitionBy(*keys).parquet(path))


def audited_write(df: DataFrame, path: str,
                  keys: tuple[str, ...] = (YEAR, STATE)) -> dict[str, int]:
    """Partitioned write that counts its rows on the way, without a second pass."""
    seen = Observation()
    write_partitioned(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, keys)
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


def register_external(spark: SparkSession, name: str, schema: T.StructType, path: str,
                      keys: tuple[str, ...] = (YEAR, STATE)) -> DataFrame:
    """External partitioned table over existing files, with its partitions found."""
    body = [f for f in schema.fields if f.name not in keys]
    tail = [schema[k] for k in keys]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in body + tail)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def register_stages(spark: SparkSession, locations: dict[str, str], prefix: str = "",
                    keys: tuple[str, ...] = (YEAR, STATE)) -> dict[str, DataFrame]:
    """The external tables ``crimes_raw``, ``crimes_clean`` and ``crimes_features``.

    ``locations`` maps those names to their folders; schemas are the ones the
    writers use, so no column can be missing from a definition.
    """
    schemas = {"crimes_raw": RAW_SCHEMA, "crimes_clean": CLEAN_SCHEMA, "crimes_features": FEATURE_SCHEMA}
    return {name: register_external(spark, prefix + name, schemas[name], path, keys)
            for name, path in locations.items()}


def drop_registered(spark: SparkSession, names: list[str]) -> None:
    """Takes tables out of the catalog; the files of external ones stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
