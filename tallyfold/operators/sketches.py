"""Quantiles from sketches that are stored and merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries a sketch keeps; its rank error is about 2.3 / K ** 0.9.
K = 400


def rank_error(k: int = K) -> float:
    """Share of all values by which a single quantile's rank may be off, with 99 % confidence."""
    return 2.296 / k ** 0.9021


def sketch_values(df: DataFrame, groups: list[str], value: str, k: int = K) -> DataFrame:
    """One row per group with a sketch of its whole-number values; nulls are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*groups).agg(
        F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """One sketch per group of rows that hold sketches."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, groups: list[str], share: float, alias: str) -> DataFrame:
    """The value at a share of a sketch, with the number of values it stands for."""
    return sketches.select(*groups, F.kll_sketch_get_n_bigint("sketch").alias("n"),
                           F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias(alias))


class SketchStore:
    """Sketches by group and part of the data, in a folder.

    A part (a delivery, a file group) is sketched once, when it comes; adding it again replaces it. Quantiles over any
    parts come from the stored sketches alone: old data are not read again.
    """

    def __init__(self, path: str, groups: list[str], value: str, k: int = K):
        self.path, self.groups, self.value, self.k = path, groups, value, k

    def add(self, df: DataFrame, part: str) -> None:
        sketch_values(df, self.groups, self.value, self.k).write.mode("overwrite").parquet(f"{self.path}/part={part}")

    def quantiles(self, spark: SparkSession, share: float, alias: str, parts: list[str] | None = None) -> DataFrame:
        folders = [f"{self.path}/part={p}" for p in parts] if parts else [f"{self.path}/part=*"]
        return sketch_quantiles(merge_sketches(spark.read.parquet(*folders), self.groups), self.groups, share, alias)
