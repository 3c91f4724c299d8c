"""Stored stages: raw facts, clean facts and features.

Every report reads the feature stage, or, where it only sums rows up, the feature group stage, which has one row for all
feature rows of a clean row. A stage is written once per session and
source folder to the shared scratch location and then scanned like any other
table, so lost executors only cost re-reading it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.text import title_case
from tallyfold.operators.cleaning import clean_facts
from tallyfold.operators.coordinates import locate
from tallyfold.operators.features import build_feature_groups, build_features
from tallyfold.plans import trade
from tallyfold.schema import CLEAN_SCHEMA, DISTRICT, FEATURE_GROUP_SCHEMA, FEATURE_SCHEMA, RAW_SCHEMA, STATE, TOTAL, YEAR
from tallyfold.session import scratch_path
from tallyfold.sources.tables import read_table, write_partitioned

_written: dict[tuple[str, str, str], str] = {}


def refresh() -> None:
    """Forgets which stages were written, so that changed tables are read again; stored files stay."""
    _written.clear()


def stage_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Folders of the three stages by table name; stages that are not there yet are written."""
    for stage in (raw_stage, clean_stage, feature_stage):
        stage(spark, folder)
    app = spark.sparkContext.applicationId
    return {table: _written[app, folder, name] for table, name in (
        ("crimes_raw", "facts_raw"), ("crimes_clean", "facts_clean"), ("crimes_features", "features"))}


def _stage(spark: SparkSession, folder: str, name: str, build, schema) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write_partitioned(build(), path, (YEAR,))
        _written[key] = path
    return read_table(spark, _written[key], schema)


def raw_stage(spark: SparkSession, folder: str) -> DataFrame:
    return _stage(spark, folder, "facts_raw", lambda: trade.raw_facts(spark, folder), RAW_SCHEMA)


def _cleaned(raw: DataFrame) -> DataFrame:
    return clean_facts(raw, [F.col(TOTAL).desc()], first_year=1995)


def _located(spark: SparkSession, folder: str, clean: DataFrame) -> DataFrame:
    places, centroids = trade.gazetteer(spark, folder)
    names = trade.places(spark, folder).select(
        F.col(STATE).alias("STATE_RAW"), title_case(F.col(DISTRICT)).alias(DISTRICT))
    located = locate(clean, places, centroids, names=names)
    return located.select([f.name for f in CLEAN_SCHEMA.fields])


def clean_stage(spark: SparkSession, folder: str) -> DataFrame:
    return _stage(spark, folder, "facts_clean",
                  lambda: _located(spark, folder, _cleaned(raw_stage(spark, folder))), CLEAN_SCHEMA)


def feature_stage(spark: SparkSession, folder: str) -> DataFrame:
    def build():
        return build_features(
            clean_stage(spark, folder), trade.demographics(spark, folder),
            trade.police(spark, folder), trade.cyber(spark, folder))
    return _stage(spark, folder, "features", build, FEATURE_SCHEMA)


def feature_group_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Features for sums: where places repeat in the dimensions, it has no row for each pair of their rows."""
    def build():
        return build_feature_groups(
            clean_stage(spark, folder), trade.demographics(spark, folder),
            trade.police(spark, folder), trade.cyber(spark, folder))
    return _stage(spark, folder, "feature_groups", build, FEATURE_GROUP_SCHEMA)


def direct_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features as one lazy plan without stored stages.

    The yearly thresholds and state means read the facts again, so lines are
    scanned several times; stages are the better choice for more than one report.
    """
    clean = _cleaned(trade.raw_facts(spark, folder))
    return build_features(
        _located(spark, folder, clean), trade.demographics(spark, folder),
        trade.police(spark, folder), trade.cyber(spark, folder), totals=clean)
