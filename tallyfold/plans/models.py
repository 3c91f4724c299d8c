"""Models fitted on the feature stage, stored once per session and folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallyfold.learning import severity
from tallyfold.plans.stages import feature_stage
from tallyfold.session import scratch_path
from tallyfold.sources.models import load_model, save_model

_stored: dict[tuple[str, str], str] = {}


def train_and_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = severity.split_rows(feature_stage(spark, folder))
    return rows.filter("is_train = 1"), rows.filter("is_train = 0")


def severity_model(spark: SparkSession, folder: str) -> PipelineModel:
    """The forest, loaded from where the first call saved it."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stored:
        path = scratch_path(spark, "severity_model")
        train, _ = train_and_test(spark, folder)
        save_model(severity.fit_severity(train), path)
        _stored[key] = path
    return load_model(_stored[key])
