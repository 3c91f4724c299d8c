"""Severity classification."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.hashing import stable_bucket
from tallyfold.learning.clustering import assembler
from tallyfold.schema import DISTRICT, LABEL, MODEL_FEATURES, STATE, YEAR
from tallyfold.sources.literals import constant_table

# Trees, depth, seed and share of training rows in percent.
TREES, DEPTH, SEED, TRAIN_PERCENT = 100, 10, 42, 80


def split_rows(df: DataFrame, keys: tuple[str, ...] = (STATE, DISTRICT, YEAR),
               percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds ``is_train``; a row's side follows from its key alone.

    Unlike a random split it stays the same when rows are repartitioned or a
    lost executor's tasks run again.
    """
    bucket = stable_bucket(100, *[F.col(k) for k in keys])
    return df.withColumn("is_train", (bucket < percent).cast("int"))


def fit_severity(train: DataFrame, columns: list[str] | None = None, label: str = LABEL,
                 trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> PipelineModel:
    """A fitted forest without its training summary.

    Each row's tree nodes are kept between levels, so the growing trees are not
    sent out again; with ``spark.checkpoint.dir`` set they are checkpointed. The
    summary holds the session, which cannot be sent to executors once the
    session has observed a metric; a copy of the model leaves it behind.
    """
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees,
                                    maxDepth=depth, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[assembler(columns or MODEL_FEATURES), forest]).fit(train).copy()


def score_severity(model: PipelineModel, df: DataFrame, cut: float = 0.5) -> DataFrame:
    """Rows with the probability of high severity and the decision."""
    scored = model.transform(df)
    p = vector_to_array("probability")[1]
    return scored.withColumns({"risk_probability": p, "predicted": (p >= cut).cast("int")}).drop(
        "features", "rawPrediction", "probability", "prediction")


def model_quality(model: PipelineModel, test: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Area under the ROC curve and accuracy."""
    scored = model.transform(test)
    return {
        "auc_roc": BinaryClassificationEvaluator(labelCol=label).evaluate(scored),
        "accuracy": MulticlassClassificationEvaluator(
            labelCol=label, metricName="accuracy").evaluate(scored),
    }


def importances(model: PipelineModel, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Inputs by importance, four decimals, ranked."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, round(float(v), 4)) for c, v in zip(columns or MODEL_FEATURES, values)]
    table = constant_table(df.sparkSession, ["feature", "importance"], rows)
    # One row per model input.
    return table.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))
