"""Measures of binary decisions as plain aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.ordering import running_totals, unit_levels


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """The four counts in one row."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.agg(F.count_if(y & p).alias("true_positive"), F.count_if(~y & p).alias("false_positive"),
                  F.count_if(~y & ~p).alias("true_negative"), F.count_if(y & ~p).alias("false_negative"))


def decision_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1, zero where undefined."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in (
        "true_positive", "false_positive", "true_negative", "false_negative"))

    def guarded(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    precision, recall = guarded(tp, tp + fp), guarded(tp, tp + fn)
    f1 = guarded(precision * recall * 2, precision + recall)
    return counts.select(
        F.round(guarded(tp + tn, tp + fp + tn + fn), 4).alias("accuracy"),
        F.round(precision, 4).alias("precision"), F.round(recall, 4).alias("recall"),
        F.round(f1, 4).alias("f1_score"))


def roc_area(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve of scores in [0, 1].

    Equal scores are counted together; every positive beats the negatives with a
    smaller score and half of those with the same. Rows with a null score or label
    take no part; scores outside [0, 1] are placed like any other.
    """
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counted = known.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    placed = running_totals(counted, [], score, ["neg"], unit_levels(score))
    # Halves are kept whole by doubling; the products outgrow 64 bits.
    wins = F.col("pos").cast("decimal(19,0)") * (F.col("before_neg") * 2 + F.col("neg"))
    sums = placed.agg(F.sum(wins).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = F.col("p").cast("double") * F.col("n").cast("double") * 2
    return sums.select(F.round(F.try_divide(F.col("w").cast("double"), pairs), 6).alias("auc_roc"))


def correlation_ranking(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Inputs by absolute correlation with the label, scaled to sum to one.

    All correlations come from one aggregation; an input without spread gets zero,
    where ``corr`` itself would raise in ANSI mode.
    """
    def strength(c):
        x, y = F.col(c).cast("double"), F.col(label).cast("double")
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        return F.coalesce(F.abs(r), F.lit(0.0))

    row = df.agg(F.array(*[F.struct(F.lit(c).alias("feature"), strength(c).alias("s"))
                           for c in columns]).alias("a"))
    whole = F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x["s"])
    rows = row.select(F.when(whole > 0, whole).otherwise(1.0).alias("whole"), F.inline("a"))
    scaled = rows.select("feature", F.round(F.col("s") / F.col("whole"), 4).alias("importance"))
    # One row per input.
    return scaled.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc("importance"), "feature")))


def report_rows(frames: list[DataFrame]) -> DataFrame:
    """One-row measure tables as (metric, value) rows."""
    long = [df.select([F.col(c).cast("double") for c in df.columns])
            .unpivot([], df.columns, "metric", "value") for df in frames]
    return reduce(DataFrame.unionByName, long)
