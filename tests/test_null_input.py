"""Nulls in scores, values and keys."""

from pyspark.sql import functions as F

from tallyfold.learning.metrics import roc_area
from tallyfold.operators.enrich import group_statistic
from tallyfold.operators.ordering import upper_quartile


def test_roc_area_leaves_null_scores_out(spark):
    rows = [(1, 0.9), (0, 0.2), (1, None), (0, None), (None, 0.5)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert roc_area(df, "label", "score").first()[0] == 1.0


def test_quartile_counts_values_only(spark):
    df = spark.createDataFrame([("a", n) for n in [*range(1, 9), None, None]] + [("b", None)], "g string, v long")
    assert [tuple(r) for r in upper_quartile(df, "g", "v").collect()] == [("a", 6.75)]


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([("a", 1), (None, 3), (None, 5)], "k string, v long")
    got = sorted((tuple(r) for r in group_statistic(df, ["k"], F.sum("v"), "total").collect()), key=str)
    assert got == sorted([("a", 1, 1), (None, 3, 8), (None, 5, 8)], key=str)
