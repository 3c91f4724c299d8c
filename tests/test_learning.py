import pytest
from pyspark.sql import functions as F

from tallyfold.learning import clustering, metrics, severity
from tallyfold.operators.rollups import cluster_summary
from tallyfold.schema import LABEL
from tallyfold.sources.models import load_model, save_model
from tallyfold.sources.tables import audited_write

# Two pairs of neighbours and one place by itself.
POINTS = [(10.0, 10.0, "A1", "A", 7), (10.4, 10.1, "A2", "A", 5), (40.0, 12.0, "B1", "B", 20),
          (12.0, 60.0, "C1", "C", 9), (11.8, 60.3, "D1", "D", 30)]


def test_three_clusters_of_five_points(spark, tmp_path):
    df = spark.createDataFrame(POINTS, "LATITUDE double, LONGITUDE double, DISTRICT string, STATE_UT string, n bigint")
    model = clustering.fit_clusters(df, k=3, iterations=10)
    placed = clustering.assign_clusters(model, df)
    rows = cluster_summary(placed, "LOCATION_CLUSTER", "DISTRICT", "STATE_UT", "n").collect()
    assert len(rows) == 3 and sum(r.total_crimes for r in rows) == 71
    assert rows[0].total_crimes == 39 and rows[0].dominant_states == ["D", "C"]
    assert clustering.cluster_centres(model, df).count() == 3
    save_model(model, str(tmp_path / "m"))
    again = clustering.assign_clusters(load_model(str(tmp_path / "m")), df)
    assert sorted(again.collect()) == sorted(placed.collect())
    assert clustering.assign_clusters(model, placed).columns.count("LOCATION_CLUSTER") == 1


def test_elbow_marks_one_knee(spark):
    df = spark.range(120).select((F.col("id") % 4 * 100 + F.col("id") / 120).alias("x"), (F.col("id") / 99).alias("y"))
    rows = clustering.elbow(df, ("x", "y"), range(2, 8)).collect()
    assert [r.k for r in rows if r.is_knee] == [4]


def training_rows(spark):
    """Severe above a slanting line over two figures; the third says nothing."""
    rows = []
    for i in range(240):
        ratio, risk = i * 17 % 60 / 60, float(i * 7 % 50)
        rows.append((f"s{i}", "d", 1990 + i % 9, risk, ratio, i * 11 % 13 / 13, int(ratio + risk / 50 > 1)))
    return spark.createDataFrame(rows, "STATE_UT string, DISTRICT string, YEAR int, risk double, ratio double, "
                                       f"p double, {LABEL} int")


def test_forest_learns_and_reports(spark, tmp_path):
    # A session that has audited a write must still be able to score.
    audited_write(spark.range(5), str(tmp_path / "audited"), ())
    rows = severity.split_rows(training_rows(spark))
    columns = ["risk", "ratio", "p", "YEAR"]
    model = severity.fit_severity(rows.filter("is_train = 1"), columns, trees=20)
    scored = severity.score_severity(model, rows.filter("is_train = 0")).cache()
    assert scored.filter(~F.col("risk_probability").between(0, 1)).count() == 0
    counts = metrics.confusion(scored, LABEL, "predicted")
    assert metrics.decision_metrics(counts).first()["accuracy"] >= 0.8
    quality = severity.model_quality(model, rows.filter("is_train = 0"))
    exact = metrics.roc_area(scored, LABEL, "risk_probability").first()[0]
    assert exact == pytest.approx(quality["auc_roc"], abs=2e-3)
    ranked = severity.importances(model, rows, columns)
    assert ranked.count() == 4 and ranked.groupBy().sum("importance").first()[0] == pytest.approx(1, abs=1e-3)
    assert {r.metric for r in metrics.report_rows([metrics.decision_metrics(counts), counts]).collect()} >= {
        "accuracy", "precision", "recall", "f1_score", "true_positive"}


def test_split_does_not_depend_on_partitioning(spark):
    df = training_rows(spark)
    a = {r.STATE_UT: r.is_train for r in severity.split_rows(df).collect()}
    b = {r.STATE_UT: r.is_train for r in severity.split_rows(df.repartition(7)).collect()}
    assert a == b and 165 <= sum(a.values()) <= 218


def test_metrics_guard_empty_classes(spark):
    df = spark.createDataFrame([(0, 0)], "y int, p int")
    assert tuple(metrics.decision_metrics(metrics.confusion(df, "y", "p")).first()) == (1.0, 0.0, 0.0, 0.0)


def test_roc_area_with_ties_equals_pairs(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (0, 0.4), (1, 1.0), (0, 0.0)]
    pairs = [1.0 if p > n else 0.5 if p == n else 0.0 for y, p in rows if y for z, n in rows if not z]
    got = metrics.roc_area(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0]
    assert got == pytest.approx(sum(pairs) / len(pairs), abs=1e-6)


def test_correlation_ranking_without_spread(spark):
    df = spark.createDataFrame([(float(i), 1.0, i % 2, i % 2) for i in range(10)], "a double, flat double, b int, y int")
    got = {r.feature: r.importance for r in metrics.correlation_ranking(df, "y", ["a", "flat", "b"]).collect()}
    assert got["flat"] == 0.0 and sum(got.values()) == pytest.approx(1, abs=1e-3) and got["b"] > got["a"]


def test_moments_give_the_library_numbers(spark):
    df = spark.createDataFrame(POINTS, "LATITUDE double, LONGITUDE double, DISTRICT string, STATE_UT string, n bigint")
    columns = ["LATITUDE", "LONGITUDE"]
    model = clustering.fit_clusters(df, k=3, iterations=10, out="c")
    library = clustering.cluster_quality(model, df, "c")
    placed = clustering.assign_clusters(model, df, "c")
    rows = clustering.silhouettes(placed, columns, "c")
    assert rows.agg(F.avg("silhouette")).first()[0] == pytest.approx(library["silhouette"], abs=1e-9)
    assert clustering.squared_error(clustering.cluster_moments(placed, columns, "c")).first()[0] == pytest.approx(library["wssse"], abs=1e-6)
    assert {r.DISTRICT: r.silhouette for r in rows.collect()}["B1"] == 0.0  # alone
    one = clustering.silhouettes(placed.withColumn("c", F.lit(1)), columns, "c")
    assert {r.silhouette for r in one.collect()} == {0.0}
    none = clustering.silhouettes(placed.withColumn("c", F.when(F.col("c") == 0, F.col("c"))), columns, "c")
    assert none.where("c is null and silhouette is not null").count() == 0
    assert clustering.squared_error(clustering.cluster_moments(df.limit(0).withColumn("c", F.lit(1)), columns, "c")).first()[0] == 0.0


def test_assignment_violations(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0), (5.0, 5.0, 1), (0.1, 0.0, 1)], "x double, y double, c int")
    got = clustering.assignment_violations(df, ["x", "y"], "c", [[0.0, 0.0], [5.0, 5.0]]).first()
    assert tuple(got) == (3, 1)
