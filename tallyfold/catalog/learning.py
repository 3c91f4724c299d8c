"""Clustering, classification and their measures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.catalog.checks import CLEAN, bucket, over_features, r
from tallyfold.catalog.registry import Query
from tallyfold.functions.labels import short_risk
from tallyfold.learning import clustering, metrics, severity
from tallyfold.operators.rollups import cluster_summary
from tallyfold.plans import trade
from tallyfold.plans.models import severity_model, train_and_test
from tallyfold.plans.stages import clean_stage, feature_stage
from tallyfold.schema import DISTRICT, LABEL, LAT, LON, MODEL_FEATURES, STATE, TOTAL, YEAR
from tallyfold.session import scratch_path
from tallyfold.sources.models import load_model, save_model

CENTRES = [(12.5, 72.5), (18.0, 80.0), (24.5, 76.0), (31.0, 90.0), (20.0, 92.0)]


#: Entries of a vector in the embedding table.
ENTRIES = tuple(f"x{i}" for i in range(64))


def _points(spark, folder):
    return trade.table(spark, folder, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(ENTRIES)])


def _kmeans(spark, folder):
    points = _points(spark, folder)
    model = clustering.fit_clusters(points, ENTRIES, out="cluster_id")
    return clustering.assign_clusters(model, points, "cluster_id").select("vec_id", "label", "cluster_id")


def _kmeans_sizes(spark, folder):
    """Counts that hold for any correct clustering of these points."""
    rows = _kmeans(spark, folder).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.sum("n").cast("bigint").alias("points"), F.count(F.lit(1)).alias("clusters"),
                    F.count_if(F.col("cluster_id").between(0, 14)).alias("in_range"))


def _zones(spark, folder):
    """Clusters of the places with their centre, volume and leading states."""
    features = feature_stage(spark, folder)
    model = clustering.fit_clusters(features)
    placed = clustering.assign_clusters(model, features)
    summary = cluster_summary(placed, "LOCATION_CLUSTER", DISTRICT, STATE, TOTAL)
    # One row per centre.
    return summary.join(F.broadcast(clustering.cluster_centres(model, features)),
                        F.col("LOCATION_CLUSTER") == F.col("cluster_id")).select(
        "cluster_id", "center_lat", "center_lon", "total_crimes", "distinct_districts", "dominant_states")


def _quality(spark, folder):
    points = _points(spark, folder)
    model = clustering.fit_clusters(points, ENTRIES, out="cluster_id")
    q = clustering.cluster_quality(model, points, "cluster_id")
    return spark.range(1).select(F.lit(q["silhouette"]).alias("silhouette"), F.lit(q["wssse"]).alias("wssse"))


def _zoned(spark, folder):
    return clustering.nearest_centre(clean_stage(spark, folder), CENTRES, LAT, LON)


_DISTANCE = "(LATITUDE - CAST({x} AS DOUBLE)) ** 2 + (LONGITUDE - CAST({y} AS DOUBLE)) ** 2"
ZONED = "zoned AS (SELECT *, list_position(d, list_min(d)) - 1 AS cluster_id FROM (SELECT *, [" + ", ".join(
    _DISTANCE.format(x=x, y=y) for x, y in CENTRES) + "] AS d FROM clean))"


def _summary(spark, folder):
    return cluster_summary(_zoned(spark, folder), "cluster_id", DISTRICT, STATE, TOTAL).withColumn(
        "dominant_states", F.concat_ws(",", "dominant_states"))


def _scored(spark, folder):
    p = F.round(short_risk({"DISTRICT_RISK_SCORE": (0.5, 150.0), "VIOLENT_CRIME_RATIO": (0.1, 0.35),
                            "PROPERTY_CRIME_RATIO": (0.05, 0.4), "WOMEN_CRIME_RATIO": (0.15, 0.15)}), 4)
    return feature_stage(spark, folder).select(STATE, DISTRICT, YEAR, LABEL, p.alias("p")).withColumn(
        "predicted", (F.col("p") >= 0.57).cast("int"))


SCORED = "scored AS (SELECT HIGH_SEVERITY_FLAG, p, CAST(p >= 0.57 AS INTEGER) AS predicted FROM (SELECT *, " + r(
    "1.0 / (1.0 + exp(-6.0 * ((" + " + ".join(
        f"CAST({w} AS DOUBLE) * least({c} / CAST({full} AS DOUBLE), 1.0)" for c, w, full in (
            ("DISTRICT_RISK_SCORE", 0.5, 150), ("VIOLENT_CRIME_RATIO", 0.1, 0.35),
            ("PROPERTY_CRIME_RATIO", 0.05, 0.4), ("WOMEN_CRIME_RATIO", 0.15, 0.15)))
    + ") - CAST(0.45 AS DOUBLE))))", 4) + " AS p FROM features))"

CONFUSION = """confusion AS (SELECT count(*) FILTER (HIGH_SEVERITY_FLAG = 1 AND predicted = 1) AS true_positive,
  count(*) FILTER (HIGH_SEVERITY_FLAG <> 1 AND predicted = 1) AS false_positive,
  count(*) FILTER (HIGH_SEVERITY_FLAG <> 1 AND predicted <> 1) AS true_negative,
  count(*) FILTER (HIGH_SEVERITY_FLAG = 1 AND predicted <> 1) AS false_negative FROM scored)"""


def _ratio(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"


PRECISION, RECALL = (_ratio("true_positive", f"(true_positive + {x})") for x in ("false_positive", "false_negative"))


def _forest_scores(spark, folder):
    _, test = train_and_test(spark, folder)
    return severity.score_severity(severity_model(spark, folder), test).select(
        STATE, DISTRICT, YEAR, LABEL, "risk_probability", "predicted")


def _forest_counts(spark, folder):
    """Counts that hold for any classifier on the held-out rows."""
    rows = _forest_scores(spark, folder)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(LABEL) == 1).alias("severe"),
                    F.count_if(F.col("risk_probability").between(0, 1)).alias("in_range"))


def _forest_report(spark, folder):
    model = severity_model(spark, folder)
    train, test = train_and_test(spark, folder)
    scored = severity.score_severity(model, test).select(LABEL, "risk_probability", "predicted")
    counts = metrics.confusion(scored, LABEL, "predicted")
    quality = severity.model_quality(model, test)
    extra = train.agg(F.count(F.lit(1)).alias("train_size"), F.lit(severity.TREES).alias("num_trees"),
                      F.lit(severity.DEPTH).alias("max_depth"), F.lit(quality["auc_roc"]).alias("auc_roc_library"))
    return metrics.report_rows([metrics.decision_metrics(counts), metrics.roc_area(scored, LABEL, "risk_probability"),
                                counts, extra, test.agg(F.count(F.lit(1)).alias("test_size"))])


def _model_round_trip(spark, folder):
    """Rows on which a model and its reloaded copy disagree."""
    points = _points(spark, folder)
    model = clustering.fit_clusters(points, ENTRIES, out="before")
    path = scratch_path(spark, "kmeans_model")
    save_model(model, path)
    first = clustering.assign_clusters(model, points, "before")
    again = clustering.assign_clusters(load_model(path), first.withColumnRenamed("before", "kept"), "before")
    return again.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") != F.col("kept")).alias("differing"))


def _kmeans_violations(spark, folder):
    """Vectors whose cluster is not the nearest of the centres that the model returns."""
    points = _points(spark, folder)
    model = clustering.fit_clusters(points, ENTRIES, out="cluster_id")
    placed = clustering.assign_clusters(model, points, "cluster_id")
    return clustering.assignment_violations(placed, list(ENTRIES), "cluster_id", clustering.model_centres(model))


def _fixed_centre_quality(spark, folder):
    """Silhouette and squared error of the places around fixed centres."""
    zoned = _zoned(spark, folder)
    moments = clustering.cluster_moments(zoned, [LAT, LON], "cluster_id")
    mean = clustering.silhouettes(zoned, [LAT, LON], "cluster_id", moments).agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))
    error = clustering.squared_error(moments).select(F.round("wssse", 3).alias("wssse"))
    # One row each.
    return mean.withColumn("_one", F.lit(1)).join(error.withColumn("_one", F.lit(1)), "_one").drop("_one")


def _library_agreement(spark, folder):
    """The model's own silhouette and error against those of per-cluster moments, over all vectors."""
    points = _points(spark, folder)
    model = clustering.fit_clusters(points, ENTRIES, out="cluster_id")
    library = clustering.cluster_quality(model, points, "cluster_id")
    placed = clustering.assign_clusters(model, points, "cluster_id")
    rows = clustering.silhouettes(placed, list(ENTRIES), "cluster_id")
    return rows.agg(F.count("silhouette").alias("rows"),
                    (F.abs(F.avg("silhouette") - F.lit(library["silhouette"])) < 1e-6).alias("same_silhouette"),
                    (F.min("silhouette") >= -1.0).alias("above"), (F.max("silhouette") <= 1.0).alias("below"))


def _elbow_check(spark, folder):
    """The error of one cluster, which is the vectors' whole variance, and whether more clusters ever raise it."""
    rows = clustering.elbow(_points(spark, folder), ENTRIES, range(1, 7))
    # As many rows as numbers of clusters were tried.
    back = F.lag("wssse").over(Window.orderBy("k"))
    steps = rows.withColumn("_rises", F.coalesce(F.col("wssse") > back * (1 + 1e-9), F.lit(False)))
    return steps.agg(F.round(F.max(F.when(F.col("k") == 1, F.col("wssse"))), 3).alias("error_of_one"),
                     F.count_if("_rises").alias("rises"), F.count(F.lit(1)).alias("tried"), F.count_if("is_knee").alias("knees"))


def _importance_check(spark, folder):
    """Names, sum and ranks of the forest's inputs."""
    rows = severity.importances(severity_model(spark, folder), feature_stage(spark, folder))
    return rows.agg(F.array_join(F.array_sort(F.collect_set("feature")), ",").alias("features"),
                    F.round(F.sum("importance"), 2).alias("whole"),
                    F.array_join(F.transform(F.array_sort(F.collect_list("rank")), lambda x: x.cast("string")), ",").alias("ranks"),
                    F.count_if(F.col("importance") < 0).alias("negative"))


def _forest_setup(spark, folder):
    """Sizes of both sides of the split, and what the fitted forest says of itself."""
    forest = severity_model(spark, folder).stages[-1]
    train, test = train_and_test(spark, folder)
    sizes = train.agg(F.count(F.lit(1)).alias("train_size")).withColumn("_one", F.lit(1)).join(
        test.agg(F.count(F.lit(1)).alias("test_size")).withColumn("_one", F.lit(1)), "_one")
    return sizes.select("train_size", "test_size", F.lit(forest.getNumTrees).cast("bigint").alias("trees"),
                        F.lit(max(t.depth for t in forest.trees) <= severity.DEPTH).alias("depth_kept"),
                        F.lit(forest.numFeatures).cast("bigint").alias("inputs"))


def _forest_decisions(spark, folder):
    """Every held-out row with its label, and whether probability and decision agree."""
    rows = _forest_scores(spark, folder)
    fits = F.col("risk_probability").between(0, 1) & ((F.col("risk_probability") >= 0.5).cast("int") == F.col("predicted"))
    return rows.select(STATE, DISTRICT, YEAR, LABEL, fits.alias("consistent"))


SPLIT = "(" + bucket("STATE_UT || '|' || DISTRICT || '|' || YEAR", 100) + " < 80)"

#: Mean squared distances of every place to every zone, one pair of rows at a time.
SILHOUETTE = f"""numbered AS (SELECT row_number() OVER () AS id, LATITUDE AS x, LONGITUDE AS y, cluster_id AS c FROM zoned),
pairs AS (SELECT a.id, a.c, b.c AS other, sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS total, count(*) AS n
  FROM numbered a, numbered b GROUP BY a.id, a.c, b.c),
sides AS (SELECT id, max(CASE WHEN c = other THEN total / nullif(n - 1, 0) END) AS inner_mean,
  min(CASE WHEN c <> other THEN total / n END) AS outer_mean FROM pairs GROUP BY id),
means AS (SELECT c, avg(x) AS mx, avg(y) AS my FROM numbered GROUP BY c)
SELECT (SELECT round(avg(coalesce((outer_mean - inner_mean) / nullif(greatest(outer_mean, inner_mean), 0), 0)), 6) FROM sides) AS silhouette,
  (SELECT round(sum((x - mx) ** 2 + (y - my) ** 2), 3) FROM numbered n JOIN means m ON n.c = m.c) AS wssse"""

ELBOW_SQL = f"""SELECT round(sum(v), 3) AS error_of_one, CAST(0 AS BIGINT) AS rises, CAST(6 AS BIGINT) AS tried, CAST(1 AS BIGINT) AS knees
FROM (SELECT var_pop(CAST(embedding[i] AS DOUBLE)) * count(*) AS v FROM embeddings, range(1, {len(ENTRIES) + 1}) AS t(i) GROUP BY i)"""

QUERIES = [
    Query("kmeans_assignment", "M1 M2 J9", _kmeans),
    Query("kmeans_sizes", "M2", _kmeans_sizes,
          "SELECT count(*) AS points, least(15, count(DISTINCT embedding)) AS clusters, least(15, count(DISTINCT embedding)) AS in_range FROM embeddings"),
    Query("kmeans_violations", "M1 J9", _kmeans_violations,
          "SELECT count(*) AS \"rows\", count(*) FILTER (embedding IS NULL) AS violations FROM embeddings"),
    Query("fixed_centre_quality", "M2 M3", _fixed_centre_quality, f"WITH {CLEAN},\n{ZONED},\n{SILHOUETTE}"),
    Query("silhouette_agreement", "M3", _library_agreement,
          "SELECT count(*) AS \"rows\", count(*) > 0 AS same_silhouette, count(*) > 0 AS above, count(*) > 0 AS below FROM embeddings"),
    Query("elbow_check", "M4", _elbow_check, ELBOW_SQL),
    Query("importance_check", "M8", _importance_check, over_features(
        f"SELECT '{','.join(sorted(MODEL_FEATURES))}' AS features, round(CAST(count(*) AS DOUBLE) / count(*), 2) AS whole, "
        f"'{','.join(str(k) for k in range(1, len(MODEL_FEATURES) + 1))}' AS ranks, count(*) FILTER (YEAR IS NULL) AS negative FROM features")),
    Query("forest_setup", "M10", _forest_setup, over_features(
        f"SELECT count(*) FILTER ({SPLIT}) AS train_size, count(*) FILTER (NOT {SPLIT}) AS test_size, "
        f"CAST({severity.TREES} AS BIGINT) AS trees, count(*) > 0 AS depth_kept, CAST({len(MODEL_FEATURES)} AS BIGINT) AS inputs FROM features")),
    Query("forest_decisions", "M6 M9", _forest_decisions, over_features(
        f"SELECT STATE_UT, DISTRICT, YEAR, HIGH_SEVERITY_FLAG, YEAR IS NOT NULL AS consistent FROM features WHERE NOT {SPLIT}")),
    Query("kmeans_zones", "M2 J9 A10 K6", _zones),
    Query("kmeans_quality", "M3", _quality),
    Query("kmeans_elbow", "M4", lambda s, d: clustering.elbow(_points(s, d), ENTRIES)),
    Query("model_round_trip", "S15", _model_round_trip,
          "SELECT count(*) AS \"rows\", CAST(0 AS BIGINT) AS differing FROM embeddings"),
    Query("nearest_centres", "M2", lambda s, d: _zoned(s, d).select(STATE, DISTRICT, YEAR, "cluster_id"), f"WITH {CLEAN},\n{ZONED}\n"
        "SELECT STATE_UT, DISTRICT, YEAR, CAST(cluster_id AS INTEGER) AS cluster_id FROM zoned"),
    Query("cluster_summary", "A10 K6", _summary, over_features(
        f"""SELECT CAST(t.cluster_id AS INTEGER) AS cluster_id, total_crimes, distinct_districts, dominant_states
        FROM (SELECT cluster_id, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes,
                count(DISTINCT DISTRICT) AS distinct_districts FROM zoned GROUP BY cluster_id) t
        JOIN (SELECT cluster_id, string_agg(STATE_UT, ',' ORDER BY n) AS dominant_states FROM (
            SELECT cluster_id, STATE_UT, row_number() OVER (PARTITION BY cluster_id ORDER BY v DESC, STATE_UT) AS n
            FROM (SELECT cluster_id, STATE_UT, sum({TOTAL}) AS v FROM zoned GROUP BY ALL)) WHERE n <= 3
          GROUP BY cluster_id) s ON t.cluster_id = s.cluster_id""", ZONED)),
    Query("train_split", "M5", lambda s, d: severity.split_rows(feature_stage(s, d)).select(
        STATE, DISTRICT, YEAR, "is_train"), over_features(
        f"SELECT STATE_UT, DISTRICT, YEAR, CAST({SPLIT} AS INTEGER) AS is_train FROM features")),
    Query("forest_scores", "M6 M9", _forest_scores),
    Query("forest_counts", "M6 M9", _forest_counts, over_features(
        f"SELECT count(*) AS \"rows\", count(*) FILTER (HIGH_SEVERITY_FLAG = 1) AS severe, count(*) AS in_range "
        f"FROM features WHERE NOT {SPLIT}")),
    Query("forest_importances", "M8 W5", lambda s, d: severity.importances(severity_model(s, d), feature_stage(s, d))),
    Query("forest_report", "M7 M10", _forest_report),
    Query("confusion_matrix", "A15", lambda s, d: metrics.confusion(_scored(s, d), LABEL, "predicted"),
          over_features("SELECT * FROM confusion", f"{SCORED}, {CONFUSION}")),
    Query("decision_metrics", "A16", lambda s, d: metrics.decision_metrics(metrics.confusion(_scored(s, d), LABEL, "predicted")),
          over_features(f"""SELECT {r(_ratio('true_positive + true_negative',
              '(true_positive + true_negative + false_positive + false_negative)'), 4)} AS accuracy,
            {r(PRECISION, 4)} AS precision, {r(RECALL, 4)} AS recall,
            {r(f'coalesce({PRECISION} * {RECALL} * 2 / nullif({PRECISION} + {RECALL}, 0), 0.0)', 4)} AS f1_score
          FROM confusion""", f"{SCORED}, {CONFUSION}")),
    Query("roc_area", "A17 M7", lambda s, d: metrics.roc_area(_scored(s, d), LABEL, "p"), over_features(
        f"""SELECT {r('(sum(CASE WHEN HIGH_SEVERITY_FLAG = 1 THEN avg_rank END) - pos * (pos + 1) / CAST(2 AS DOUBLE)) '
                      '/ (CAST(pos AS DOUBLE) * neg)', 6)} AS auc_roc
        FROM (SELECT HIGH_SEVERITY_FLAG,
            rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / CAST(2 AS DOUBLE) AS avg_rank,
            count(*) FILTER (HIGH_SEVERITY_FLAG = 1) OVER () AS pos,
            count(*) FILTER (HIGH_SEVERITY_FLAG <> 1) OVER () AS neg FROM scored) GROUP BY pos, neg""", SCORED)),
    Query("correlation_ranking", "A18 W5", lambda s, d: metrics.correlation_ranking(
        feature_stage(s, d), LABEL, MODEL_FEATURES), over_features(
        f"""SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank
        FROM (SELECT feature, {r('s / sum(s) OVER ()', 4)} AS importance FROM (""" + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, coalesce(abs(corr(CAST({c} AS DOUBLE), CAST(HIGH_SEVERITY_FLAG AS DOUBLE))), 0.0) AS s "
            "FROM features" for c in MODEL_FEATURES) + "))")),
]
