"""Spatial clustering."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.schema import LAT, LON
from tallyfold.sources.literals import constant_table

# Number of clusters, iterations and seed.
CLUSTERS, ITERATIONS, SEED = 15, 30, 42


def assembler(columns: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error")


def fit_clusters(df: DataFrame, columns: tuple[str, ...] = (LAT, LON), k: int = CLUSTERS,
                 iterations: int = ITERATIONS, seed: int = SEED,
                 out: str = "LOCATION_CLUSTER") -> PipelineModel:
    kmeans = KMeans(k=k, maxIter=iterations, seed=seed, featuresCol="features", predictionCol=out)
    return Pipeline(stages=[assembler(list(columns)), kmeans]).fit(df.select(*columns))


def assign_clusters(model: PipelineModel, df: DataFrame, out: str = "LOCATION_CLUSTER") -> DataFrame:
    """Rows with their cluster; an older cluster column is replaced."""
    return model.transform(df.drop(out)).drop("features")


def cluster_centres(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row per centre."""
    rows = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.stages[-1].clusterCenters())]
    return constant_table(df.sparkSession, ["cluster_id", "center_lat", "center_lon"], rows)


def cluster_quality(model: PipelineModel, df: DataFrame, out: str = "LOCATION_CLUSTER") -> dict[str, float]:
    """Silhouette and the within-cluster squared error."""
    scored = model.transform(df.drop(out))
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol=out).evaluate(scored)
    return {"silhouette": silhouette, "wssse": model.stages[-1].summary.trainingCost}


def cluster_moments(df: DataFrame, columns: list[str], cluster: str) -> DataFrame:
    """One row per cluster: ``n``, ``sums`` of every column and ``squares``, the sum of all squared entries."""
    squares = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    return df.where(F.col(cluster).isNotNull()).groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in columns]).alias("sums"), F.sum(squares).alias("squares"))


def squared_error(moments: DataFrame) -> DataFrame:
    """One row, ``wssse``: squared distances of all rows to their cluster's mean, from the moments alone."""
    length = F.aggregate("sums", F.lit(0.0), lambda acc, x: acc + x * x)
    return moments.agg(F.coalesce(F.sum(F.col("squares") - length / F.col("n")), F.lit(0.0)).alias("wssse"))


def silhouettes(df: DataFrame, columns: list[str], cluster: str, moments: DataFrame | None = None) -> DataFrame:
    """``df`` with ``silhouette`` by squared distance, from per-cluster moments instead of pairs of rows.

    The mean squared distance of a row to a cluster's rows follows from the cluster's count, sum and squares, so a row
    meets one entry per cluster and no other row. A row alone in its cluster has 0, as where there is one cluster
    only; a row without a cluster has none.
    """
    moments = cluster_moments(df, columns, cluster) if moments is None else moments
    # One row that holds an entry per cluster.
    held = moments.agg(F.collect_list(F.struct("cluster", "n", "sums", "squares")).alias("_m")).withColumn("_one", F.lit(1))
    own = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    met = df.withColumns({"_one": F.lit(1), "_x": F.array(*columns), "_own": own}).join(F.broadcast(held), "_one")

    def total(m):
        dot = F.aggregate(F.zip_with("_x", m["sums"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        return m["n"] * F.col("_own") + m["squares"] - 2 * dot

    mine = F.filter("_m", lambda m: m["cluster"] == F.col(cluster))[0]
    others = F.transform(F.filter("_m", lambda m: m["cluster"] != F.col(cluster)), lambda m: total(m) / m["n"])
    inner = F.try_divide(total(mine), (mine["n"] - 1).cast("double"))
    outer = F.array_min(others)
    value = F.try_divide(outer - F.col("_in"), F.greatest(outer, F.col("_in")))
    scored = met.withColumn("_in", inner).withColumn(
        "silhouette", F.when(F.col(cluster).isNotNull(), F.coalesce(value, F.lit(0.0))))
    return scored.drop("_one", "_x", "_own", "_m", "_in")


def nearest_centre(df: DataFrame, centres: list[tuple[float, float]], x: str, y: str,
                   out: str = "cluster_id") -> DataFrame:
    """Index of the closest given centre, the first one on ties."""
    far = F.array(*[F.pow(F.col(x) - F.lit(cx), F.lit(2.0)) + F.pow(F.col(y) - F.lit(cy), F.lit(2.0))
                    for cx, cy in centres])
    return df.withColumn(out, (F.array_position(far, F.array_min(far)) - 1).cast("int"))


def model_centres(model: PipelineModel) -> list[list[float]]:
    """The fitted centres, one list of entries each."""
    return [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]


def assignment_violations(assigned: DataFrame, columns: list[str], cluster: str, centres: list[list[float]],
                          tolerance: float = 1e-9) -> DataFrame:
    """One row: rows in all, and those whose cluster's centre is farther away than another one (beyond rounding)."""
    # One row that holds an entry per centre.
    held = constant_table(assigned.sparkSession, ["_one", "_centres"], [(1, centres)])
    met = assigned.withColumns({"_one": F.lit(1), "_x": F.array(*columns)}).join(F.broadcast(held), "_one")
    far = F.transform("_centres", lambda c: F.aggregate(
        F.zip_with("_x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v))
    own, least = F.col("_far")[F.col(cluster)], F.array_min("_far")
    return met.withColumn("_far", far).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(own > least + F.lit(tolerance) * (1 + least)).alias("violations"))


def elbow(df: DataFrame, columns: tuple[str, ...], ks: range = range(5, 26),
          iterations: int = ITERATIONS, seed: int = SEED, parallel: int = 4) -> DataFrame:
    """Squared error per number of clusters, with the knee marked.

    The knee lies farthest below the line from the first to the last point. The
    fits share the persisted points, and ``parallel`` of them run at a time.
    """
    points = assembler(list(columns)).transform(df).select("features").persist(
        StorageLevel.MEMORY_AND_DISK)

    def cost(k):
        if k == 1:  # one cluster is no clustering for the library; its error is that of the mean
            return k, squared_error(cluster_moments(df.withColumn("_all", F.lit(0)), list(columns), "_all")).first()[0]
        model = KMeans(k=k, maxIter=iterations, seed=seed).fit(points)
        return k, float(model.summary.trainingCost)

    try:
        with ThreadPool(parallel) as pool:
            rows = pool.map(inheritable_thread_target(df.sparkSession)(cost), list(ks), chunksize=1)
    finally:
        points.unpersist()
    table = constant_table(df.sparkSession, ["k", "wssse"], rows)
    # As many rows as numbers of clusters were tried.
    every = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    k0, k1 = F.first("k").over(every), F.last("k").over(every)
    c0, c1 = F.first("wssse").over(every), F.last("wssse").over(every)
    line = c0 + (c1 - c0) * F.try_divide((F.col("k") - k0).cast("double"), (k1 - k0).cast("double"))
    below = table.withColumn("below_line", F.coalesce(line - F.col("wssse"), F.lit(0.0)))
    best = F.max(F.struct("below_line", -F.col("k"))).over(every)
    return below.withColumn("is_knee", F.struct("below_line", -F.col("k")) == best)
