"""The stages as jobs over files: each reads stored input and writes its result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.learning import clustering, metrics, severity
from tallyfold.operators import rollups
from tallyfold.operators.cleaning import clean_facts, union_sources
from tallyfold.operators.coordinates import locate
from tallyfold.operators.features import build_features
from tallyfold.operators.headers import unify_headers
from tallyfold.operators.tables import DIMENSION_COLUMNS, dimension_rows, recovery_rows, women_rows
from tallyfold.plans import reports
from tallyfold.schema import CLEAN_SCHEMA, DISTRICT, FEATURE_SCHEMA, LABEL, RAW_SCHEMA, STATE, TOTAL, YEAR
from tallyfold.sources.documents import write_document
from tallyfold.sources.gazetteer import read_gazetteer
from tallyfold.sources.models import load_model, save_model
from tallyfold.sources.tables import audited_write, read_table, write_partitioned
from tallyfold.sources.text import read_delimited, read_generations

PLACE_IN_SOURCE = ("_file", "_block", "_line")
SOURCED_SCHEMA = T.StructType(RAW_SCHEMA.fields + [
    T.StructField("source_rank", T.IntegerType()), T.StructField("_file", T.StringType()),
    T.StructField("_block", T.LongType()), T.StructField("_line", T.LongType())])


def ingest(spark: SparkSession, sources: list[str], out: str, strict_compat: bool = False) -> dict[str, int]:
    """Raw files of any header generation to one partitioned table.

    The reading order travels along, as cleaning keeps the first row of a key.
    """
    frames = [reduce(DataFrame.unionByName, [
        unify_headers(part, strict_compat, PLACE_IN_SOURCE)
        for part in read_generations(spark, path, keep_position=True)]) for path in sources]
    return audited_write(union_sources(frames), out)


def clean(spark: SparkSession, raw: str, gazetteer: str, out: str, first_year: int = 2000,
          strict_compat: bool = False) -> dict[str, int]:
    places, centroids = read_gazetteer(spark, gazetteer)
    facts = clean_facts(read_table(spark, raw, SOURCED_SCHEMA),
                        [F.col("source_rank"), *[F.col(c) for c in PLACE_IN_SOURCE]], first_year)
    located = locate(facts, places, centroids, strict_compat=strict_compat)
    return audited_write(located.select([f.name for f in CLEAN_SCHEMA.fields]), out)


def _dimension(spark: SparkSession, path: str | None, kind: str) -> DataFrame:
    if path is None:
        figures = ", ".join(f"{n} {t}" for n, t in DIMENSION_COLUMNS[kind].items())
        year = f"{YEAR} int, " if kind == "cyber" else ""
        return spark.createDataFrame([], f"{STATE} string, {DISTRICT} string, {year}{figures}")
    return dimension_rows(read_delimited(spark, path, keep_position=True, fewest=0), kind, list(PLACE_IN_SOURCE))


def engineer(spark: SparkSession, cleaned: str, out: str, demographics: str | None = None,
             police: str | None = None, cyber: str | None = None) -> dict[str, int]:
    """Features; a dimension that is not given leaves its defaults."""
    built = build_features(read_table(spark, cleaned, CLEAN_SCHEMA), _dimension(spark, demographics, "demographics"),
                           _dimension(spark, police, "police"), _dimension(spark, cyber, "cyber"))
    return audited_write(built, out)


def report(spark: SparkSession, features: str, cleaned: str, out: str, recovery: str | None = None,
           women: str | None = None) -> None:
    """All report documents below ``out``. Without ``women`` the clean facts are used."""
    table = read_table(spark, features, FEATURE_SCHEMA)
    reports.hotspot_document(table, f"{out}/hotspots")
    reports.time_document(table, f"{out}/time_patterns")
    counted = (women_rows(read_delimited(spark, women, fewest=0)) if women
               else read_table(spark, cleaned, CLEAN_SCHEMA))
    if recovery:
        amounts = recovery_rows(read_delimited(spark, recovery, fewest=0))
    else:
        amounts = spark.createDataFrame([], "year int, value_stolen double, value_recovered double, "
                                            "cases_stolen bigint, cases_recovered bigint")
    reports.trend_document(table, counted, amounts, f"{out}/crime_trends")
    reports.region_document(table, f"{out}/regions_data")
    reports.snapshot_lines(table, f"{out}/yearly_state_snapshots")
    reports.profile_document(table, f"{out}/district_profiles")


def cluster(spark: SparkSession, features: str, out: str, model: str, zones: str, k: int = clustering.CLUSTERS) -> None:
    """Features with their cluster in a folder of their own, the model and the zone document."""
    table = read_table(spark, features, FEATURE_SCHEMA)
    save_model(clustering.fit_clusters(table, k=k), model)
    fitted = load_model(model)
    placed = clustering.assign_clusters(fitted, table)
    write_partitioned(placed.select([f.name for f in FEATURE_SCHEMA.fields]), out)
    summary = rollups.cluster_summary(read_table(spark, out, FEATURE_SCHEMA), "LOCATION_CLUSTER", DISTRICT, STATE, TOTAL)
    centres = clustering.cluster_centres(fitted, table)
    write_document({"clusters": summary, "centroids": centres}, zones, {
        "clusters": [-F.col("total_crimes"), F.col("LOCATION_CLUSTER")], "centroids": [F.col("cluster_id")]})


def train(spark: SparkSession, features: str, model: str, evaluation: str, trees: int = severity.TREES) -> DataFrame:
    """Fits and stores the forest; returns its evaluation, also written as a document."""
    rows = severity.split_rows(read_table(spark, features, FEATURE_SCHEMA))
    save_model(severity.fit_severity(rows.filter("is_train = 1"), trees=trees), model)
    fitted = load_model(model)
    scored = severity.score_severity(fitted, rows.filter("is_train = 0")).select(LABEL, "risk_probability", "predicted")
    counts = metrics.confusion(scored, LABEL, "predicted")
    setting = rows.agg(F.count_if(F.col("is_train") == 1).alias("train_size"), F.count_if(F.col("is_train") == 0).alias("test_size"),
                       F.lit(trees).alias("num_trees"), F.lit(severity.DEPTH).alias("max_depth"))
    measures = metrics.report_rows([metrics.decision_metrics(counts),
                                    metrics.roc_area(scored, LABEL, "risk_probability"), counts, setting])
    write_document({"metrics": measures, "feature_importances": severity.importances(fitted, rows)}, evaluation, {
        "feature_importances": [F.col("rank")]})
    return measures
