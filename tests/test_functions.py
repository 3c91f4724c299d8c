import pytest
from pyspark.sql import functions as F

from tallyfold.functions import hashing, labels, numbers, text
from tallyfold.sources.paths import storage_path


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


def test_lenient_int(spark):
    got = column(spark, ["1,234", "12.7", "NA", "", None, " 5 ", "-3.9", "1e3", "nan", "inf", "12d", "9" * 30],
                 numbers.lenient_int(F.col("v")))
    assert got == [1234, 12, 0, 0, 0, 5, -3, 1000, 0, 0, 0, 0]


def test_title_case_matches_python(spark):
    names = ["K/KUMEY", "A & N ISLANDS", "O'BRIEN'S", "24 PARGANAS(NORTH)", "x-y_z", "élan vital", "NATION_10", ""]
    assert column(spark, names, text.title_case(F.col("v"))) == [n.title() for n in names]


def test_first_given_falls_through_empty_and_null(spark):
    df = spark.createDataFrame([("", None), (None, "b"), ("a", "b"), ("", "")], "x string, y string")
    got = [r[0] for r in df.select(text.first_given(F.col("x"), F.col("y"), default="UNKNOWN")).collect()]
    assert got == ["UNKNOWN", "b", "a", "UNKNOWN"]


@pytest.mark.parametrize("raw,want", [("STATE/UT", "STATE_UT"), ("States/UTs", "STATES_UTS"),
                                      (" Kidnapping & Abduction ", "KIDNAPPING_AND_ABDUCTION")])
def test_canonical_header(raw, want):
    assert text.canonical_header(raw) == want


def test_percent_guards_zero(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(numbers.percent(F.col("a"), F.col("b"))).collect()] == [33.33, 0.0, 0.0]


def test_share_floors_the_total(spark):
    df = spark.createDataFrame([(1100, 4000), (3, 0)], "a int, b int")
    assert [r[0] for r in df.select(numbers.share(F.col("a"), F.col("b"))).collect()] == [0.275, 3.0]


def test_bucket_is_the_md5_prefix(spark):
    import hashlib
    names = ["Patna", "New Delhi", ""]
    want = [int(hashlib.md5(n.encode()).hexdigest()[:8], 16) % 100 for n in names]
    assert column(spark, names, hashing.stable_bucket(100, F.col("v"))) == want
    assert all(-0.25 <= j <= 0.245 for j in column(spark, names, hashing.name_jitter(F.col("v"))))


def test_archetype_order(spark):
    df = spark.createDataFrame(
        [(27.0, 19.0, 41.0, 9.0, 2.0), (1.0, 19.0, 41.0, 9.0, 2.0), (1.0, 1.0, 41.0, 9.0, 2.0),
         (1.0, 1.0, 1.0, 1.0, 1.6), (1.0, 1.0, 1.0, 8.0, 1.5)], "v double, w double, p double, e double, c double")
    got = [r[0] for r in df.select(labels.archetype(*[F.col(x) for x in "vwpec"])).collect()]
    assert got == ["Violent Hotspot Corridor", "High Women Safety Vulnerability", "High-Density Property Theft Hub",
                   "Commercial & Cyber Fraud Zone", "Mixed Urban IPC Density"]


def test_safety_score_is_clamped(spark):
    df = spark.createDataFrame([(0.0, 0.0, 100.0, 500.0), (5000.0, 10.0, 45.0, 100.0), (0.5, 20.0, 45.0, 120.0)],
                               "r double, v double, c double, p double")
    got = [r[0] for r in df.select(labels.safety_score(*[F.col(x) for x in "rvcp"])).collect()]
    assert got == [95.0, 15.0, 76.3]


def test_metric_class(spark):
    assert column(spark, [26.0, 25.0, 16.0, 11.0, 3.0], labels.metric_class(F.col("v"), [25, 20, 15, 10]), "double") == [
        4, 3, 2, 1, 0]


def test_short_risk(spark):
    import math
    df = spark.createDataFrame([(6000.0, 0.35, 0.2, 0.15)], "DISTRICT_RISK_SCORE double, VIOLENT_CRIME_RATIO double, "
                               "PROPERTY_CRIME_RATIO double, WOMEN_CRIME_RATIO double")
    score = 0.8429 + 0.0377 + 0.0357 * 0.5 + 0.0356
    assert df.select(labels.short_risk()).first()[0] == pytest.approx(1 / (1 + math.exp(-6 * (score - 0.45))))


def test_half_up_is_like_math_round(spark):
    assert column(spark, [0.5, 1.5, -0.5, 2.4], numbers.half_up(F.col("v")), "double") == [1, 2, 0, 2]


def test_storage_path():
    assert storage_path("/data/crimes/", "hdfs://name:9000") == "hdfs://name:9000/data/crimes"
    assert storage_path("/data/crimes/", "/srv/data") == "/srv/data/crimes"
