"""Order statistics against brute force, with one group holding most rows."""

import datetime as dt
import random
import statistics
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators import ordering


def exclusive_p75(values):
    return float(max(values)) if len(values) < 4 else statistics.quantiles(values, n=4)[2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(1990, 1995), st.lists(st.integers(0, 3 * 2 ** 20), min_size=1, max_size=30),
                       min_size=1, max_size=4))
def test_upper_quartile_equals_statistics(spark, data):
    rows = [(y, v) for y, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "y int, v bigint")
    got = {r.y: r.p75 for r in ordering.upper_quartile(df, "y", "v").collect()}
    assert got == {y: exclusive_p75(vs) for y, vs in data.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 50])
def test_upper_quartile_small_groups(spark, n):
    values = [(i * 7919) % 1000 for i in range(n)]
    df = spark.createDataFrame([(1, v) for v in values], "y int, v bigint")
    assert ordering.upper_quartile(df, "y", "v").first()["p75"] == exclusive_p75(values)


def test_running_totals_cross_levels(spark):
    rng = random.Random(3)
    values = sorted({rng.randrange(0, 5 * 2 ** 20) for _ in range(300)})
    rows = [(v, rng.randrange(1, 5)) for v in values]
    df = spark.createDataFrame(rows, "v bigint, n bigint")
    got = {r.v: r.before_n for r in ordering.running_totals(df, [], "v", ["n"], ordering.count_levels("v")).collect()}
    seen = 0
    for v, n in rows:
        assert got[v] == seen
        seen += n


def test_percent_ranks(spark):
    values = [5, 5, 1, 9, 7, 7, 7, 2]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, 4)], "g int, v bigint")
    got = {(r.g, r.v): r.percent_rank for r in ordering.percent_ranks(df, "g", "v").collect()}
    want = {(1, v): sum(x < v for x in values) / (len(values) - 1) for v in set(values)}
    assert got == {**want, (2, 4): 0.0}


def test_number_rows_is_gapless_and_stable(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"))
    one = {r.k: r.n for r in ordering.number_rows(df, ["k"], "n", 10, 16).collect()}
    two = {r.k: r.n for r in ordering.number_rows(df.repartition(13), ["k"], "n", 10, 16).collect()}
    assert sorted(one.values()) == list(range(10, 510))
    assert one == two


def test_trailing_rows_equals_brute_force_under_skew(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        entity = "hot" if rng.random() < 0.6 else f"e{rng.randrange(40)}"
        rows.append((entity, rng.randrange(0, 1000), i, rng.randrange(100)))
    df = spark.createDataFrame(rows, "e string, t int, id int, v int")
    got = {r.id: (r.n, r.s) for r in ordering.trailing_rows(
        df, ["e"], ["t", "id"], F.floor(F.col("t") / 10), 25, {"n": ("count", "v"), "s": ("sum", "v")}).collect()}
    by_entity = defaultdict(list)
    for e, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        by_entity[e].append(v)
        last = by_entity[e][-25:]
        assert got[i] == (len(last), sum(last))
    assert len(got) == 600


def test_top_within_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = ordering.top_within(df, ["g"], [F.desc("v")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {(r.g, r.v) for r in top.collect()} == {(0, 999), (0, 996), (1, 997), (1, 994), (2, 998), (2, 995)}


def test_numbers_in_order(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(40)]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "x int, k int").repartition(7)
    got, count = ordering.number_in_order(df, ["x"], "at", str(tmp_path / "n"), 10)
    rows = sorted(got.collect(), key=lambda r: r["at"])
    assert count == 500 and [r["at"] for r in rows] == list(range(10, 510))
    order = [-1 if r.x is None else r.x for r in rows]
    assert order == sorted(order)
    none, count = ordering.number_in_order(df.limit(0), ["x"], "at", str(tmp_path / "m"))
    assert count == 0 and none.count() == 0


def test_hot_entity_is_cut_into_equal_chunks(spark):
    """A third of all rows in one entity on one day, most of them within an hour."""
    start = dt.datetime(2024, 3, 1)
    rows = [("hot", start + dt.timedelta(seconds=k * 1.7), k) for k in range(2000)]
    rows += [(f"e{k % 40}", start + dt.timedelta(hours=k), k) for k in range(4000)]
    df = spark.createDataFrame(rows, "e string, t timestamp, k int")
    cut = ordering.equal_chunks(df, ["e"], "t", 100)
    sizes = cut.groupBy("e", "chunk").count().collect()
    assert max(r["count"] for r in sizes) <= 100 and len([r for r in sizes if r.e == "hot"]) == 20
    got = ordering.trailing_rows(cut, ["e"], ["t", "k"], F.col("chunk"), 25, {"s": ("sum", "k")})
    w = Window.partitionBy("e").orderBy("t", "k").rowsBetween(-24, 0)
    want = df.select("e", "t", "k", F.sum("k").over(w).alias("s"))
    assert sorted(got.select("e", "t", "k", "s").collect()) == sorted(want.collect())
