import itertools
import random

from pyspark.sql import functions as F

from tallyfold.operators import coordinates, enrich
from tallyfold.schema import DISTRICT, LAT, LON


def gazetteer(spark, rows):
    return spark.createDataFrame(rows, "position bigint, gaz_name string, gaz_state string, gaz_lat double, gaz_lon double")


def test_overlap_equals_nested_loop(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("AB ") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    entries = [(i, w, rng.choice("XY"), float(i), 0.0) for i, w in enumerate(dict.fromkeys(words[:25]))]
    names = sorted(set(words[20:]))
    places = gazetteer(spark, entries)
    asked = spark.createDataFrame(list(itertools.product(["X", "Y"], names)), "state string, name string")
    got = {(r.name): r.position for r in coordinates.containing_places(asked.select("name"), places, "name").collect()}
    want = {}
    for n in names:
        hits = [e[0] for e in entries if e[1] in n or n in e[1]]
        if hits:
            want[n] = min(hits)
    assert got == want
    scoped = {(r.state, r.name): r.position
              for r in coordinates.containing_places(asked, places, "name", "state").collect()}
    want = {}
    for s, n in itertools.product(["X", "Y"], names):
        hits = [e[0] for e in entries if e[2] == s and (e[1] in n or n in e[1])]
        if hits:
            want[s, n] = min(hits)
    assert scoped == want


def test_overlap_uses_no_nested_loop(spark):
    places = gazetteer(spark, [(0, "EAST", "DELHI", 1.0, 1.0)])
    asked = spark.createDataFrame([("EAST GODAVARI",)], "name string")
    plan = coordinates.containing_places(asked, places, "name")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fallback_chain(spark):
    places = gazetteer(spark, [(0, "EAST", "DELHI", 28.6, 77.2), (1, "PATNA", "BIHAR", 25.5941, 85.1376),
                               (2, "GAYA", "BIHAR", 24.8, 85.0)])
    centroids = spark.createDataFrame([("BIHAR", 25.0961, 85.3131)],
                                      "centroid_state string, centroid_lat double, centroid_lon double")
    df = spark.createDataFrame([("BIHAR", "Patna"), ("BIHAR", "Gaya Rural"), ("BIHAR", "East Town"),
                                ("ODISHA", "Puri"), ("DELHI", "East Side")], f"STATE_RAW string, {DISTRICT} string")
    got = {r[DISTRICT]: r for r in coordinates.locate(df, places, centroids).collect()}
    assert {k: v["LOCATED_BY"] for k, v in got.items()} == {
        "Patna": "exact", "Gaya Rural": "overlap", "East Town": "state", "Puri": "national", "East Side": "overlap"}
    assert (got["Patna"][LAT], got["Patna"][LON]) == (25.5941, 85.1376)
    assert abs(got["East Town"][LAT] - 25.0961) <= 0.25
    assert (got["Puri"][LAT], got["Puri"][LON]) == (20.5937, 78.9629)
    loose = {r[DISTRICT]: r["LOCATED_BY"]
             for r in coordinates.locate(df, places, centroids, strict_compat=True).collect()}
    assert loose["East Town"] == "overlap"


def test_equal_names_in_two_states_multiply_nothing(spark):
    places = gazetteer(spark, [(0, "AURANGABAD", "MAHARASHTRA", 19.9, 75.3), (1, "AURANGABAD", "BIHAR", 24.8, 84.4),
                               (2, "AURANGABAD", "BIHAR", 1.0, 1.0), (3, "PURI", "ODISHA", 19.8, 85.8)])
    centroids = spark.createDataFrame([("GOA", 15.3, 74.1)], "centroid_state string, centroid_lat double, centroid_lon double")
    df = spark.createDataFrame([("BIHAR", "Aurangabad"), ("MAHARASHTRA", "Aurangabad"), ("GOA", "Aurangabad"), ("GOA", "Puri")],
                               f"STATE_RAW string, {DISTRICT} string")
    got = {(r["STATE_RAW"], r[DISTRICT]): (r["LOCATED_BY"], r[LAT]) for r in coordinates.locate(df, places, centroids).collect()}
    assert coordinates.locate(df, places, centroids).count() == 4
    assert got["BIHAR", "Aurangabad"] == ("exact", 24.8) and got["MAHARASHTRA", "Aurangabad"] == ("exact", 19.9)
    assert got["GOA", "Aurangabad"][0] == "state" and got["GOA", "Puri"] == ("exact", 19.8)
    loose = coordinates.locate(df, places, centroids, strict_compat=True)
    assert {r[LAT] for r in loose.filter(F.col(DISTRICT) == "Aurangabad").collect()} == {19.9} and loose.count() == 4


def test_long_names_meet_only_occurring_lengths(spark):
    places = gazetteer(spark, [(0, "EAST", "X", 1.0, 1.0)])
    asked = spark.createDataFrame([("Q" * 20_000 + "EAST",)], "name string")
    assert coordinates.containing_places(asked, places, "name").first().gaz_name == "EAST"


def test_box_drops_missing_and_outside(spark):
    df = spark.createDataFrame([(20.0, 78.0), (None, 78.0), (50.0, 78.0), (20.0, 10.0)], f"{LAT} double, {LON} double")
    assert coordinates.within_box(df).count() == 1


def test_region_default_and_case(spark):
    df = spark.createDataFrame([("goa",), ("Atlantis",)], "STATE_UT string")
    assert {r[0]: r.region for r in enrich.with_region(df).collect()} == {"goa": "Western", "Atlantis": "Northern"}


def test_boundary_alias_and_zeros(spark):
    shapes = spark.createDataFrame([("Orissa",), ("Nowhere",)], "b string")
    stats = spark.createDataFrame([("ODISHA", 7)], "state_key string, total_crimes bigint")
    regions = spark.createDataFrame([("ODISHA", "Eastern")], "state_key string, region string")
    got = {r.b: (r.total_crimes, r.region)
           for r in enrich.boundary_statistics(shapes, stats, regions, "b", ["total_crimes"]).collect()}
    assert got == {"Orissa": (7, "Eastern"), "Nowhere": (0, "Other")}


def test_lookup_keeps_hot_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 < 1, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("HOT ", 5)], "k string, v int")
    got = enrich.lookup(df, dim, ["k"], {"v": 0}).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {5: 1000, 0: 2000}


def test_contained_pairs_equal_contains(spark):
    rng = random.Random(3)
    words = lambda n: "".join(rng.choice("abñ ") for _ in range(n))
    small = sorted({words(rng.randint(1, 7)) for _ in range(120)})
    large = sorted({words(rng.randint(1, 60)) for _ in range(60)})
    scopes = ["p", "q"]
    a = spark.createDataFrame([(scopes[k % 2], t) for k, t in enumerate(small)], "s string, small string")
    b = spark.createDataFrame([(scopes[k % 2], t) for k, t in enumerate(large)], "s string, large string")
    got = coordinates.contained_pairs(a, b, ["s"]).collect()
    want = [(scopes[i % 2], x, y) for i, x in enumerate(small) for j, y in enumerate(large) if i % 2 == j % 2 and x in y]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 50


def test_rows_of_the_index_grow_with_the_length_of_names(spark):
    text = "".join(chr(0x4e00 + k) for k in range(3000))
    rows = spark.createDataFrame([(text,)], "t string").select(F.explode(coordinates._grams(F.col("t"), 3)))
    assert rows.count() == 2998
