import random

from tallyfold.operators import sketches


def test_stored_sketches_hold_the_rank_bound(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k % 3, rng.randrange(10**6)) for k in range(30000)] + [(1, None), (7, None), (8, 5)]
    df = spark.createDataFrame(rows, "g int, v long")
    store = sketches.SketchStore(str(tmp_path / "s"), ["g"], "v")
    store.add(df.where("v % 2 = 0 or v is null"), "even")
    store.add(df.where("v % 2 = 1").limit(10), "odd")
    store.add(df.where("v % 2 = 1"), "odd")  # a part that comes again replaces itself
    got = {r.g: (r.n, r.q) for r in store.quantiles(spark, 0.75, "q").collect()}
    for g in range(3):
        values = sorted(v for k, v in rows if k == g and v is not None)
        n, q = got[g]
        slack = sketches.rank_error() * n + 1
        assert n == len(values)
        assert sum(v < q for v in values) - slack <= 0.75 * n <= sum(v <= q for v in values) + slack
    assert got[8] == (1, 5) and 7 not in got
    assert {r.g: r.n for r in store.quantiles(spark, 0.5, "q", ["even"]).collect()}[0] < got[0][0]
