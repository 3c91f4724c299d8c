import pytest
from pyspark.sql import functions as F

from tallyfold.operators import cleaning, headers, incidents
from tallyfold.schema import DISTRICT, HEADS, STATE, TOTAL, YEAR
from tallyfold.sources import text


def raw(spark, rows):
    base = dict.fromkeys(HEADS, 0)
    full = [{**base, TOTAL: 0, "pos": i, **r} for i, r in enumerate(rows)]
    schema = f"{STATE} string, {DISTRICT} string, {YEAR} int, pos int, {TOTAL} bigint, " + ", ".join(
        f"{h} bigint" for h in HEADS)
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)


def place(state, district, year, **more):
    return {STATE: state, DISTRICT: district, YEAR: year, **more}


@pytest.mark.parametrize("name,want", [
    ("A & N ISLANDS", "Andaman & Nicobar Islands"), ("ORISSA", "Odisha"), ("DELHI UT", "Delhi"),
    ("MAHARASHTRA", "Maharashtra"), (" uttaranchal ", "Uttarakhand"), ("NEW STATE", "New State")])
def test_state_names(spark, name, want):
    df = spark.createDataFrame([(name,)], f"{STATE} string")
    assert cleaning.normalize_states(df).first()[0] == want


def test_duplicates_and_subtotals_go(spark):
    df = raw(spark, [place("BIHAR", "PATNA", 2014, MURDER=50, TOTAL_IPC_CRIMES=5000),
                     place("BIHAR", "PATNA", 2014, MURDER=51, TOTAL_IPC_CRIMES=5000),
                     place("BIHAR", "TOTAL", 2014, TOTAL_IPC_CRIMES=100000),
                     place("DELHI", "DELHI UT TOTAL", 2014), place("BIHAR", "  ", 2014),
                     place("BIHAR", "GAYA", 1999)])
    rows = cleaning.clean_facts(df, [F.col("pos")]).collect()
    assert [(r[DISTRICT], r["MURDER"], r[TOTAL]) for r in rows] == [("Patna", 50, 5000)]


def test_alias_spellings_are_one_place(spark):
    df = raw(spark, [place("ORISSA", "PURI", 2010, MURDER=1), place("ODISHA", "Puri", 2010, MURDER=2)])
    assert [r["MURDER"] for r in cleaning.clean_facts(df, [F.col("pos")]).collect()] == [1]


def test_first_wins_with_one_hot_key(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), (20000 - F.col("id")).alias("o"))
    out = cleaning.first_wins(df, ["k"], ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert out.filter("k = 0").first()["o"] == 20000 - 19998
    assert out.count() == 1 + 13333


def test_reconcile_and_derive(spark):
    df = raw(spark, [place("A", "B", 2001, MURDER=5, THEFT=7, TOTAL_IPC_CRIMES=3),
                     place("A", "C", 2001, MURDER=5, DOWRY_DEATHS=4, TOTAL_IPC_CRIMES=0)])
    got = {r[DISTRICT]: r[TOTAL] for r in cleaning.reconcile_total(df).collect()}
    assert got == {"B": 12, "C": 5}
    got = {r[DISTRICT]: r[TOTAL] for r in headers.derive_total(df).collect()}
    assert got == {"B": 3, "C": 9}


def test_all_numeric_drops_malformed_only(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("", "3"), (None, "4"), ("1,5", "6")], "a string, b string")
    assert sorted((r.a, r.b) for r in cleaning.all_numeric(df, ["a", "b"]).collect()) == [
        (0.0, 3.0), (0.0, 4.0), (1.0, 2.0), (15.0, 6.0)]


def test_header_rules():
    feeds = headers.assign_headers(["STATE/UT", "District", "Year", "KIDNAPPING & ABDUCTION", "KIDNAPPING OF WOMEN",
                                    "AUTO THEFT", "THEFT", "ATTEMPT TO MURDER", "CUSTODIAL RAPE",
                                    "INSULT TO MODESTY OF WOMEN", "TOTAL IPC CRIMES", "notes"])
    assert feeds["KIDNAPPING_ABDUCTION"] == ["KIDNAPPING & ABDUCTION", "KIDNAPPING OF WOMEN"]
    assert feeds["AUTO_THEFT"] == ["AUTO THEFT"] and feeds["THEFT"] == ["THEFT"]
    assert feeds["ATTEMPT_TO_MURDER"] == ["ATTEMPT TO MURDER"]
    assert "RAPE" not in feeds and feeds["INSULT_TO_MODESTY_OF_WOMEN"]
    old = headers.assign_headers(["AUTO THEFT", "THEFT", "INSULT TO MODESTY OF WOMEN"], strict_compat=True)
    assert old == {"THEFT": ["AUTO THEFT", "THEFT"]}


def test_raw_file_end_to_end(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        b"STATE/UT,DISTRICT,YEAR,MURDER,THEFT,AUTO THEFT,KIDNAPPING & ABDUCTION,TOTAL IPC CRIMES\n"
        b"Bihar,Patna,2014,\"1,234\",12.7,NA,,5000\n"
        b"Bihar,G\xffya,2014,1,2,3,4,\n"
        b"Bihar,Short\n"
        b",Nowhere,2014,1,1,1,1,1\n"
        b"Bihar,Bad,year,1,1,1,1,1\n")
    out = headers.unify_headers(text.read_delimited(spark, str(tmp_path / "a.csv")))
    rows = {r[DISTRICT]: r for r in out.collect()}
    assert sorted(rows) == ["G�YA", "PATNA"]
    assert (rows["PATNA"]["MURDER"], rows["PATNA"]["THEFT"], rows["PATNA"]["AUTO_THEFT"], rows["PATNA"][TOTAL]) == (
        1234, 12, 0, 5000)
    assert rows["G�YA"][TOTAL] == 10


def test_positions_follow_the_file(spark, tmp_path):
    lines = ["STATE,DISTRICT,YEAR,MURDER"] + [f"BIHAR,D{i % 50},2014,{i}" for i in range(500)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    df = text.read_delimited(spark, str(tmp_path / "a.csv"), keep_position=True)
    place_columns = ("_file", "_block", "_line")
    facts = headers.unify_headers(df, keep=place_columns)
    first = cleaning.first_wins(facts, [STATE, DISTRICT, YEAR], list(place_columns))
    assert sorted(r["MURDER"] for r in first.collect()) == list(range(50))


def test_sources_stack_with_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, cleaning.union_sources([a, b]).select("x", "y", "source_rank").collect()),
                  key=str) == [(1, 2, 0), (3, None, 1)]


def test_unpivot_caps_and_drops_zero(spark):
    df = raw(spark, [place("A", "B", 2001, MURDER=9, THEFT=2)])
    got = {(r.primary_type, r.incident_count) for r in incidents.unpivot_heads(df).collect()}
    assert got == {("MURDER", 5), ("THEFT", 2)}
    got = {(r.primary_type, r.incident_count) for r in incidents.unpivot_heads(df, cap=None).collect()}
    assert got == {("MURDER", 9), ("THEFT", 2)}
