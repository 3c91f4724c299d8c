from pyspark.sql import functions as F

from tallyfold.operators import features as fx
from tallyfold.operators import profiles, rollups
from tallyfold.operators.enrich import with_region
from tallyfold.schema import (
    CLEAN_SCHEMA, COPIES, DISTRICT, FEATURE_SCHEMA, HEADS, LABEL, STATE, SUM_OF, SUMMED_COLUMNS, TOTAL, YEAR,
)


def clean(spark, rows):
    return spark.createDataFrame([tuple(r.get(f.name, 0 if f.name in HEADS + [TOTAL] else None)
                                        for f in CLEAN_SCHEMA.fields) for r in rows], CLEAN_SCHEMA)


SAMPLE = {
    STATE: "Goa", DISTRICT: "South Goa", YEAR: 2011, "LATITUDE": 15.12, "LONGITUDE": 74.12,
    "MURDER": 7, "ATTEMPT_TO_MURDER": 5, "DACOITY": 1, "ROBBERY": 12, "HURT": 65,
    "KIDNAPPING_ABDUCTION": 10, "BURGLARY": 40, "THEFT": 150, "AUTO_THEFT": 60, "RAPE": 9,
    "DOWRY_DEATHS": 1, "ASSAULT_ON_WOMEN": 20, "INSULT_TO_MODESTY_OF_WOMEN": 6, "CRUELTY_BY_HUSBAND": 14,
    "CHEATING": 70, "ARSON": 5, TOTAL: 500,
}


def empty_dims(spark):
    return (spark.createDataFrame([], f"{STATE} string, {DISTRICT} string, POPULATION bigint, POPULATION_DENSITY double, "
                                      "LITERACY_RATE double, URBAN_PERCENTAGE double"),
            spark.createDataFrame([], f"{STATE} string, {DISTRICT} string, POLICE_PER_LAKH double, "
                                      "CHARGESHEET_RATE double, CONVICTION_RATE double"),
            spark.createDataFrame([], f"{STATE} string, {DISTRICT} string, {YEAR} int, CYBER_CRIMES bigint"))


def test_sample_row(spark):
    row = fx.build_features(clean(spark, [SAMPLE]), *empty_dims(spark)).first()
    assert list(row.asDict()) == [f.name for f in FEATURE_SCHEMA.fields]
    assert (row["VIOLENT_CRIMES"], row["PROPERTY_CRIMES"], row["WOMEN_CRIMES"], row["ECONOMIC_CRIMES"]) == (
        100, 250, 50, 75)
    assert row["OTHER_CRIMES"] == 25 and row["VIOLENT_CRIME_RATIO"] == 0.2 and row[LABEL] == 1
    assert row["POPULATION"] == 1500000 and row["CRIME_RATE_PER_100K"] == 33.33
    assert row["DISTRICT_RISK_SCORE"] == 500.0 and row["CYBER_CRIMES"] == 0


def test_zero_total_and_small_population(spark):
    demo, police, cyber = empty_dims(spark)
    demo = spark.createDataFrame([("x", "y", 10, 1.0, 2.0, 3.0)], demo.schema)
    row = fx.build_features(clean(spark, [{STATE: "X", DISTRICT: "Y", YEAR: 2001, TOTAL: 0}]), demo, police, cyber).first()
    assert (row[TOTAL], row["POPULATION"], row["CRIME_RATE_PER_100K"], row["DISTRICT_RISK_SCORE"]) == (1, 50000, 2.0, 0.0)


def test_same_district_name_in_two_states(spark):
    rows = [{STATE: s, DISTRICT: "Aurangabad", YEAR: 2001, TOTAL: t} for s, t in (("A", 10), ("B", 30))]
    apart = {r[STATE]: r["DISTRICT_RISK_SCORE"] for r in fx.district_risk(clean(spark, rows)).collect()}
    merged = {r[STATE]: r["DISTRICT_RISK_SCORE"] for r in fx.district_risk(clean(spark, rows), True).collect()}
    assert apart == {"A": 10.0, "B": 30.0} and merged == {"A": 20.0, "B": 20.0}


def test_trailing_risk_skips_missing_years(spark):
    rows = [{STATE: "A", DISTRICT: "B", YEAR: y, TOTAL: t} for y, t in ((2001, 10), (2003, 20), (2009, 90))]
    got = {r[YEAR]: r["TRAILING_RISK"] for r in fx.trailing_risk(clean(spark, rows)).collect()}
    assert got == {2001: None, 2003: 10.0, 2009: None}


def features(spark, rows):
    return fx.build_features(clean(spark, rows), *empty_dims(spark))


def test_totals_agree_over_grains(spark):
    rows = [{**SAMPLE, DISTRICT: f"D{i}", STATE: f"S{i % 3}", YEAR: 2001 + i % 4, TOTAL: 4000 + i} for i in range(40)]
    f = features(spark, rows)
    total = rollups.grand_total(f).first()[0]
    assert total == sum(4000 + i for i in range(40))
    for frame in (rollups.district_rollup(f), rollups.state_rollup(f), rollups.year_rollup(f)):
        assert frame.groupBy().sum("total_crimes").first()[0] == total


def test_ties_at_the_cut_are_ordered(spark):
    rows = [{**SAMPLE, DISTRICT: f"D{i:02d}"} for i in range(30)]
    top = [r.district for r in rollups.top_districts(features(spark, rows), 5).collect()]
    assert top == [f"D{i:02d}" for i in range(5)]


def test_scenarios_match_the_formula(spark):
    p = spark.createDataFrame([("S", "D", 140000, 60.0, 120.0, 45.0)],
                              "state string, district string, total_crimes bigint, safety_score double, "
                              "police_per_lakh double, conviction_rate double")
    row = profiles.project_scenarios(p, [{"name": "x", "police_density": 220, "patrol_saturation": 95,
                                          "response_minutes": 10, "conviction_target": 55, "surveillance": 80}]).first()
    det = 1.0 * 16 + 0.5 * 12 + 0.5 * 10 + 0.1 * 9 + 0.5 * 7 + 12.5
    assert row.deterrence_pct == round(det, 1) and row.incidents_prevented == int(10000 * det / 100 + 0.5)
    assert row.new_safety_score == 88.5 and row.new_risk_level == "CONTROLLED"


def test_year_over_year(spark):
    df = spark.createDataFrame([(2001, 10), (2002, 15), (2003, 0), (2004, 5)], "YEAR int, v int")
    got = [(r.change, r.change_pct) for r in fx.year_over_year(df, "v").orderBy("YEAR").collect()]
    assert got == [(None, None), (5, 50.0), (-15, -100.0), (5, None)]


def test_empty_input(spark):
    f = features(spark, [])
    assert f.count() == 0 and rollups.hotspots(f).count() == 0 and profiles.place_profiles(f).count() == 0


def test_thresholds_know_no_last_year_and_no_year(spark):
    rows = [(y, n) for y in (2000, 20011, None) for n in range(1, 9)]
    df = spark.createDataFrame(rows, f"{YEAR} int, {TOTAL} bigint")
    hits = {r[YEAR]: r["n"] for r in fx.severity_label(df).groupBy(YEAR).agg(F.sum(LABEL).alias("n")).collect()}
    assert hits == {2000: 2, 20011: 2, None: 2}


def test_dirty_cyber_years_end_no_job(spark):
    demo, police, cyber = empty_dims(spark)
    cyber = spark.createDataFrame([("Goa", "South Goa", None, 9), ("Goa", "South Goa", 2011, 2), ("Goa", "SOUTH GOA", 2011, 3)],
                                  cyber.schema)
    assert fx.build_features(clean(spark, [SAMPLE]), demo, police, cyber).first()["CYBER_CRIMES"] == 5


def test_safety_score_does_not_change_with_k(spark):
    rows = [{**SAMPLE, DISTRICT: f"D{i}", TOTAL: 500 + 10 * i} for i in range(12)]
    table = fx.build_features(clean(spark, rows), *empty_dims(spark))
    few, many = ({r.district: r.safety_score for r in profiles.place_profiles(table, k).collect()} for k in (3, 150))
    assert len(few) == 3 and few == {d: many[d] for d in few}


def test_repeated_places_are_summed_without_a_row_for_each_pair(spark):
    demo, police, cyber = empty_dims(spark)
    demo = spark.createDataFrame([("S1", " d1 ", 90000 + i, 1.0, 2.0, 3.0) for i in range(3)] + [(None, "D1", 1, 1.0, 2.0, 3.0)],
                                 demo.schema)
    police = spark.createDataFrame([("s1", "D1", 1.0, 2.0, 3.0)] * 4 + [("S2", "D2", 1.0, 2.0, 3.0)] * 2, police.schema)
    rows = [{**SAMPLE, STATE: f"S{i % 3}", DISTRICT: f"D{i % 3}", YEAR: 2001 + i // 3, "LATITUDE": 1.0 + i, TOTAL: 500 + i}
            for i in range(6)]
    table = clean(spark, rows)
    every, groups = (f(table, demo, police, cyber).localCheckpoint() for f in (fx.build_features, fx.build_feature_groups))
    assert every.count() == 2 * (1 + 3 * 4 + 2) and groups.count() == len(rows)
    regions = spark.createDataFrame([("S1", "north"), ("S2", "south")], "state_key string, region string")

    def regional(rollup):
        return lambda f: rollup(with_region(f, regions))

    for rollup in (rollups.district_rollup, rollups.state_rollup, rollups.year_rollup, rollups.year_rollup_with_total,
                   rollups.grand_total, rollups.top_districts, rollups.hotspots, rollups.yearly_grains, rollups.latest_year,
                   lambda f: rollups.yearly_top_districts(f, 10), lambda f: rollups.yearly_top_districts(f, 13),
                   profiles.place_profiles, profiles.profile_totals,
                   regional(rollups.region_totals), regional(rollups.regional_year)):
        one, two = rollup(every), rollup(groups)
        assert one.schema == two.schema and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    shared = [c for c in groups.columns if c in every.columns]
    per_row = every.groupBy(shared).agg(F.count(F.lit(1)).alias(COPIES), *[
        F.sum(F.col(c).cast("decimal(28,6)")).alias(SUM_OF + c) for c in SUMMED_COLUMNS])
    assert sorted(map(repr, per_row.collect())) == sorted(map(repr, groups.collect()))


def test_rows_without_a_state_are_one_feature_row_each(spark):
    demo, police, cyber = empty_dims(spark)
    demo = spark.createDataFrame([(None, "D", 1, 1.0, 2.0, 3.0)] * 3, demo.schema)
    known = clean(spark, [{**SAMPLE, STATE: "", DISTRICT: "D"}]).withColumn(STATE, F.nullif(F.col(STATE), F.lit("")))
    for build in (fx.build_features, fx.build_feature_groups):
        rows = build(known, demo, police, cyber)
        assert rollups.grand_total(rows).first()[0] == 500
        means = profiles.profile_totals(rows).first()
        assert (means["_POPULATION"], means["_LITERACY_RATE"], means["_DISTRICT_RISK_SCORE"]) == (50000.0, None, None)
