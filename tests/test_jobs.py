"""The whole chain on small files."""

import json

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.rollups import property_recovery, women_ranking
from tallyfold.operators.tables import dimension_rows, recovery_rows, women_rows
from tallyfold.plans import jobs
from tallyfold.sources import text


def lines(path, rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("chain")
    old = ["STATE/UT,DISTRICT,YEAR,MURDER,THEFT,AUTO THEFT,RAPE,CHEATING,TOTAL IPC CRIMES"]
    new = ["States/UTs,District,Year,Murder,Theft,Auto Theft,Rape,Cheating"]
    for year in range(2001, 2007):
        for i in range(12):
            row = f"{'ORISSA' if i % 2 else 'BIHAR'},PLACE {i:02d},{year},{i},{10 * i + year % 5},{i},{2 + i % 3},{i % 4}"
            (old if year < 2004 else new).append(row + (f',"1,{100 + i}"' if year < 2004 else ""))
        (old if year < 2004 else new).append(f"BIHAR,TOTAL,{year},999,9,9,9,9" + (",9999" if year < 2004 else ""))
    new.append("ORISSA,Place 01,2003,555,1,1,1,1")
    old.append("BIHAR,OLD TIMES,1998,1,1,1,1,1,5")
    sources = [lines(d / "old.csv", old), lines(d / "new.csv", new)]
    gaz = d / "gaz.json"
    gaz.write_text(json.dumps({
        "districts": {"PLACE 00": {"lat": 25.6, "lon": 85.1, "state": "Bihar"}},
        "state_fallbacks": {"BIHAR": [25.1, 85.3], "ORISSA": [20.9, 85.1]}}))
    demo = lines(d / "demo.csv", ["STATE_UT,DISTRICT,POPULATION,POPULATION_DENSITY,LITERACY_RATE,URBAN_PERCENTAGE",
                                  "Bihar,Place 00,100,1,2,3", "Bihar,Place 00,200000,900.5,61.5,x"])
    p = {n: str(d / n) for n in ("raw", "clean", "features", "docs", "zoned", "km", "zones", "rf", "evaluation")}
    p["counts"] = [jobs.ingest(spark, sources, p["raw"]), jobs.clean(spark, p["raw"], str(gaz), p["clean"]),
                   jobs.engineer(spark, p["clean"], p["features"], demographics=demo)]
    return p


def test_rows_survive_as_expected(spark, chain):
    assert [c["rows"] for c in chain["counts"]] == [72 + 6 + 2, 72, 72]
    facts = spark.read.parquet(chain["clean"])
    assert {r[0] for r in facts.select("STATE_UT").distinct().collect()} == {"Bihar", "Odisha"}
    first = facts.filter("DISTRICT = 'Place 01' AND YEAR = 2003").first()
    assert first.MURDER == 1 and first.TOTAL_IPC_CRIMES == 1101
    assert facts.filter("DISTRICT = 'Place 00'").first().LATITUDE == 25.6


def test_dimension_last_row_wins(spark, chain):
    rows = spark.read.parquet(chain["features"])
    row = rows.filter("DISTRICT = 'Place 00'").first()
    assert (row.POPULATION, row.POPULATION_DENSITY, row.URBAN_PERCENTAGE) == (200000, 900.5, 30.0)
    assert rows.filter("DISTRICT = 'Place 01'").first().POPULATION == 1500000


def test_documents(spark, chain, tmp_path):
    recovery = lines(tmp_path / "r.csv", [
        "Year,State,Group,Value_of_Property_Stolen,Value_of_Property_Recovered,Cases_Property_Stolen,Cases_Property_Recovered",
        "2001,A,x,100000000,50000000,10,4", "2001,B,x,bad,1,1,1", "n/a,B,x,1,1,1,1", "2002,A,x,0,0,0,0"])
    women = lines(tmp_path / "w.csv", [
        "STATE/UT,DISTRICT,Year,Rape,Kidnapping and Abduction,Dowry Deaths,"
        "Assault on women with intent to outrage her modesty,Cruelty by Husband or his Relatives",
        "BIHAR,PATNA,2001,5,4,3,2,1", "BIHAR,TOTAL,2001,5,4,3,2,1", "GOA,NORTH,2001,9,9,,9,9.0"])
    jobs.report(spark, chain["features"], chain["clean"], chain["docs"], recovery, women)

    def doc(name):
        return [json.loads(r[0]) for r in spark.read.text(f"{chain['docs']}/{name}").collect()]

    trends = doc("crime_trends")[0]
    assert [t["year"] for t in trends["category_trends"]] == list(range(2001, 2007))
    assert trends["property_financial_trends"][0] == {
        "year": 2001, "stolen_inr_crores": 10.0, "recovered_inr_crores": 5.0, "financial_recovery_rate_pct": 50.0,
        "cases_stolen": 10, "cases_recovered": 4, "case_recovery_rate_pct": 40.0}
    assert [(w["state"], w["total_crimes_against_women"]) for w in doc("crime_trends_women_crimes_state_rankings")] == [
        ("Goa", 36), ("Bihar", 15)]
    times = doc("time_patterns")[0]
    assert len(times["heatmap_matrix"]) == 24 and len(times["heatmap_matrix"][0]["row"]) == 7
    total = times["totals"][0]["total_national_crimes"]
    assert total == sum(y["total_crimes"] for y in times["yearly_trends"])
    hot = doc("hotspots")[0]
    assert sum(s["total_crimes"] for s in doc("hotspots_state_rankings")) == total
    assert [len(hot[s]) for s in ("top_20_districts", "top_50_hotspots")] == [12, 12]
    assert {r["region"] for r in doc("regions_data")[0]["regions"]} == {"Eastern"}
    years = {y["year"]: y for y in doc("yearly_state_snapshots")}
    assert sum(y["national_total"] for y in years.values()) == total and len(years[2001]["top_districts"]) == 10
    assert {s["state"] for s in doc("yearly_state_snapshots_states") if s["year"] == 2001} == {"BIHAR", "ODISHA"}
    assert set(doc("district_profiles")[0]["districts"][0]["dna"]) == {
        "violent_pct", "property_pct", "women_pct", "economic_pct", "cyber_pct", "other_pct"}


def test_folder_of_two_generations(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    lines(folder / "a.csv", ["STATE/UT,DISTRICT,YEAR,MURDER,RAPE", "BIHAR,PATNA,2001,1,2", "BIHAR,SHORT,2001",
                             "BIHAR,NONE,2001,,"])
    lines(folder / "b.csv", ["STATE/UT,DISTRICT,YEAR,RAPE,MURDER", "BIHAR,PATNA,2002,4,3"])
    jobs.ingest(spark, [str(folder)], str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).select("DISTRICT", "YEAR", "MURDER", "RAPE").collect()
    assert sorted(tuple(r) for r in rows) == [("NONE", 2001, 0, 0), ("PATNA", 2001, 1, 2), ("PATNA", 2002, 3, 4)]


def test_rows_do_not_depend_on_the_columns_asked_for(spark, tmp_path):
    path = lines(tmp_path / "a.csv", ["A,B,C,D,E", "1,2,3,4,5", "1,2,3", '"1,5","2,5",3', "1,2,3,4"])
    df = text.read_delimited(spark, path)
    assert df.count() == df.select("B").count() == len(df.collect()) == df.groupBy("A").count().agg(F.sum("count")).first()[0] == 2
    side = text.read_delimited(spark, path, fewest=0)
    assert side.count() == side.select("B").count() == len(side.collect()) == 4


def test_models(spark, chain):
    jobs.cluster(spark, chain["features"], chain["zoned"], chain["km"], chain["zones"], k=3)
    zones = json.loads(spark.read.text(chain["zones"]).first()[0])
    assert len(zones["centroids"]) == 3
    assert sum(z["total_crimes"] for z in zones["clusters"]) == spark.read.parquet(chain["features"]).agg(
        F.sum("TOTAL_IPC_CRIMES")).first()[0]
    found = {r.metric: r.value for r in jobs.train(spark, chain["features"], chain["rf"], chain["evaluation"], 10).collect()}
    assert 0 <= found["accuracy"] <= 1 and found["true_positive"] + found["false_negative"] >= 0
    assert found["num_trees"] == 10 and found["train_size"] > 0
    assert found["test_size"] == sum(found[f"{s}_{v}"] for s in ("true", "false") for v in ("positive", "negative"))


def test_side_tables(spark, tmp_path):
    raw = text.read_delimited(spark, lines(tmp_path / "w.csv", [
        "State/UT,District,Rape,Dowry Deaths", "A,x,1,2", "A,Total,1,2", ",y,5,5", "B,z,q,1"]))
    assert [(r.state, r.total_crimes_against_women) for r in women_ranking(women_rows(raw)).collect()] == [
        ("Unknown", 10), ("A", 3)]
    assert women_ranking(women_rows(raw, True)).filter("state = 'A'").first().total_crimes_against_women == 6
    raw = text.read_delimited(spark, lines(tmp_path / "p.csv", ["YEAR,Value_of_Property_Stolen,a,b", "2001,5,,", "2001.5,7,,"]))
    assert [r.year for r in property_recovery(recovery_rows(raw)).collect()] == [2001]
    raw = text.read_delimited(spark, lines(tmp_path / "c.csv", ["STATE_UT,DISTRICT,YEAR,TOTAL_CYBER_CRIMES", "a,b,2017,5", "A,B ,2017,6"]),
                              keep_position=True)
    assert [tuple(r) for r in dimension_rows(raw, "cyber", list(jobs.PLACE_IN_SOURCE)).collect()] == [("A", "B", 2017, 6)]
