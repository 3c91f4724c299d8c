"""Sources and sinks, checked by reading back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.catalog.checks import REGIONS, over_clean, over_features, over_raw, r
from tallyfold.catalog.registry import Query
from tallyfold.constants import DAY_WEIGHTS, SEASON_WEIGHTS
from tallyfold.functions.numbers import parse_double
from tallyfold.operators import rollups
from tallyfold.operators import tables as side
from tallyfold.operators.headers import unify_headers
from tallyfold.plans import reports, trade
from tallyfold.plans.stages import clean_stage, feature_group_stage, raw_stage, stage_paths
from tallyfold.schema import CLEAN_SCHEMA, DISTRICT, HEADS, RAW_SCHEMA, STATE, TOTAL, YEAR
from tallyfold.session import scratch_path
from tallyfold.sources import documents, gazetteer, tables, text
from tallyfold.sources.paths import storage_path
from tallyfold.streaming import feeds

# The same heads under the header spellings of two source generations.
OLD_HEADERS = {
    STATE: "STATE/UT", DISTRICT: "DISTRICT", YEAR: "YEAR", "MURDER": "MURDER",
    "ATTEMPT_TO_MURDER": "ATTEMPT TO MURDER",
    "CULPABLE_HOMICIDE": "CULPABLE HOMICIDE NOT AMOUNTING TO MURDER", "RAPE": "RAPE",
    "KIDNAPPING_ABDUCTION": "KIDNAPPING & ABDUCTION", "DACOITY": "DACOITY", "ROBBERY": "ROBBERY",
    "BURGLARY": "BURGLARY", "THEFT": "OTHER THEFT", "AUTO_THEFT": "AUTO THEFT", "RIOTS": "RIOTS",
    "CHEATING": "CHEATING", "ARSON": "ARSON", "HURT": "HURT/GREVIOUS HURT",
    "DOWRY_DEATHS": "DOWRY DEATHS",
    "ASSAULT_ON_WOMEN": "ASSAULT ON WOMEN WITH INTENT TO OUTRAGE HER MODESTY",
    "INSULT_TO_MODESTY_OF_WOMEN": "INSULT TO MODESTY OF WOMEN",
    "CRUELTY_BY_HUSBAND": "CRUELTY BY HUSBAND OR HIS RELATIVES", TOTAL: "TOTAL IPC CRIMES",
}
NEW_HEADERS = {**{k: v.title() for k, v in OLD_HEADERS.items()},
               STATE: "States/UTs", DISTRICT: "Districts", "BURGLARY": "Criminal Trespass/Burglary"}
LAST_OLD_YEAR = 1998


def _csv_round_trip(spark, folder):
    path = scratch_path(spark, "supplier_csv")
    text.write_delimited(trade.table(spark, folder, "supplier"), path)
    raw = text.read_delimited(spark, path)
    return raw.select(
        F.col("s_suppkey").try_cast("bigint").alias("s_suppkey"), "s_name",
        F.col("s_nationkey").try_cast("int").alias("s_nationkey"),
        parse_double(F.col("s_acctbal")).alias("s_acctbal"))


def _drifted(spark, folder, strict):
    """Two CSV generations of the raw facts, read back and unified."""
    facts = raw_stage(spark, folder)

    def shown(headers, commas):
        def cell(name):
            value = F.col(name)
            if name in HEADS + [TOTAL]:
                value = F.format_number(value * 1000, 0) if commas else (value * 1000).cast("string")
            return value.cast("string").alias(headers[name])
        return [cell(n) for n in [STATE, DISTRICT, YEAR, *HEADS]]

    old_path, new_path = (scratch_path(spark, n) for n in ("old_csv", "new_csv"))
    old = facts.filter(F.col(YEAR) <= LAST_OLD_YEAR)
    new = facts.filter(F.col(YEAR) > LAST_OLD_YEAR)
    text.write_delimited(old.select(
        *shown(OLD_HEADERS, True), F.lit("5").alias("CUSTODIAL RAPE"),
        F.format_number(F.col(TOTAL) * 1000, 0).alias(OLD_HEADERS[TOTAL])), old_path)
    # The later generation carries no total, and years as decimals.
    text.write_delimited(new.withColumn(YEAR, F.concat(F.col(YEAR), F.lit(".0")))
                         .select(*shown(NEW_HEADERS, False)), new_path)
    parts = [unify_headers(text.read_delimited(spark, p), strict) for p in (old_path, new_path)]
    return parts[0].unionByName(parts[1])


def _generations(spark, folder):
    """One folder that holds files of both generations and files of short lines, parted by header line."""
    facts = raw_stage(spark, folder)
    top = scratch_path(spark, "generations")

    def shown(headers):
        return [F.col(n).cast("string").alias(headers[n]) for n in [STATE, DISTRICT, YEAR, *HEADS, TOTAL]]

    def place(name):
        return storage_path(f"data/{name}", top)

    text.write_delimited(facts.filter(F.col(YEAR) <= LAST_OLD_YEAR).select(*shown(OLD_HEADERS)), place("old"))
    text.write_delimited(facts.filter(F.col(YEAR) > LAST_OLD_YEAR).select(*shown(NEW_HEADERS)), place("new"))
    # lines of three fields only, below a whole header line of their own file
    short = facts.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n")).select(
        F.concat_ws(",", F.lit("CUT"), F.lit("SHORT"), F.col(YEAR)).alias("value"))
    header = ",".join(OLD_HEADERS[n] for n in [STATE, DISTRICT, YEAR, *HEADS, TOTAL])
    whole = short.agg(F.array_join(F.array_sort(F.collect_list("value")), "\n").alias("v")).select(
        F.concat(F.lit(header + "\n"), "v").alias("value"))
    whole.coalesce(1).write.text(place("short"))
    parts = [unify_headers(df) for df in text.read_generations(spark, place("*"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(STATE, DISTRICT, YEAR, *HEADS, TOTAL)


def _stored_path(spark, folder):
    """A table written below a base folder by a relative path, and read by the same two."""
    base = scratch_path(spark, "base") + "/"
    trade.table(spark, folder, "customer").write.parquet(storage_path("data/processed/customers", base))
    back = tables.read_table(spark, storage_path("/processed/customers/", base.rstrip("/")))
    return back.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.sum("c_custkey").cast("bigint").alias("keys"))


def _drift_sql(strict):
    def head(h):
        if strict and h == "THEFT":
            return "(THEFT + AUTO_THEFT) * 1000 AS THEFT"
        if strict and h in ("AUTO_THEFT", "INSULT_TO_MODESTY_OF_WOMEN"):
            return f"CAST(0 AS BIGINT) AS {h}"
        return f"{h} * 1000 AS {h}"
    lost = "INSULT_TO_MODESTY_OF_WOMEN" if strict else "0"
    return over_raw(
        f"SELECT upper(STATE_UT) AS STATE_UT, upper(DISTRICT) AS DISTRICT, YEAR, "
        f"{', '.join(head(h) for h in HEADS)}, "
        f"CASE WHEN YEAR <= {LAST_OLD_YEAR} THEN {TOTAL} ELSE {TOTAL} - {lost} END * 1000 AS {TOTAL} "
        "FROM raw_facts")


def _partitioned(spark, folder):
    path = scratch_path(spark, "facts_by_year_state")
    tables.write_partitioned(raw_stage(spark, folder), path)
    return tables.read_table(spark, path, RAW_SCHEMA).filter(
        (F.col(YEAR) >= 1999) & (F.col(STATE) >= "NATION_2")).select(STATE, DISTRICT, YEAR, TOTAL)


def _audit(spark, folder):
    facts = raw_stage(spark, folder)
    counts = tables.audited_write(facts, scratch_path(spark, "facts_audited"))
    return spark.range(1).select(F.lit(counts["rows"]).cast("bigint").alias("rows"),
                                 F.lit(counts["columns"]).cast("bigint").alias("columns"))


def _external(spark, folder):
    path = scratch_path(spark, "facts_external")
    tables.write_partitioned(clean_stage(spark, folder), path)
    name = "facts_" + path.rsplit("-", 1)[1]
    try:
        table = tables.register_external(spark, name, CLEAN_SCHEMA, path)
        counts = table.groupBy(YEAR, STATE).agg(F.count(F.lit(1)).alias("places"), F.sum(TOTAL).cast("bigint").alias("total_crimes"))
        return _kept(spark, counts, "external_counts")
    finally:
        tables.drop_registered(spark, [name])


def _kept(spark, df, label):
    """A small result in a folder of its own, so that it outlives the tables it was read from."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stage_tables(spark, folder):
    """The three tables over the folders of the stored stages, counted through the catalog."""
    locations = stage_paths(spark, folder)
    prefix = "t" + scratch_path(spark, "name").rsplit("-", 1)[1] + "_"
    try:
        registered = tables.register_stages(spark, locations, prefix, (YEAR,))
        counts = [df.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n"), F.sum(TOTAL).cast("bigint").alias("total"))
                  .select(F.lit(name).alias("name"), YEAR, "n", "total") for name, df in registered.items()]
        return _kept(spark, counts[0].unionByName(counts[1]).unionByName(counts[2]), "stage_counts")
    finally:
        tables.drop_registered(spark, [prefix + name for name in locations])


def _view(spark, folder):
    tables.register_view(raw_stage(spark, folder), "facts_view")
    return spark.sql("SELECT YEAR, CAST(SUM(MURDER) AS BIGINT) AS murders FROM facts_view GROUP BY YEAR")


def _gazetteer(spark, folder):
    nation = trade.table(spark, folder, "nation")
    path = scratch_path(spark, "gazetteer")
    # The nation table is a fixed list of names, so one row may hold it.
    entry = F.struct(F.col("n_name"), F.struct(
        (F.col("n_nationkey") + 10.5).alias("lat"), (F.col("n_nationkey") + 70.25).alias("lon"),
        F.concat(F.lit("Zone "), F.col("n_regionkey")).alias("state")))
    centre = F.struct(F.concat(F.lit("Zone "), F.col("n_regionkey")),
                      F.array(F.lit(20.5), F.col("n_regionkey") + 70.5))
    doc = nation.agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("districts"),
        F.map_from_entries(F.sort_array(F.collect_set(centre))).alias("state_fallbacks"))
    documents.write_json_lines(doc, path)
    districts, states = gazetteer.read_gazetteer(spark, path)
    return districts.join(states, F.col("gaz_state") == F.col("centroid_state")).select(
        "position", "gaz_name", "gaz_state", "gaz_lat", "gaz_lon", "centroid_lat", "centroid_lon")


HOTSPOT_ROW = ("struct<district:string,state:string,lat:double,lon:double,total_crimes:bigint,"
               "violent_crimes:bigint,property_crimes:bigint,women_crimes:bigint,"
               "violent_percentage:double,women_crime_pct:double,risk_level:string>")


def _document(spark, folder):
    path = scratch_path(spark, "hotspots_json")
    reports.hotspot_document(feature_group_stage(spark, folder), path)
    return documents.read_section(spark, path, "top_50_hotspots", HOTSPOT_ROW)


HOTSPOT_SQL = f"""SELECT DISTRICT AS district, STATE_UT AS state,
  arg_min(LATITUDE, YEAR) AS lat, arg_min(LONGITUDE, YEAR) AS lon,
  CAST(sum({TOTAL}) AS BIGINT) AS total_crimes,
  CAST(sum(VIOLENT_CRIMES) AS BIGINT) AS violent_crimes,
  CAST(sum(PROPERTY_CRIMES) AS BIGINT) AS property_crimes,
  CAST(sum(WOMEN_CRIMES) AS BIGINT) AS women_crimes,
  {r(f'CAST(sum(VIOLENT_CRIMES) AS DOUBLE) * 100 / CAST(sum({TOTAL}) AS DOUBLE)', 2)} AS violent_percentage,
  {r(f'CAST(sum(WOMEN_CRIMES) AS DOUBLE) * 100 / CAST(sum({TOTAL}) AS DOUBLE)', 2)} AS women_crime_pct,
  CASE WHEN {r(f'CAST(sum(VIOLENT_CRIMES) AS DOUBLE) * 100 / CAST(sum({TOTAL}) AS DOUBLE)', 2)} > 20
    OR sum({TOTAL}) > 200000 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level
FROM features GROUP BY DISTRICT, STATE_UT
ORDER BY total_crimes DESC, state, district LIMIT 50"""


def _time_document(spark, folder):
    path = scratch_path(spark, "time_json")
    reports.time_document(feature_group_stage(spark, folder), path)
    years = documents.read_section(spark, path, "yearly_trends", "struct<year:int,total_crimes:bigint>")
    seasons = documents.read_section(spark, path, "seasonal_breakdown",
                                     "struct<season:string,estimated_crimes:bigint,percentage:double>")
    hours = documents.read_section(spark, path, "heatmap_matrix", "struct<hour:int,row:array<bigint>>")
    return (years.select(F.lit("year").alias("section"), F.col("year").cast("string").alias("name"),
                         F.col("total_crimes").alias("value"))
            .unionByName(seasons.select(F.lit("season").alias("section"), F.col("season").alias("name"),
                                        F.col("estimated_crimes").alias("value")))
            .unionByName(hours.select(F.lit("hour").alias("section"), F.col("hour").cast("string").alias("name"),
                                      F.aggregate("row", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("value"))))


_SEASONS = ", ".join(f"('{n}', CAST({w} AS DOUBLE))" for n, w, _ in SEASON_WEIGHTS)
_DAYS = ", ".join(f"(CAST({w} AS DOUBLE))" for w in DAY_WEIGHTS)
TIME_SQL = f"""SELECT 'year' AS section, CAST(YEAR AS VARCHAR) AS name, total AS value FROM yearly
UNION ALL SELECT 'season', season, CAST(floor(latest * weight) AS BIGINT)
  FROM latest, (VALUES {_SEASONS}) AS v(season, weight)
UNION ALL SELECT 'hour', CAST(hour AS VARCHAR), CAST(sum(floor(latest * CASE WHEN hour >= 20 OR hour <= 2
    THEN CAST(0.065 AS DOUBLE) WHEN hour BETWEEN 9 AND 19 THEN CAST(0.045 AS DOUBLE) ELSE CAST(0.015 AS DOUBLE) END
    * w / 52)) AS BIGINT) FROM latest, range(24) AS h(hour), (VALUES {_DAYS}) AS v(w) GROUP BY hour"""


def _trend_document(spark, folder):
    """Category trends and the ranking of women crimes, over CSV side tables."""
    women, path = scratch_path(spark, "women_csv"), scratch_path(spark, "trend_json")
    facts = raw_stage(spark, folder).select(
        F.col(STATE).alias("STATE/UT"), F.col(DISTRICT).alias("DISTRICT"),
        *[F.col(n).cast("string").alias(h) for n, h in side.WOMEN_HEADERS.items()])
    text.write_delimited(facts.unionByName(facts.filter("DISTRICT LIKE '%3'").withColumn("DISTRICT", F.lit("TOTAL"))),
                         women)
    reports.trend_document(feature_group_stage(spark, folder), side.women_rows(text.read_delimited(spark, women, fewest=0)),
                           trade.recovery_facts(spark, folder), path)
    years = documents.read_section(spark, path, "category_trends", "struct<year:int,violent_crimes:bigint>")
    ranked = documents.read_section(spark, path, "women_crimes_state_rankings",
                                    "struct<state:string,total_crimes_against_women:bigint>")
    return years.select(F.col("year").cast("string").alias("name"), F.col("violent_crimes").alias("value")).unionByName(
        ranked.select(F.col("state").alias("name"), F.col("total_crimes_against_women").alias("value")))


def _region_document(spark, folder):
    path = scratch_path(spark, "region_json")
    reports.region_document(feature_group_stage(spark, folder), path, trade.regions(spark, folder))
    return documents.read_section(spark, path, "regions",
                                  "struct<region:string,total_crimes:bigint,states_count:bigint>")


def _recovery_file(spark, folder):
    """Orders as a recovery file with some broken figures, read back."""
    path = scratch_path(spark, "recovery_csv")
    facts = trade.table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("Year"),
        F.when(F.pmod("o_orderkey", F.lit(10)) == 3, F.lit("n/a")).otherwise(
            F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("Value_of_Property_Stolen"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("Value_of_Property_Recovered"),
        F.lit("1").alias("Cases_Property_Stolen"),
        F.when(F.col("o_orderstatus") == "F", F.lit("1.0")).otherwise(F.lit("")).alias("Cases_Property_Recovered"))
    text.write_delimited(facts, path)
    return rollups.property_recovery(side.recovery_rows(text.read_delimited(spark, path, fewest=0)))


_KEPT = "FROM orders WHERE o_orderkey % 10 <> 3 GROUP BY year(o_orderdate)"
_STOLEN = "sum(CAST(o_totalprice AS DECIMAL(18,2)))"
_FOUND = "coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0)"
_CASES = "count(*) FILTER (WHERE o_orderstatus = 'F')"
RECOVERY_FILE_SQL = f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  {r(f"CAST({_STOLEN} AS DOUBLE) / 1e7", 2)} AS stolen_inr_crores, {r(f"CAST({_FOUND} AS DOUBLE) / 1e7", 2)} AS recovered_inr_crores,
  {r(f"CAST({_FOUND} AS DOUBLE) * 100 / CAST({_STOLEN} AS DOUBLE)", 2)} AS financial_recovery_rate_pct,
  count(*) AS cases_stolen, {_CASES} AS cases_recovered,
  {r(f"CAST({_CASES} AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE)", 2)} AS case_recovery_rate_pct {_KEPT}"""


def _snapshot_lines(spark, folder):
    path = scratch_path(spark, "snapshots_json")
    reports.snapshot_lines(feature_group_stage(spark, folder), path)
    years = spark.read.schema("year int, national_total bigint, national_violent_pct double").json(path)
    states = spark.read.schema("year int, state string, total_crimes bigint, violent_pct double").json(f"{path}_states")
    return years.join(states, "year")


def _profiles_document(spark, folder):
    path = scratch_path(spark, "profiles_json")
    reports.profile_document(feature_group_stage(spark, folder), path, 150)
    row = "struct<district:string,state:string,total_crimes:bigint,dna:struct<violent_pct:double>>"
    rows = documents.read_section(spark, path, "districts", row)
    return rows.select("district", "state", "total_crimes", F.col("dna.violent_pct").alias("violent_pct"))


def _feed_round_trip(spark, folder):
    path = scratch_path(spark, "feed_json")
    feeds.encode_events(trade.incidents(spark, folder)).write.text(path)
    back = feeds.decode_events(spark.read.text(path))
    return back.groupBy("state", "primary_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("incident_count").cast("bigint").alias("incidents"),
        F.count("district").alias("with_district"))



QUERIES = [
    Query("csv_round_trip", "S1 S10", _csv_round_trip,
          "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"),
    Query("header_generations", "S2 S7", _generations, over_raw(
        f"SELECT upper(STATE_UT) AS STATE_UT, upper(DISTRICT) AS DISTRICT, YEAR, {', '.join(HEADS)}, {TOTAL} FROM raw_facts")),
    Query("stored_path", "S7", _stored_path,
          "SELECT c_nationkey, count(*) AS customers, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY c_nationkey"),
    Query("drifting_headers", "S2 P1 P2 P3 P6 F3 U1", lambda s, d: _drifted(s, d, False), _drift_sql(False)),
    Query("drifting_headers_compat", "S2 P2", lambda s, d: _drifted(s, d, True), _drift_sql(True)),
    Query("partitioned_table", "S3 S4", _partitioned, over_raw(
        f"SELECT STATE_UT, DISTRICT, YEAR, {TOTAL} FROM raw_facts "
        "WHERE YEAR >= 1999 AND STATE_UT >= 'NATION_2'")),
    Query("write_audit", "S16", _audit, over_raw(
        "SELECT count(*) AS \"rows\", CAST(22 AS BIGINT) AS \"columns\" FROM raw_facts")),
    Query("external_table", "S5", _external, over_clean(
        f"SELECT YEAR, STATE_UT, count(*) AS places, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes "
        "FROM clean GROUP BY YEAR, STATE_UT")),
    Query("stage_tables", "S5", _stage_tables, over_features(
        f"""SELECT 'crimes_raw' AS name, YEAR, count(*) AS n, CAST(sum({TOTAL}) AS BIGINT) AS total
          FROM raw_facts GROUP BY YEAR
        UNION ALL SELECT 'crimes_clean', YEAR, count(*), CAST(sum({TOTAL}) AS BIGINT) FROM clean GROUP BY YEAR
        UNION ALL SELECT 'crimes_features', YEAR, count(*), CAST(sum({TOTAL}) AS BIGINT) FROM features
          GROUP BY YEAR""")),
    Query("temp_view", "S6", _view, over_raw(
        "SELECT YEAR, CAST(sum(MURDER) AS BIGINT) AS murders FROM raw_facts GROUP BY YEAR")),
    Query("gazetteer_document", "S8", _gazetteer,
          "SELECT row_number() OVER (ORDER BY n_name) - 1 AS position, n_name AS gaz_name, "
          "'ZONE ' || n_regionkey AS gaz_state, n_nationkey + CAST(10.5 AS DOUBLE) AS gaz_lat, "
          "n_nationkey + CAST(70.25 AS DOUBLE) AS gaz_lon, CAST(20.5 AS DOUBLE) AS centroid_lat, "
          "n_regionkey + CAST(70.5 AS DOUBLE) AS centroid_lon FROM nation"),
    Query("hotspot_document", "S9 A1 K1 P14 P15", _document, over_features(HOTSPOT_SQL)),
    Query("time_document", "S9 A3 A20 P29", _time_document, over_features(TIME_SQL, f""" yearly AS (
        SELECT YEAR, CAST(sum({TOTAL}) AS BIGINT) AS total FROM features GROUP BY YEAR),
        latest AS (SELECT CAST(total AS DOUBLE) AS latest FROM yearly ORDER BY YEAR DESC LIMIT 1)""")),
    Query("trend_document", "S9 S1 A6 F1 F4", _trend_document, over_features(
        f"""SELECT CAST(YEAR AS VARCHAR) AS name, CAST(sum(VIOLENT_CRIMES) AS BIGINT) AS value FROM features GROUP BY YEAR
        UNION ALL SELECT STATE_UT, CAST(sum({' + '.join(side.WOMEN_HEADERS)}) AS BIGINT) FROM clean GROUP BY STATE_UT""")),
    Query("region_document", "S9 A7", _region_document, over_features(
        f"""SELECT coalesce(region, 'Northern') AS region, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes,
          count(DISTINCT STATE_UT) AS states_count
        FROM features LEFT JOIN state_regions ON upper(STATE_UT) = state_key GROUP BY 1""", REGIONS)),
    Query("recovery_file", "A5 S1 P4 F4", _recovery_file, RECOVERY_FILE_SQL),
    Query("snapshot_document", "S9 A8", _snapshot_lines, over_features(
        f"""SELECT y.YEAR AS year, national_total, national_violent_pct, state, total_crimes, violent_pct
        FROM (SELECT YEAR, CAST(sum({TOTAL}) AS BIGINT) AS national_total,
                {r(f'CAST(sum(VIOLENT_CRIMES) AS DOUBLE) * 100 / CAST(sum({TOTAL}) AS DOUBLE)', 1)}
                AS national_violent_pct FROM features GROUP BY YEAR) y
        JOIN (SELECT YEAR, upper(STATE_UT) AS state, CAST(sum({TOTAL}) AS BIGINT) AS total_crimes,
                {r(f'CAST(sum(VIOLENT_CRIMES) AS DOUBLE) * 100 / CAST(sum({TOTAL}) AS DOUBLE)', 1)}
                AS violent_pct FROM features GROUP BY YEAR, upper(STATE_UT)) s ON y.YEAR = s.YEAR""")),
    Query("profile_document", "S9 A9", _profiles_document, over_features(
        f"""SELECT DISTRICT AS district, STATE_UT AS state,
        CAST(sum({TOTAL}) AS BIGINT) AS total_crimes,
        {r(f'CAST(sum(VIOLENT_CRIMES) AS DOUBLE) * 100 / CAST(sum({TOTAL}) AS DOUBLE)', 1)} AS violent_pct
        FROM features GROUP BY DISTRICT, STATE_UT
        ORDER BY total_crimes DESC, state, district LIMIT 150""")),
    Query("json_feed_round_trip", "S11 S13", _feed_round_trip,
          """WITH e AS (SELECT 'S' || (user_id % 10) AS state, user_id,
               CASE WHEN event_type <> 'view' THEN upper(event_type) END AS primary_type,
               CASE WHEN value >= 1 THEN CAST(floor(value) AS BIGINT) END AS n FROM events)
             SELECT state, primary_type, count(*) AS events, CAST(sum(n) AS BIGINT) AS incidents,
               count(CASE WHEN user_id % 29 <> 0 THEN 1 END) AS with_district
             FROM e GROUP BY state, primary_type"""),
    Query("replay_capped", "S12", lambda s, d: feeds.replay(trade.incidents(s, d)).select("event_id", "year"),
          "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(year(ts) AS INTEGER) AS year FROM events "
          "ORDER BY ts, CAST(event_id AS VARCHAR) LIMIT 5000"),
]
