"""Parsing, filters, deduplication and normalization on deliberately dirtied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.checks import RAW, over_clean, over_raw, title, total
from tallyfold.catalog.registry import Query
from tallyfold.functions.numbers import lenient_int
from tallyfold.functions.text import first_given, place_key, place_label, title_case
from tallyfold.operators import cleaning, headers, incidents
from tallyfold.plans import trade
from tallyfold.plans.stages import clean_stage, raw_stage
from tallyfold.schema import DISTRICT, HEADS, RECONCILED_HEADS, STATE, TOTAL, YEAR

MEASURES = [*HEADS, TOTAL]


def _dirty(spark, folder) -> DataFrame:
    """Raw facts with subtotals, copies, blank names and lost totals.

    ``source_rank`` and ``source_row`` give the order in which rows were read.
    """
    facts = raw_stage(spark, folder).withColumn("source_row", F.col(YEAR))
    base = facts.withColumns({
        STATE: F.concat(F.lit(" "), F.lower(STATE)), DISTRICT: F.concat(F.lower(DISTRICT), F.lit(" ")),
        TOTAL: F.when(F.col(YEAR) % 3 != 0, F.col(TOTAL))})
    copies = facts.filter(F.col(YEAR) % 2 == 0).withColumns({
        "MURDER": F.col("MURDER") + 7, "source_row": F.col(YEAR) * 2})
    later = copies.withColumn("MURDER", F.col("MURDER") + 1).withColumn("source_row", F.col("source_row") + 1)
    sums = facts.groupBy(STATE, YEAR).agg(*[F.sum(m).alias(m) for m in MEASURES])
    subtotals = sums.withColumns({
        DISTRICT: F.when(F.col(YEAR) % 2 == 0, F.lit("Total")).otherwise(F.lit("Delhi UT Total")),
        "source_row": F.lit(0)})
    blank = facts.filter(F.col(YEAR) == 1997).withColumn(DISTRICT, F.lit("  "))
    early = facts.filter(F.col(YEAR) == 1998).withColumn(YEAR, F.lit(1200))
    columns = [STATE, DISTRICT, YEAR, *MEASURES, "source_row"]
    return cleaning.union_sources([f.select(columns) for f in (base, copies, later, subtotals, blank, early)])


_M = ", ".join(MEASURES)
DIRTY = f"""dirty AS (
  SELECT ' ' || lower(STATE_UT) AS STATE_UT, lower(DISTRICT) || ' ' AS DISTRICT, YEAR, {', '.join(HEADS)},
    CASE WHEN YEAR % 3 <> 0 THEN {TOTAL} END AS {TOTAL}, 0 AS source_rank, YEAR AS source_row FROM raw_facts
  UNION ALL SELECT STATE_UT, DISTRICT, YEAR, MURDER + 7, {', '.join(HEADS[1:])}, {TOTAL}, 1, YEAR * 2
    FROM raw_facts WHERE YEAR % 2 = 0
  UNION ALL SELECT STATE_UT, DISTRICT, YEAR, MURDER + 8, {', '.join(HEADS[1:])}, {TOTAL}, 2, YEAR * 2 + 1
    FROM raw_facts WHERE YEAR % 2 = 0
  UNION ALL SELECT STATE_UT, CASE WHEN YEAR % 2 = 0 THEN 'Total' ELSE 'Delhi UT Total' END, YEAR,
    {', '.join(f'CAST(sum({m}) AS BIGINT)' for m in MEASURES)}, 3, 0 FROM raw_facts GROUP BY STATE_UT, YEAR
  UNION ALL SELECT STATE_UT, '  ', YEAR, {_M}, 4, YEAR FROM raw_facts WHERE YEAR = 1997
  UNION ALL SELECT STATE_UT, DISTRICT, 1200, {_M}, 5, YEAR FROM raw_facts WHERE YEAR = 1998)"""


def over_dirty(select: str, extra: str = "") -> str:
    return f"WITH {RAW},\n{DIRTY}{',' + extra if extra else ''}\n{select}"


KEEP = "length(trim(DISTRICT)) > 0 AND upper(DISTRICT) NOT LIKE '%TOTAL%' AND upper(DISTRICT) NOT LIKE '%DELHI UT%'"
COUNTS = "count(*) AS n, CAST(sum(MURDER) AS BIGINT) AS murders"


def _counts(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("MURDER").cast("bigint").alias("murders"))


def _clean_dirty(spark, folder):
    order = [F.col("source_rank"), F.col("source_row")]
    return cleaning.clean_facts(_dirty(spark, folder), order, first_year=1996).select(
        STATE, DISTRICT, YEAR, *MEASURES)


CLEAN_DIRTY_SQL = over_dirty(
    f"""SELECT STATE_UT, DISTRICT, YEAR, {', '.join(HEADS)},
      greatest(coalesce({TOTAL}, 0), {total(RECONCILED_HEADS)}) AS {TOTAL}
    FROM named QUALIFY row_number() OVER (
      PARTITION BY STATE_UT, DISTRICT, YEAR ORDER BY source_rank, source_row) = 1""",
    f"""named AS (SELECT {title('trim(STATE_UT)')} AS STATE_UT, {title('trim(DISTRICT)')} AS DISTRICT,
      YEAR, {_M}, source_rank, source_row FROM dirty WHERE YEAR >= 1996 AND {KEEP})""")


def _event_texts(spark, folder):
    """Event numbers in four notations, one of them unusable."""
    k = F.get_json_object("props", "$.k")
    kind = F.pmod("event_id", F.lit(4))
    noisy = (F.when(kind == 0, k).when(kind == 1, F.concat(F.lit("1,"), F.lpad(k, 3, "0")))
             .when(kind == 2, F.concat(F.lit(" "), k, F.lit(".7"))).otherwise(F.lit("NA")))
    return trade.table(spark, folder, "events").select("event_id", "event_type", noisy.alias("noisy"), k.alias("k"))


TEXTS = """texts AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k,
  CASE event_id % 4 WHEN 0 THEN json_extract_string(props, '$.k')
    WHEN 1 THEN '1,' || lpad(json_extract_string(props, '$.k'), 3, '0')
    WHEN 2 THEN ' ' || json_extract_string(props, '$.k') || '.7' ELSE 'NA' END AS noisy FROM events)"""


def _strict(spark, folder):
    rows = cleaning.all_numeric(_event_texts(spark, folder), ["noisy", "k"])
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.floor("noisy")).cast("bigint").alias("whole"), F.sum(F.floor("k")).cast("bigint").alias("k_sum"))


def _alternatives(spark, folder):
    c = trade.table(spark, folder, "customer")
    blank = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    other = F.when(F.pmod("c_custkey", F.lit(3)) != 0, F.col("c_name"))
    return c.select("c_custkey", first_given(blank, other, default="UNKNOWN").alias("given"))


def _missing(spark, folder):
    holed = raw_stage(spark, folder).withColumn(
        "RAPE", F.when(F.col(YEAR) != 1999, F.col("RAPE"))).drop("HURT")
    return cleaning.fill_missing(holed, ["RAPE", "HURT"]).select(STATE, DISTRICT, YEAR, "RAPE", "HURT")


def _derived(spark, folder):
    lost = raw_stage(spark, folder).withColumn(TOTAL, F.when(F.col(YEAR) % 2 == 0, F.col(TOTAL) + 5).otherwise(0))
    return headers.derive_total(lost).select(STATE, DISTRICT, YEAR, TOTAL)


def _reconciled(spark, folder):
    low = raw_stage(spark, folder).withColumn(TOTAL, F.floor(F.col(TOTAL) / 2))
    return cleaning.reconcile_total(low).select(STATE, DISTRICT, YEAR, TOTAL)


ALIASES = {"NATION_1": "Odisha", "NATION_13": "Delhi", "NATION_24": "Goa"}


def _states(spark, folder):
    nation = trade.table(spark, folder, "nation").select(
        "n_nationkey", F.concat(F.lit("  "), F.lower("n_name")).alias(STATE))
    suppliers = trade.table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    named = cleaning.normalize_states(nation, STATE, ALIASES)
    return suppliers.join(named, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", STATE)


def _title(spark, folder):
    c = trade.table(spark, folder, "customer")
    raw = F.concat(F.lower("c_mktsegment"), F.lit("/"), F.upper("c_name"), F.lit("'s & co 2nd"))
    return c.select("c_custkey", title_case(raw).alias("titled"))


def _dedup_first(spark, folder):
    rows = cleaning.drop_subtotals(_dirty(spark, folder)).withColumns({STATE: F.upper(F.trim(STATE)), DISTRICT: F.upper(F.trim(DISTRICT))})
    return cleaning.first_wins(rows, [STATE, DISTRICT, YEAR], [F.desc("source_rank"), F.desc("source_row")]).select(
        STATE, DISTRICT, YEAR, "MURDER", "source_rank")


def _place_keys(spark, folder):
    return clean_stage(spark, folder).groupBy(STATE, DISTRICT).agg(F.count(F.lit(1)).alias("years")).select(
        place_key(F.col(STATE), F.col(DISTRICT)).alias("place"),
        place_label(F.col(STATE), F.col(DISTRICT)).alias("label"), "years")


EVENT_HEADS = ["MURDER", "ROBBERY", "BURGLARY", "THEFT", "RIOTS", "CHEATING", "ARSON"]


def _unpivot_sql(cap):
    value = f"least({{h}}, {cap})" if cap else "{h}"
    return " UNION ALL ".join(
        f"SELECT STATE_UT AS state, DISTRICT AS district, YEAR AS year, '{h}' AS primary_type, "
        f"CAST({value.format(h=h)} AS BIGINT) AS incident_count FROM clean WHERE {h} > 0" for h in EVENT_HEADS)


EVENT_KEY = "state || '|' || district || '|' || year || '|' || primary_type"

QUERIES = [
    Query("lenient_numbers", "P3", lambda s, d: _event_texts(s, d).select(
        "event_id", lenient_int(F.col("noisy")).alias("n")),
        f"WITH {TEXTS} SELECT event_id, CASE WHEN noisy = 'NA' THEN CAST(0 AS BIGINT) ELSE "
        "CAST(trunc(CAST(replace(trim(noisy), ',', '') AS DOUBLE)) AS BIGINT) END AS n FROM texts"),
    Query("strict_numbers", "F4", _strict,
          f"WITH {TEXTS} SELECT event_type, count(*) AS n, "
          "CAST(sum(floor(CAST(replace(trim(noisy), ',', '') AS DOUBLE))) AS BIGINT) AS whole, "
          "CAST(sum(CAST(k AS BIGINT)) AS BIGINT) AS k_sum FROM texts WHERE noisy <> 'NA' GROUP BY event_type"),
    Query("alternative_columns", "P4", _alternatives,
          """SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment
             WHEN c_custkey % 3 <> 0 THEN c_name ELSE 'UNKNOWN' END AS given FROM customer"""),
    Query("missing_as_zero", "P5", _missing, over_raw(
        "SELECT STATE_UT, DISTRICT, YEAR, CASE WHEN YEAR <> 1999 THEN RAPE ELSE 0 END AS RAPE, "
        "CAST(0 AS BIGINT) AS HURT FROM raw_facts")),
    Query("derived_total", "P6", _derived, over_raw(
        f"SELECT STATE_UT, DISTRICT, YEAR, CASE WHEN YEAR % 2 = 0 THEN {TOTAL} + 5 ELSE {total(HEADS)} END "
        f"AS {TOTAL} FROM raw_facts")),
    Query("reconciled_total", "P7", _reconciled, over_raw(
        f"SELECT STATE_UT, DISTRICT, YEAR, greatest({TOTAL} // 2, {total(RECONCILED_HEADS)}) AS {TOTAL} "
        "FROM raw_facts")),
    Query("state_names", "P8", _states,
          "SELECT s_suppkey, CASE n_name WHEN 'NATION_1' THEN 'Odisha' WHEN 'NATION_13' THEN 'Delhi' "
          f"WHEN 'NATION_24' THEN 'Goa' ELSE {title('n_name')} END AS STATE_UT "
          "FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
    Query("title_case", "P9", _title,
          f"SELECT c_custkey, {title('c_mktsegment')} || '/' || {title('c_name')} || '''S & Co 2Nd' AS titled "
          "FROM customer"),
    Query("without_subtotals", "F1", lambda s, d: _counts(cleaning.drop_subtotals(_dirty(s, d)), YEAR, "source_rank"),
          over_dirty(f"SELECT YEAR, source_rank, {COUNTS} FROM dirty WHERE {KEEP} GROUP BY YEAR, source_rank")),
    Query("from_year", "F2", lambda s, d: _counts(cleaning.from_year(_dirty(s, d), 1998), "source_rank"),
          over_dirty(f"SELECT source_rank, {COUNTS} FROM dirty WHERE YEAR >= 1998 GROUP BY source_rank")),
    Query("valid_rows", "F3", lambda s, d: _counts(headers.valid_rows(
        _dirty(s, d).withColumns({DISTRICT: F.trim(DISTRICT), YEAR: F.when(F.col(YEAR) > 1995, F.col(YEAR)).otherwise(0)})),
        "source_rank"),
        over_dirty(f"SELECT source_rank, {COUNTS} FROM dirty WHERE length(trim(DISTRICT)) > 0 AND YEAR > 1995 "
                   "GROUP BY source_rank")),
    Query("stacked_sources", "U1", lambda s, d: _counts(_dirty(s, d), "source_rank"),
          over_dirty(f"SELECT source_rank, {COUNTS} FROM dirty GROUP BY source_rank")),
    Query("first_row_wins", "U2", _dedup_first, over_dirty(
        """SELECT upper(trim(STATE_UT)) AS STATE_UT, upper(trim(DISTRICT)) AS DISTRICT, YEAR, MURDER, source_rank
        FROM (SELECT * FROM dirty WHERE """ + KEEP + """)
        QUALIFY row_number() OVER (PARTITION BY upper(trim(STATE_UT)), upper(trim(DISTRICT)), YEAR
          ORDER BY source_rank DESC, source_row DESC) = 1""")),
    Query("any_row_wins", "U3", lambda s, d: cleaning.any_wins(_dirty(s, d), [STATE, DISTRICT, YEAR]).select(
        STATE, DISTRICT, YEAR), over_dirty("SELECT DISTINCT STATE_UT, DISTRICT, YEAR FROM dirty")),
    Query("distinct_years", "U4", lambda s, d: raw_stage(s, d).select(YEAR).distinct(),
          "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS YEAR FROM lineitem"),
    Query("cleaned_facts", "F1 F2 U2 P5 P7 P8 P9", _clean_dirty, CLEAN_DIRTY_SQL),
    Query("place_keys", "P22", _place_keys, over_clean(
        "SELECT STATE_UT || '::' || DISTRICT AS place, DISTRICT || ' (' || STATE_UT || ')' AS label, "
        "count(*) AS years FROM clean GROUP BY STATE_UT, DISTRICT")),
    Query("unpivoted_heads", "P24 F8", lambda s, d: incidents.unpivot_heads(clean_stage(s, d)),
          over_clean(_unpivot_sql(5))),
    Query("unpivoted_heads_uncapped", "P24", lambda s, d: incidents.unpivot_heads(clean_stage(s, d), cap=None),
          over_clean(_unpivot_sql(None))),
    Query("incident_feed", "P25", lambda s, d: incidents.as_feed(
        incidents.unpivot_heads(clean_stage(s, d)).withColumn("event_id", F.concat_ws("/", "state", "district", "year", "primary_type")),
        "YEARLY_COUNTS", F.make_date("year", F.lit(12), F.lit(31))).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm")), over_clean(
        f"""SELECT concat_ws('/', state, district, year, primary_type) AS event_id, CAST(year AS VARCHAR) || '-12-31 00:00' AS "timestamp",
          trim(state) AS state, trim(district) AS district, CAST(year AS INTEGER) AS year, primary_type, incident_count,
          'YEARLY_COUNTS' AS source FROM ({_unpivot_sql(5)})""")),
    Query("incident_events", "P25", lambda s, d: incidents.incident_events(clean_stage(s, d)), over_clean(
        f"""SELECT state, district, year, primary_type, incident_count,
          'EV-' || (100000 + row_number() OVER (ORDER BY CAST('0x' || substr(md5({EVENT_KEY}), 1, 8) AS BIGINT) % 4096,
            state, district, year, primary_type)) AS event_id
        FROM ({_unpivot_sql(5)})""")),
]
