"""SQL building blocks of the checks, written for DuckDB."""

from __future__ import annotations

from tallyfold.plans.trade import HEAD_SOURCES
from tallyfold.schema import CATEGORIES, HEADS, OTHER, RECONCILED_HEADS, TOTAL


def r(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double, as Spark rounds."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,22)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int) -> str:
    inner = r(f"CAST({part} AS DOUBLE) * 100 / CAST({whole} AS DOUBLE)", digits)
    return f"CASE WHEN {whole} > 0 THEN {inner} ELSE 0.0 END"


def bucket(text: str, n: int) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {n})"


def title(column: str) -> str:
    """Title case of names that are letters, one break and digits."""
    return f"upper(substr({column}, 1, 1)) || lower(substr({column}, 2))"


def total(names) -> str:
    return " + ".join(names)


_HEAD_COLUMNS = ",\n    ".join(
    f"CAST(count(*) FILTER (WHERE p_type = '{t}' AND l_returnflag = '{f}') AS BIGINT) AS {h}"
    for h, (t, f) in HEAD_SOURCES.items())

PLACES = """places AS (
  SELECT s_suppkey, s_acctbal, n_nationkey, r_regionkey, s_name, n_name, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

RAW = f"""{PLACES},
raw_facts AS (
  SELECT n_name AS STATE_UT, s_name AS DISTRICT, CAST(year(l_shipdate) AS INTEGER) AS YEAR,
    {_HEAD_COLUMNS},
    CAST(count(*) AS BIGINT) AS {TOTAL},
    any_value(places.s_suppkey) AS s_suppkey, any_value(s_acctbal) AS s_acctbal,
    any_value(n_nationkey) AS n_nationkey, any_value(r_regionkey) AS r_regionkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN places ON l_suppkey = places.s_suppkey
  GROUP BY n_name, s_name, year(l_shipdate))"""

JITTER = f"({bucket('s_name', 100)} - 50) * 0.005"

LOCATED = f"""located AS (
  SELECT s_suppkey, n_name, s_name,
    CASE WHEN s_suppkey % 2 = 0 THEN CAST(800 + (s_suppkey * 37) % 2900 AS DOUBLE) / 100
         WHEN r_regionkey < 4 THEN {r(f"10.0 + n_nationkey + {JITTER}", 4)}
         ELSE 20.5937 END AS LATITUDE,
    CASE WHEN s_suppkey % 2 = 0 THEN CAST(6800 + (s_suppkey * 53) % 2900 AS DOUBLE) / 100
         WHEN r_regionkey < 4 THEN {r(f"70.0 + n_nationkey + {JITTER}", 4)}
         ELSE 78.9629 END AS LONGITUDE,
    CASE WHEN s_suppkey % 2 = 0 THEN 'exact' WHEN r_regionkey < 4 THEN 'state'
         ELSE 'national' END AS LOCATED_BY
  FROM places)"""

CLEAN = f"""{RAW},
{LOCATED},
clean AS (
  SELECT {title('STATE_UT')} AS STATE_UT, {title('DISTRICT')} AS DISTRICT, YEAR,
    LATITUDE, LONGITUDE, {', '.join(HEADS)},
    greatest({TOTAL}, {total(RECONCILED_HEADS)}) AS {TOTAL},
    raw_facts.s_suppkey, s_acctbal, r_regionkey
  FROM raw_facts JOIN located ON raw_facts.s_suppkey = located.s_suppkey)"""

DIMENSIONS = """demographics AS (
  SELECT n_name AS STATE_UT, s_name AS DISTRICT, s_suppkey,
    CAST(20000 + (s_suppkey * 7919) % 2000000 AS BIGINT) AS POPULATION,
    CAST(100 + s_suppkey % 900 AS DOUBLE) AS POPULATION_DENSITY,
    CAST(50 + s_suppkey % 45 AS DOUBLE) AS LITERACY_RATE,
    CAST(10 + s_suppkey % 80 AS DOUBLE) AS URBAN_PERCENTAGE
  FROM places WHERE s_acctbal > 0),
police AS (
  SELECT n_name AS STATE_UT, s_name AS DISTRICT, s_suppkey,
    CAST(80 + s_suppkey % 200 AS DOUBLE) AS POLICE_PER_LAKH,
    CAST(50 + s_suppkey % 45 AS DOUBLE) AS CHARGESHEET_RATE,
    CAST(20 + s_suppkey % 60 AS DOUBLE) AS CONVICTION_RATE
  FROM places WHERE s_acctbal > 2000),
cyber AS (
  SELECT l_suppkey AS s_suppkey, CAST(year(l_shipdate) AS INTEGER) AS YEAR,
    CAST(count(*) AS BIGINT) AS CYBER_CRIMES
  FROM lineitem
  WHERE l_linestatus = 'O' AND l_discount >= 0.05 AND l_shipdate >= TIMESTAMP '1997-01-01'
  GROUP BY l_suppkey, year(l_shipdate))"""

# Exclusive upper quartile per year, from ranks.
QUARTILES = f"""ranked AS (
  SELECT YEAR, {TOTAL} AS x, row_number() OVER (PARTITION BY YEAR ORDER BY {TOTAL}) AS i,
    count(*) OVER (PARTITION BY YEAR) AS n
  FROM clean),
positions AS (
  SELECT *, greatest(1, least(n - 1, (3 * (n + 1)) // 4)) AS j FROM ranked),
quartiles AS (
  SELECT YEAR, CASE WHEN max(n) < 4 THEN CAST(max(x) AS DOUBLE) ELSE
    CAST(max(CASE WHEN i = j THEN x END) * (4 - (3 * (max(n) + 1) - 4 * max(j)))
       + max(CASE WHEN i = j + 1 THEN x END) * (3 * (max(n) + 1) - 4 * max(j)) AS DOUBLE) / 4
    END AS p75
  FROM positions GROUP BY YEAR)"""

_CATEGORY_SUMS = ",\n    ".join(f"{total(heads)} AS {name}" for name, heads in CATEGORIES.items())
_RATIOS = ",\n    ".join(
    r(f"CAST({name} AS DOUBLE) / CAST({TOTAL} AS DOUBLE)", 4)
    + f" AS {name.replace('_CRIMES', '_CRIME_RATIO')}" for name in CATEGORIES)


def rate(count: str, people: str, floor: int = 50000, digits: int = 2) -> str:
    return r(f"CAST({count} AS DOUBLE) / CAST(greatest({people}, {floor}) AS DOUBLE) * 100000", digits)


FEATURES = f"""{CLEAN},
{DIMENSIONS},
{QUARTILES},
floored AS (
  SELECT clean.* REPLACE (greatest({TOTAL}, 1) AS {TOTAL}), {TOTAL} AS reported FROM clean),
summed AS (
  SELECT *, {_CATEGORY_SUMS} FROM floored),
features AS (
  SELECT s.STATE_UT, s.DISTRICT, s.YEAR, LATITUDE, LONGITUDE, {TOTAL}, {', '.join(CATEGORIES)},
    greatest(0, {TOTAL} - ({total(CATEGORIES)})) AS {OTHER},
    {_RATIOS},
    {r("avg(reported) OVER (PARTITION BY s.STATE_UT, s.DISTRICT)", 2)} AS DISTRICT_RISK_SCORE,
    {r("avg(reported) OVER (PARTITION BY s.STATE_UT)", 2)} AS STATE_RISK_SCORE,
    greatest(coalesce(d.POPULATION, 1500000), 50000) AS POPULATION,
    coalesce(d.POPULATION_DENSITY, 500.0) AS POPULATION_DENSITY,
    coalesce(d.LITERACY_RATE, 74.0) AS LITERACY_RATE,
    coalesce(d.URBAN_PERCENTAGE, 30.0) AS URBAN_PERCENTAGE,
    {rate(TOTAL, "coalesce(d.POPULATION, 1500000)")} AS CRIME_RATE_PER_100K,
    {rate("VIOLENT_CRIMES", "coalesce(d.POPULATION, 1500000)")} AS VIOLENT_RATE_PER_100K,
    coalesce(p.POLICE_PER_LAKH, 160.0) AS POLICE_PER_LAKH,
    coalesce(p.CHARGESHEET_RATE, 78.0) AS CHARGESHEET_RATE,
    coalesce(p.CONVICTION_RATE, 45.0) AS CONVICTION_RATE,
    coalesce(c.CYBER_CRIMES, 0) AS CYBER_CRIMES,
    CASE WHEN {TOTAL} >= q.p75 THEN 1 ELSE 0 END AS HIGH_SEVERITY_FLAG,
    0 AS LOCATION_CLUSTER, s.s_suppkey, s.r_regionkey
  FROM summed s
  LEFT JOIN demographics d ON s.s_suppkey = d.s_suppkey
  LEFT JOIN police p ON s.s_suppkey = p.s_suppkey
  LEFT JOIN cyber c ON s.s_suppkey = c.s_suppkey AND s.YEAR = c.YEAR
  LEFT JOIN quartiles q ON s.YEAR = q.YEAR)"""

REGIONS = """state_regions AS (
  SELECT upper(n_name) AS state_key, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 4)"""

INCIDENTS = """incidents AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS "timestamp",
    coalesce('S' || (user_id % 10), 'UNKNOWN') AS state,
    coalesce(CASE WHEN user_id % 29 <> 0 THEN 'U' || user_id END, 'UNKNOWN') AS district,
    CAST(year(ts) AS INTEGER) AS year,
    coalesce(CASE WHEN event_type <> 'view' THEN upper(event_type) END, 'OTHER') AS primary_type,
    coalesce(CASE WHEN value >= 1 THEN CAST(floor(value) AS BIGINT) END, 1) AS incident_count,
    'FEED' AS source
  FROM events)"""


def over_raw(select: str) -> str:
    return f"WITH {RAW}\n{select}"


def over_clean(select: str) -> str:
    return f"WITH {CLEAN}\n{select}"


def over_features(select: str, extra: str = "") -> str:
    return f"WITH {FEATURES}{',' + extra if extra else ''}\n{select}"


def over_incidents(select: str, extra: str = "") -> str:
    return f"WITH {INCIDENTS}{',' + extra if extra else ''}\n{select}"
