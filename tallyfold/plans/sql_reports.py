"""Reports written in SQL over the registered feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column types are pinned so that results look the same on every engine.
TOP_PLACES = """
SELECT STATE_UT, DISTRICT,
       CAST(SUM(TOTAL_IPC_CRIMES) AS BIGINT) AS total_crimes,
       CAST(SUM(VIOLENT_CRIMES) AS BIGINT) AS total_violent,
       ROUND(CAST(SUM(VIOLENT_CRIMES) AS DOUBLE) * 100
             / CAST(SUM(TOTAL_IPC_CRIMES) AS DOUBLE), 2) AS violent_percentage
FROM crimes_features
GROUP BY STATE_UT, DISTRICT
ORDER BY total_crimes DESC, STATE_UT, DISTRICT
LIMIT 10
"""

YEARLY_NATION = """
SELECT YEAR,
       CAST(SUM(TOTAL_IPC_CRIMES) AS BIGINT) AS national_total_crimes,
       CAST(SUM(VIOLENT_CRIMES) AS BIGINT) AS national_violent_crimes,
       CAST(SUM(PROPERTY_CRIMES) AS BIGINT) AS national_property_crimes,
       CAST(SUM(WOMEN_CRIMES) AS BIGINT) AS national_crimes_against_women,
       ROUND(CAST(SUM(CAST(DISTRICT_RISK_SCORE AS DECIMAL(18, 2))) AS DOUBLE)
             / CAST(COUNT(DISTRICT_RISK_SCORE) AS DOUBLE), 2) AS avg_district_risk
FROM crimes_features
GROUP BY YEAR
ORDER BY YEAR
"""

STATE_BALANCE = """
SELECT STATE_UT,
       CAST(SUM(VIOLENT_CRIMES) AS BIGINT) AS total_violent,
       CAST(SUM(PROPERTY_CRIMES) AS BIGINT) AS total_property,
       CAST(SUM(WOMEN_CRIMES) AS BIGINT) AS total_women_crimes,
       CAST(SUM(TOTAL_IPC_CRIMES) AS BIGINT) AS total_crimes,
       ROUND(CAST(SUM(VIOLENT_CRIMES) AS DOUBLE)
             / CAST(NULLIF(SUM(PROPERTY_CRIMES), 0) AS DOUBLE), 3) AS violent_to_property_ratio
FROM crimes_features
GROUP BY STATE_UT
ORDER BY total_crimes DESC, STATE_UT
LIMIT 15
"""


def run_report(features: DataFrame, sql: str) -> DataFrame:
    """Run one report with ``features`` as the table ``crimes_features``."""
    return features.sparkSession.sql(
        sql.replace("crimes_features", "{crimes_features}"), crimes_features=features)
