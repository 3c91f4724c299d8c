"""SQL reports."""

from __future__ import annotations

from tallyfold.catalog.checks import over_features
from tallyfold.catalog.registry import Query
from tallyfold.plans import sql_reports
from tallyfold.plans.stages import feature_stage


def _sql_report(sql):
    return lambda spark, folder: sql_reports.run_report(feature_stage(spark, folder), sql)


def _check(sql):
    return over_features(sql.replace("crimes_features", "features"))


QUERIES = [
    Query("sql_top_places", "A23", _sql_report(sql_reports.TOP_PLACES), _check(sql_reports.TOP_PLACES)),
    Query("sql_yearly_nation", "A24", _sql_report(sql_reports.YEARLY_NATION),
          _check(sql_reports.YEARLY_NATION)),
    Query("sql_state_balance", "A25", _sql_report(sql_reports.STATE_BALANCE),
          _check(sql_reports.STATE_BALANCE)),
]
