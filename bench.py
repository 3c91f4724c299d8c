"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Stored stages are timed as queries of their own (``stage_*``), so a report's time
is the scan of its stage plus the report. A query's time is the median of three
runs; one that takes longer than ``ONCE`` seconds runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyfold.catalog import all_queries  # noqa: E402
from tallyfold.plans import stages  # noqa: E402
from tallyfold.session import build_session  # noqa: E402

HEADLINE = [
    "feature_table_direct", "cleaned_facts", "first_row_wins", "drifting_headers", "located_facts",
    "overlapping_places", "upper_quartiles", "severity_flag", "risk_scores", "trailing_risk",
    "last_events_window", "district_rollup", "hotspots", "yearly_top_districts", "yearly_grains",
    "region_totals", "property_recovery", "women_ranking", "place_profiles", "scenario_projection",
    "incident_events", "measured_week", "sql_top_places", "sql_yearly_nation", "sql_state_balance",
    "surge_alerts", "live_place_totals", "throughput_windows", "kmeans_assignment", "forest_scores",
    "roc_area", "correlation_ranking", "partitioned_table",
]


#: A first run beyond this many seconds is not repeated; start-up matters little there.
ONCE = 8.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}

    def clock(name, action, passes=3):
        taken = []
        while len(taken) < passes and (not taken or taken[0] <= ONCE):
            start = time.perf_counter()
            action()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)

    for name in ("raw", "clean", "feature"):
        # a stage is written once
        clock(f"stage_{name}", lambda n=name: getattr(stages, f"{n}_stage")(spark, folder), 1)
    by_name = {q.name: q for q in all_queries()}
    for name in HEADLINE:
        clock(name, lambda n=name: by_name[n].run(spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
