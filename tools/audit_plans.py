"""List what is worth a look in the physical plan of every query.

    python tools/audit_plans.py [folder] [name part ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfold.catalog import all_queries  # noqa: E402
from tallyfold.session import build_session  # noqa: E402


def main(argv):
    folder = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("audit", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for q in all_queries():
        if len(argv) > 2 and not any(w in q.name for w in argv[2:]):
            continue
        if q.name in ("kmeans_elbow",):
            continue
        df = q.run(spark, folder)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        found = {
            "exchanges": len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (hash|range|single|round)", plan)),
            "reused": plan.count("ReusedExchange"),
            "single": plan.count("SinglePartition"),
            "nested": len(re.findall("NestedLoop|Cartesian", plan)),
            "python": len(re.findall("Python|Pandas|Arrow", plan)),
            "scans": plan.count("FileScan"),
            "pushed": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
        }
        note = " ".join(f"{k}={v}" for k, v in found.items() if v)
        print(f"{q.name}: {note}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
