"""Compare registered queries with their SQL on one scale.

    python tools/check_queries.py [folder] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfold.catalog import all_queries  # noqa: E402
from tallyfold.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in values)


def main(argv):
    folder = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = build_session("check", f"local[{os.environ.get('BENCH_CPUS', '8')}]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for q in all_queries():
        if wanted and not any(w in q.name for w in wanted):
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            got = df.collect()
        except Exception as exc:  # a report tool: show and go on
            bad += 1
            print(f"FAIL {q.name}: {type(exc).__name__} {str(exc)[:1500]}")
            continue
        took = time.time() - start
        if not q.sql:
            print(f"ok   {q.name}: {len(got)} rows, no SQL ({took:.1f}s)")
            continue
        try:
            answer = con.sql(q.sql)
            want = answer.fetchall()
        except Exception as exc:
            bad += 1
            print(f"FAIL {q.name}: SQL {str(exc)[:1500]}")
            continue
        kinds = dict(zip(df.columns, [f.dataType.simpleString() for f in df.schema.fields]))
        a, b = rows(df.columns, got), rows(answer.columns, want)
        if sorted(df.columns) != sorted(answer.columns):
            bad += 1
            print(f"FAIL {q.name}: columns {sorted(set(df.columns) ^ set(answer.columns))}")
        elif a != b:
            bad += 1
            extra = [x for x in a if x not in set(b)][:3]
            lack = [x for x in b if x not in set(a)][:3]
            print(f"FAIL {q.name}: {len(a)} vs {len(b)} rows\n  cols {sorted(df.columns)}\n  spark {extra}\n  sql   {lack}\n  {kinds}")
        else:
            types = {c: str(t) for c, t in zip(answer.columns, answer.types)}
            same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
            off = [f"{c}:{k}/{types[c]}" for c, k in kinds.items() if k in same and same[k] != types[c]]
            print(f"ok   {q.name}: {len(a)} rows ({took:.1f}s)" + (f"  types {off}" if off else ""))
    print("failures:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
