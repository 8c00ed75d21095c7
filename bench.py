"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma separated) set what is run. Each query is run
into a sink that drops its rows: once cold, then three times; the median of those counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace.queries import QUERIES
from millrace.session import local_session

HEADLINE = (
    "upsert,replace_by_key,upsert_null_safe,upsert_lineitem,dedup_keyed,update_from,insert_new,"
    "explode_lists,parse_list_text,json_flatten,json_scan,json_gate,csv_folder,publish_swap,"
    "stage_edges,stage_depends_on,scalars,base64_text,corpus_edges,depends_on,workflow_specs,"
    "rendered_sources,sql_sources,landing_upsert"
)
WARM_RUNS = 3


def timed(spark, run, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", HEADLINE).split(",")
    spark = local_session(cpus, name="bench")
    cold, warm = {}, {}
    for name in names:
        run = QUERIES[name].run
        cold[name] = round(timed(spark, run, sf_dir), 3)
        warm[name] = round(statistics.median(timed(spark, run, sf_dir) for _ in range(WARM_RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
