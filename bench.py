"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query
runs to the end into Spark's no-op sink, twice; the better time counts, the first
run also pays for code generation.
"""

from __future__ import annotations

import json
import os
import time

from vaultwright.plans import QUERIES
from vaultwright.session import build_session

HEADLINE = [
    "stage_full_refresh",
    "surrogate_key",
    "hub_initial",
    "hub_incremental",
    "hub_incremental_semi_anti",
    "hub_multi_source",
    "hub_after_two_batches",
    "link_initial",
    "link_incremental",
    "link_pair_distinct",
    "link_wide_initial",
    "sat_initial",
    "sat_incremental_by_key",
    "sat_incremental_by_hashdiff",
    "sat_history_latest",
    "linksat_initial",
    "linksat_incremental",
    "linksat_wide_initial",
    "pk_violations",
    "fk_violations",
    "job_circuits_refresh",
    "job_constructors_history",
    "job_drivers_twice",
    "job_races_twice",
    "job_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({
        "metric": "vault_load_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
