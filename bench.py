"""Benchmark: the warehouse's headline runs at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Times (wall clock, seconds). The JVM is warmed up first by running the same
pipeline once on the smallest fixture (sf0.001, if present) - class loading
and code generation are paid there, as in a long-lived cluster session - then
every step below is timed on ``BENCH_SF_DIR``:

* source_snapshots - derive the stand-in source from the test tables, write it
                     once as parquet, and define the t0/t1 snapshots over it;
* full_load        - full historical load of t0 (dims, calendar, fact, publish);
* incremental_load - SCD2/SCD1 apply + new fact rows of t1, publish;
* star_query       - net sales by customer attribute as of sale time;
* validation       - PK checks, SCD2 checks, unknown audit, reconciliation (concurrent);

and prints ONE JSON line: ``value`` is the sum of all steps, ``warehouse_sec``
the same without the stand-in source, ``load_jobs`` the number of Spark jobs
the two loads ran (AQE submits each shuffle stage as its own job).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.operators import quality as Q  # noqa: E402
from starloom.plans.loads import full_load, incremental_load  # noqa: E402
from starloom.plans.validation import run_checks  # noqa: E402
from starloom.plans.warehouse import Warehouse  # noqa: E402
from starloom.schemas import CUSTOMER  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402
from starloom.sources.driver_tables import scenario  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="starloom-bench")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.realpath(warm_dir) != os.path.realpath(sf_dir):
        wsc = scenario(spark, warm_dir, workdir=scratch_path(spark, "bench-warmup-source"))
        wroot = scratch_path(spark, "bench-warmup")
        full_load(spark, wsc.t0, wroot, dt.datetime(2024, 1, 1))
        incremental_load(spark, wsc.t1, wroot, dt.date.fromisoformat(wsc.effective_date_iso), dt.datetime(2024, 1, 1))
    else:
        spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    sc = timed("source_snapshots", lambda: scenario(spark, sf_dir, workdir=scratch_path(spark, "bench-source")))
    root = scratch_path(spark, "bench-warehouse")
    ts = dt.datetime(2024, 1, 1)
    tracker = spark.sparkContext.statusTracker()
    jobs_before = max(tracker.getJobIdsForGroup(None))  # ids count up; old jobs drop out of the tracker
    timed("full_load", lambda: full_load(spark, sc.t0, root, ts))
    m = timed(
        "incremental_load",
        lambda: incremental_load(spark, sc.t1, root, dt.date.fromisoformat(sc.effective_date_iso), ts),
    )
    load_jobs = max(tracker.getJobIdsForGroup(None)) - jobs_before
    wh = Warehouse(spark, root)
    fact = wh.table("fact_sales_line", m)
    dim_c = wh.table(CUSTOMER.table, m)

    star = timed(
        "star_query",
        lambda: Q.as_of_star_query(fact, dim_c, "customer_sk", "contact_title").collect(),
    )

    checks = timed("validation", lambda: run_checks(wh, m, sc.t1.order_details))
    violations = sum(c.violations for c in checks)
    total = round(sum(times.values()), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "warehouse_end_to_end",
                "value": total,
                "unit": "sec",
                "queries": times,
                "warehouse_sec": round(total - times["source_snapshots"], 3),
                "sf": float(sf.group(1)) if sf else sf_dir,
                "fact_rows": m.table_rows("fact_sales_line"),
                "star_groups": len(star),
                "checks": len(checks),
                "load_jobs": load_jobs,
                "violations": violations,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
