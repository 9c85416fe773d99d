"""Command line: the warehouse workflow as Spark jobs.

    python -m starloom init        --warehouse PATH
    python -m starloom full        --warehouse PATH --source PATH
    python -m starloom incremental --warehouse PATH --source PATH --effective-date 2024-03-01
    python -m starloom validate    --warehouse PATH [--source PATH] [--strict]
    python -m starloom runs        --warehouse PATH
    python -m starloom expire      --warehouse PATH --keep 10

``--source`` is a folder with one parquet dataset per source table
(customers, products, categories, suppliers, employees, shippers, orders,
order_details). Under ``spark-submit`` the cluster's session is used; run
locally, a ``local[*]`` session is created.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from starloom.operators import quality as Q
from starloom.plans.loads import full_load, incremental_load, init_warehouse
from starloom.plans.validation import ValidationError, run_checks
from starloom.plans.warehouse import Warehouse
from starloom.session import build_session, ensure_checkpoint_dir
from starloom.sources.source import Source


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    return build_session(master="local[*]")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=["init", "full", "incremental", "validate", "runs", "expire"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--source")
    ap.add_argument("--effective-date", type=dt.date.fromisoformat)
    ap.add_argument("--strict", action="store_true", help="validate: exit 1 on a broken invariant")
    ap.add_argument("--keep", type=int, default=10, help="expire: newest runs to keep")
    args = ap.parse_args(argv)

    spark = _session()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if args.command in ("full", "incremental") and not args.source:
        ap.error(f"{args.command} needs --source")
    if args.command == "init":
        m = init_warehouse(spark, args.warehouse)
    elif args.command == "full":
        m = full_load(spark, Source.from_parquet(spark, args.source), args.warehouse, now)
    elif args.command == "incremental":
        if not args.effective_date:
            ap.error("incremental needs --effective-date")
        m = incremental_load(spark, Source.from_parquet(spark, args.source), args.warehouse, args.effective_date, now)
    elif args.command == "validate":
        details = Source.from_parquet(spark, args.source).order_details if args.source else None
        try:
            results = run_checks(Warehouse(spark, args.warehouse), order_details=details, raise_on_violation=args.strict)
        except ValidationError as e:
            print(json.dumps({"valid": False, "error": str(e)}))
            return 1
        print(json.dumps([r.__dict__ for r in results]))
        return 0
    elif args.command == "expire":
        print(json.dumps({"removed": Warehouse(spark, args.warehouse).expire(args.keep)}))
        return 0
    else:  # runs
        log = Q.recent_runs(Warehouse(spark, args.warehouse).table("etl_run_log"), 10)
        print(json.dumps([{k: str(v) for k, v in r.asDict().items()} for r in log.collect()]))
        return 0
    print(json.dumps({"run_id": m.run_id, "run_type": m.run_type, "watermark": m.watermark, "rows": m.rows}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
