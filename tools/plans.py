"""Print the physical plans of the headline jobs (after execution, so AQE's
final decisions show), reduced to joins, exchanges, aggregates, windows and
scans, with the number of exchanges.

    python tools/plans.py [sf_dir] [--big]

``--big`` disables Spark's automatic broadcasts, i.e. the plan a large cluster
gets when every dimension is beyond the broadcast limit.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.operators import quality as Q  # noqa: E402
from starloom.operators.facts import build_fact  # noqa: E402
from starloom.operators.scd import scd2_apply  # noqa: E402
from starloom.operators.staging import stage_customer  # noqa: E402
from starloom.plans.catalog import built_warehouse  # noqa: E402
from starloom.plans.loads import star_dimensions  # noqa: E402
from starloom.plans.warehouse import CURRENT  # noqa: E402
from starloom.schemas import CUSTOMER  # noqa: E402
from starloom.session import build_session  # noqa: E402

KEEP = re.compile(r"Join|Exchange|HashAggregate|Window|Scan|Union|Sort \[")


def show(title: str, df) -> None:
    df.count()  # run it: the executed adaptive plan holds the final strategy
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"\n### {title}\n")
    print("```")
    for line in plan.splitlines():
        if KEEP.search(line):
            txt = re.sub(r"#\d+L?", "", line.rstrip())
            txt = re.sub(r"\[plan_id=\d+\]", "", txt)
            print(txt[:150])
    print("```")
    n = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan))
    print(f"\nshuffle exchanges: {n}; broadcast exchanges: {plan.count('BroadcastExchange')}")


def main() -> None:
    args = sys.argv[1:]
    big = "--big" in args
    sf_dir = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.01")
    extra = {}
    if big:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session(extra=extra)
    b = built_warehouse(spark, sf_dir)
    wh = b.wh(spark)
    dims = star_dimensions(wh, b.incremental)
    t1 = b.scenario.t1
    print(f"# plans at {sf_dir}{' (all dimensions treated as huge)' if big else ''}")
    show(
        "incremental fact build",
        build_fact(t1.orders, t1.order_details, dims, dt.datetime(2024, 1, 1), min_order_id_exclusive=b.full.watermark),
    )
    res = scd2_apply(
        wh.table(CUSTOMER.table, b.full, part=CURRENT),
        stage_customer(t1.customers),
        CUSTOMER,
        dt.date(2000, 1, 1),
        b.full.next_sk["customer"],
    )
    show("SCD2 apply (customer): new current part + closed versions", res.versions)
    fact = wh.table("fact_sales_line", b.incremental)
    show("as-of star query", Q.as_of_star_query(fact, wh.table(CUSTOMER.table, b.incremental), "customer_sk", "contact_title"))
    show("version overlap check", Q.check_overlap(wh.table(CUSTOMER.table, b.incremental), CUSTOMER))
    spark.stop()


if __name__ == "__main__":
    main()
