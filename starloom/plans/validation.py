"""The validation suite over a published warehouse state.

``run_checks`` runs every check as its own Spark job, concurrently, and
returns one summary row per check (only aggregates reach the driver). With
``raise_on_violation`` a broken key, version or interval invariant raises, so
a scheduler can stop before anything downstream reads the run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import quality as Q
from starloom.parallel import run_parallel
from starloom.plans.warehouse import Manifest, Warehouse
from starloom.schemas import CUSTOMER, DIMENSIONS, FACT_KEY, PRODUCT


@dataclass
class CheckResult:
    check: str
    violations: int
    detail: str = ""


class ValidationError(RuntimeError):
    pass


def _count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def run_checks(
    wh: Warehouse,
    m: Manifest | None = None,
    order_details: DataFrame | None = None,
    raise_on_violation: bool = False,
) -> list[CheckResult]:
    m = m or wh.require()
    fact = wh.table("fact_sales_line", m)
    checks = {}
    for spec in DIMENSIONS:
        checks[f"pk:{spec.table}"] = lambda spec=spec: Q.primary_key_check(
            wh.table(spec.table, m), [spec.sk], spec.table
        ).first()["duplicate_keys"]
    checks["pk:dim_date"] = lambda: Q.primary_key_check(wh.table("dim_date", m), ["date_sk"], "d").first()["duplicate_keys"]
    checks["pk:fact_sales_line"] = lambda: Q.primary_key_check(fact, list(FACT_KEY), "f").first()["duplicate_keys"]
    for spec in (CUSTOMER, PRODUCT):
        checks[f"one_current:{spec.table}"] = lambda spec=spec: _count(Q.check_one_current(wh.table(spec.table, m), spec))
        checks[f"overlap:{spec.table}"] = lambda spec=spec: _count(Q.check_overlap(wh.table(spec.table, m), spec))
        checks[f"interval:{spec.table}"] = lambda spec=spec: _count(Q.check_interval(wh.table(spec.table, m), spec))
    # informative (never a violation): unknown-member references and reconciliation
    checks["info:unknown_audit"] = lambda: Q.unknown_audit(fact).first().asDict()
    if order_details is not None:
        checks["info:reconcile_net"] = lambda: Q.reconcile_net(fact, order_details).first().asDict()

    values = run_parallel(checks)

    results = []
    for name, v in values.items():
        if name.startswith("info:"):
            results.append(CheckResult(name, 0, str(v)))
        else:
            results.append(CheckResult(name, int(v or 0)))
    bad = [r for r in results if r.violations and not r.check.startswith("interval:")]
    if raise_on_violation and bad:
        raise ValidationError("; ".join(f"{r.check}={r.violations}" for r in bad))
    return results
