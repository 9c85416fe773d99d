"""Registered queries: one per warehouse operator, over the driver tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame. Queries about
loaded state run the real loads on the scenario of
``starloom.sources.driver_tables`` (run 1: full load of snapshot t0; run 2:
incremental load of t1; run 3: incremental load of t2 with the same effective
date) into a warehouse under the session's checkpoint folder, and read
published parts back. The built warehouse is shared by the queries of one
Spark application; each state is read through the manifest of its run.

Columns are named exactly like the DuckDB oracle in ``starloom.plans.oracle``;
run timestamps are left out of every result.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality as Q
from starloom.operators.changes import source_counts
from starloom.operators.facts import (
    allocate_freight,
    fact_dedup,
    line_measures,
    line_number,
    resolve_dimension_keys,
)
from starloom.operators.keys import assign_surrogate_keys
from starloom.operators.scd import scd1_overwrite, scd2_close, scd2_delta, scd2_delta_keys, scd2_insert
from starloom.operators.staging import (
    stage_customer,
    stage_employee,
    stage_product,
    stage_sales_lines,
    stage_shipper,
)
from starloom.plans.loads import full_load, incremental_load, lines_load, star_dimensions
from starloom.plans.warehouse import CURRENT, HISTORY, Manifest, Warehouse
from starloom.schemas import CUSTOMER, DIMENSIONS, EMPLOYEE, FACT_KEY, PRODUCT, SHIPPER, WATERMARK_ENTITY, DimensionSpec
from starloom.session import scratch_path, session_id
from starloom.sources.driver_tables import (
    RELOCATED,
    RENAME_SUFFIX,
    SHIPPER_NEW_NAME,
    Scenario,
    read_table,
    scenario,
)

RUN_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)  # load timestamp of catalog runs (never in results)


@dataclass
class Built:
    root: str
    scenario: Scenario
    full: Manifest  # run 1: full load of t0
    incremental: Manifest  # run 2: incremental load of t1
    same_day: Manifest  # run 3: incremental load of t2 with t1's effective date

    def wh(self, spark: SparkSession) -> Warehouse:
        return Warehouse(spark, self.root)


_CACHE: dict[tuple, object] = {}
_LOCK = threading.RLock()  # queries may be called from several driver threads


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    return (session_id(spark), sf_dir.rstrip("/"), what)


def get_scenario(spark: SparkSession, sf_dir: str) -> Scenario:
    k = _key(spark, sf_dir, "scenario")
    with _LOCK:
        return _scenario_locked(spark, sf_dir, k)


def _scenario_locked(spark: SparkSession, sf_dir: str, k: tuple) -> Scenario:
    if k not in _CACHE:
        _CACHE[k] = scenario(spark, sf_dir, workdir=scratch_path(spark, "source"))
    return _CACHE[k]  # type: ignore[return-value]


def built_warehouse(spark: SparkSession, sf_dir: str) -> Built:
    """Full load of t0, incremental load of t1, then t2 with the same effective
    date (built once per application; each state is read via its manifest)."""
    k = _key(spark, sf_dir, "warehouse")
    with _LOCK:
        return _built_locked(spark, sf_dir, k)


def _built_locked(spark: SparkSession, sf_dir: str, k: tuple) -> Built:
    if k not in _CACHE:
        sc = get_scenario(spark, sf_dir)
        root = scratch_path(spark, "warehouse")
        m_full = full_load(spark, sc.t0, root, RUN_TS)
        eff = _dt.date.fromisoformat(sc.effective_date_iso)
        m_inc = incremental_load(spark, sc.t1, root, eff, RUN_TS)
        m_same = incremental_load(spark, sc.t2, root, eff, RUN_TS)
        _CACHE[k] = Built(root, sc, m_full, m_inc, m_same)
    return _CACHE[k]  # type: ignore[return-value]


def single_pass_warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, Manifest]:
    """Full load of every driver row in one run."""
    k = _key(spark, sf_dir, "single_pass")
    with _LOCK:
        if k not in _CACHE:
            root = scratch_path(spark, "single-pass")
            _CACHE[k] = (root, full_load(spark, get_scenario(spark, sf_dir).full, root, RUN_TS))
        root, m = _CACHE[k]  # type: ignore[misc]
    return Warehouse(spark, root), m


# --------------------------------------------------------------------- helpers
def _without(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def _fact(wh: Warehouse, m: Manifest) -> DataFrame:
    return _without(wh.table("fact_sales_line", m), "etl_loaded_at")


def _run_log(wh: Warehouse, m: Manifest) -> DataFrame:
    return _without(wh.table("etl_run_log", m), "run_ts")


def _member_rows(df: DataFrame, spec: DimensionSpec, *extra: str) -> DataFrame:
    """Common layout for results that span several dimensions."""
    return df.select(
        F.lit(spec.table).alias("dim_name"),
        F.col(spec.sk).cast("long").alias("sk"),
        F.col(spec.bk).cast("string").alias("bk"),
        *extra,
    )


# ---------------------------------------------------------------- the queries
def q_dim_date(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return wh.table("dim_date", m)


def q_unknown_members(spark, sf_dir):
    """Unknown member of every dimension and how many fact rows use it, per role."""
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    fact = wh.table("fact_sales_line", m)
    roles = [
        ("customer_sk", CUSTOMER.table),
        ("product_sk", PRODUCT.table),
        ("employee_sk", EMPLOYEE.table),
        ("shipper_sk", SHIPPER.table),
        ("order_date_sk", "dim_date"),
        ("required_date_sk", "dim_date"),
        ("shipped_date_sk", "dim_date"),
    ]
    uses = fact.agg(*[F.sum(F.when(F.col(c) == 0, 1).otherwise(0)).cast("long").alias(c) for c, _ in roles])
    members = []
    for spec in (CUSTOMER, PRODUCT, EMPLOYEE, SHIPPER):
        label = "first_name" if spec is EMPLOYEE else ("product_name" if spec is PRODUCT else "company_name")
        members.append(
            wh.table(spec.table, m)
            .where(F.col(spec.sk) == 0)
            .select(F.lit(spec.table).alias("dim_name"), F.col(spec.bk).cast("string").alias("bk"), F.col(label).alias("label"))
        )
    members.append(
        wh.table("dim_date", m)
        .where(F.col("date_sk") == 0)
        .select(F.lit("dim_date").alias("dim_name"), F.col("date").cast("string").alias("bk"), F.col("month_name").alias("label"))
    )
    out = members[0]
    for x in members[1:]:
        out = out.unionByName(x)
    stack = ", ".join(f"'{c}', '{t}', `{c}`" for c, t in roles)
    role_uses = uses.selectExpr(f"stack({len(roles)}, {stack}) AS (role, dim_name, fact_rows)")
    return out.join(role_uses, "dim_name", "left").select("dim_name", "bk", "label", "role", "fact_rows")


def q_record_hash(spark, sf_dir):
    t1 = get_scenario(spark, sf_dir).t1
    parts = [
        stage_customer(t1.customers).select(F.lit("customer").alias("dim_name"), F.col("customer_id").cast("string").alias("bk"), "record_hash"),
        stage_product(t1.products, t1.categories, t1.suppliers).select(
            F.lit("product").alias("dim_name"), F.col("product_id").cast("string").alias("bk"), "record_hash"
        ),
        stage_employee(t1.employees).select(F.lit("employee").alias("dim_name"), F.col("employee_id").cast("string").alias("bk"), "record_hash"),
        stage_shipper(t1.shippers).select(F.lit("shipper").alias("dim_name"), F.col("shipper_id").cast("string").alias("bk"), "record_hash"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_stage_customer(spark, sf_dir):
    return stage_customer(get_scenario(spark, sf_dir).t1.customers)


def q_stage_product(spark, sf_dir):
    t1 = get_scenario(spark, sf_dir).t1
    return stage_product(t1.products, t1.categories, t1.suppliers)


def q_stage_employee(spark, sf_dir):
    return stage_employee(get_scenario(spark, sf_dir).t1.employees)


def q_stage_shipper(spark, sf_dir):
    return stage_shipper(get_scenario(spark, sf_dir).t1.shippers)


def q_surrogate_keys(spark, sf_dir):
    """Dense keys over every order line in (order, product) order."""
    t1 = get_scenario(spark, sf_dir).t1
    lines = t1.order_details.select(F.col("OrderID").alias("order_id"), F.col("ProductID").alias("product_id"))
    numbered, _ = assign_surrogate_keys(lines, ["order_id", "product_id"], 1, "line_key")
    return numbered


def q_sk_sequence(spark, sf_dir):
    """Next key of each dimension, from its table, beside the one recorded by the run."""
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    out = [wh.table(spec.table, m).agg((F.max(spec.sk) + 1).alias("next_sk")).select(F.lit(spec.name).alias("dim_name"), "next_sk") for spec in DIMENSIONS]
    tables = out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
    recorded = wh.sequence_table(m).withColumnRenamed("next_sk", "recorded_next_sk")
    return tables.join(recorded, "dim_name", "full")


def q_scd2_initial_customer(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return wh.table(CUSTOMER.table, m)


def q_scd2_initial_product(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return wh.table(PRODUCT.table, m)


def q_scd2_delta_customer(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    current = b.wh(spark).table(CUSTOMER.table, b.full, part=CURRENT)
    return scd2_delta(stage_customer(b.scenario.t1.customers), current, CUSTOMER)


def q_scd2_delta_product(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    t1 = b.scenario.t1
    current = b.wh(spark).table(PRODUCT.table, b.full, part=CURRENT)
    return scd2_delta(stage_product(t1.products, t1.categories, t1.suppliers), current, PRODUCT)


_SPAN = ("effective_from", "effective_to", "is_current", "record_hash")


def _scd2_inputs(b: Built, spark, spec: DimensionSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(current versions of the full load, staged members of t1, keys that changed)"""
    current = b.wh(spark).table(spec.table, b.full, part=CURRENT)
    t1 = b.scenario.t1
    staged = stage_customer(t1.customers) if spec is CUSTOMER else stage_product(t1.products, t1.categories, t1.suppliers)
    return current, staged, scd2_delta_keys(staged, current, spec)


def q_scd2_close(spark, sf_dir):
    """Versions that the change from t0 to t1 closes."""
    b = built_warehouse(spark, sf_dir)
    eff, out = _dt.date.fromisoformat(b.scenario.effective_date_iso), []
    for spec in (CUSTOMER, PRODUCT):
        current, _, keys = _scd2_inputs(b, spark, spec)
        out.append(_member_rows(scd2_close(current, keys, spec, eff).where("NOT is_current"), spec, *_SPAN))
    return out[0].unionByName(out[1])


def q_scd2_insert(spark, sf_dir):
    """Versions that the change from t0 to t1 opens."""
    b = built_warehouse(spark, sf_dir)
    eff, out = _dt.date.fromisoformat(b.scenario.effective_date_iso), []
    for spec in (CUSTOMER, PRODUCT):
        _, staged, keys = _scd2_inputs(b, spark, spec)
        opened, _ = scd2_insert(staged, keys, spec, eff, b.full.next_sk[spec.name])
        out.append(_member_rows(opened, spec, *_SPAN))
    return out[0].unionByName(out[1])


def q_scd2_apply_customer(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return b.wh(spark).table(CUSTOMER.table, b.incremental)


def q_scd2_apply_product(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return b.wh(spark).table(PRODUCT.table, b.incremental)


def q_scd1_overwrite(spark, sf_dir):
    """Type-1 dimensions after the overwrite step alone (no new members yet)."""
    b = built_warehouse(spark, sf_dir)
    wh, t1 = b.wh(spark), b.scenario.t1
    emp = scd1_overwrite(wh.table(EMPLOYEE.table, b.full), stage_employee(t1.employees), EMPLOYEE)
    shp = scd1_overwrite(wh.table(SHIPPER.table, b.full), stage_shipper(t1.shippers), SHIPPER)
    return _member_rows(emp, EMPLOYEE, "record_hash").unionByName(_member_rows(shp, SHIPPER, "record_hash"))


def q_scd1_insert_new(spark, sf_dir):
    """Members appended to the type-1 dimensions by the incremental run."""
    b = built_warehouse(spark, sf_dir)
    wh = b.wh(spark)
    out = []
    for spec in (EMPLOYEE, SHIPPER):
        before = wh.table(spec.table, b.full).select(spec.bk)
        after = wh.table(spec.table, b.incremental)
        out.append(_member_rows(after.join(before, spec.bk, "left_anti"), spec, "record_hash"))
    return out[0].unionByName(out[1])


def q_scd1_apply_employee(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return b.wh(spark).table(EMPLOYEE.table, b.incremental)


def q_scd1_apply_shipper(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return b.wh(spark).table(SHIPPER.table, b.incremental)


def q_scd1_initial_employee(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return wh.table(EMPLOYEE.table, m)


def q_scd1_initial_shipper(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return wh.table(SHIPPER.table, m)


def q_stage_sales_lines(spark, sf_dir):
    t1 = get_scenario(spark, sf_dir).t1
    return stage_sales_lines(t1.orders, t1.order_details)


def q_incremental_lines(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    t1 = b.scenario.t1
    return stage_sales_lines(t1.orders, t1.order_details, min_order_id_exclusive=b.full.watermark)


def q_resolve_keys(spark, sf_dir):
    """The seven surrogate keys of every line against the full-load dimensions."""
    wh, m = single_pass_warehouse(spark, sf_dir)
    full = get_scenario(spark, sf_dir).full
    r = resolve_dimension_keys(stage_sales_lines(full.orders, full.order_details), star_dimensions(wh, m))
    return r.select(
        "order_id",
        "product_id",
        "customer_sk",
        "product_sk",
        "employee_sk",
        "shipper_sk",
        "order_date_sk",
        "required_date_sk",
        "shipped_date_sk",
    )


def q_date_roles(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    fact = b.wh(spark).table("fact_sales_line", b.incremental)
    return fact.select("order_id", "product_id", "order_date_sk", "required_date_sk", "shipped_date_sk")


def q_line_number(spark, sf_dir):
    t1 = get_scenario(spark, sf_dir).t1
    return line_number(stage_sales_lines(t1.orders, t1.order_details)).select("order_id", "product_id", "line_number")


def q_line_measures(spark, sf_dir):
    t1 = get_scenario(spark, sf_dir).t1
    return line_measures(stage_sales_lines(t1.orders, t1.order_details)).select(
        "order_id", "product_id", "gross_amount", "net_amount"
    )


def q_freight_allocation(spark, sf_dir):
    t1 = get_scenario(spark, sf_dir).t1
    lines = line_measures(stage_sales_lines(t1.orders, t1.order_details))
    return allocate_freight(lines).select(
        "order_id", "product_id", F.col("freight").alias("order_freight"), "freight_allocated"
    )


def q_fact_dedup(spark, sf_dir):
    """All t1 lines (no watermark) minus the keys the full load already holds."""
    b = built_warehouse(spark, sf_dir)
    t1 = b.scenario.t1
    fact = b.wh(spark).table("fact_sales_line", b.full)
    return fact_dedup(stage_sales_lines(t1.orders, t1.order_details), fact).select(*FACT_KEY)


def q_watermark(spark, sf_dir):
    """Newest loaded order, from the fact, beside the watermark recorded by the run."""
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    top = wh.table("fact_sales_line", m).agg(F.max("order_id").alias("last_order_id"))
    recorded = wh.watermark_table(m).select("entity", F.col("last_order_id").alias("recorded_order_id"))
    return recorded.join(top.withColumn("entity", F.lit(WATERMARK_ENTITY)), "entity", "full")


def q_run_log_full(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return _run_log(wh, m)


def q_run_log_incremental(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return _run_log(b.wh(spark), b.incremental)


def q_full_load_fact(spark, sf_dir):
    wh, m = single_pass_warehouse(spark, sf_dir)
    return _fact(wh, m)


def q_incremental_fact(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return _fact(b.wh(spark), b.incremental)


def q_landed_lines_fact(spark, sf_dir):
    """Fact after the new lines of t1 landed in two batches that split orders
    and come in no order: as one incremental load makes it."""
    k = _key(spark, sf_dir, "landed")
    with _LOCK:
        if k not in _CACHE:
            sc, root = get_scenario(spark, sf_dir), scratch_path(spark, "landed")
            eff = _dt.date.fromisoformat(sc.effective_date_iso)
            full = full_load(spark, sc.t0, root, RUN_TS)
            new = sc.t1.order_details.where(F.col("OrderID") > full.watermark)
            for batch, part in enumerate(("ProductID % 3 = 0", "ProductID % 3 > 0")):
                lines_load(spark, sc.t1, root, new.where(part), batch, eff, RUN_TS, dimension_version="t1")
            _CACHE[k] = root
        wh = Warehouse(spark, _CACHE[k])
    return _fact(wh, wh.require())


def q_fact_sales_line(spark, sf_dir):
    """Fact of one full load over every driver row."""
    wh, m = single_pass_warehouse(spark, sf_dir)
    return _fact(wh, m)


def _warehouse_tables(wh: Warehouse, m: Manifest) -> dict[str, DataFrame]:
    return {
        "dw.dim_customer": wh.table(CUSTOMER.table, m),
        "dw.dim_product": wh.table(PRODUCT.table, m),
        "dw.dim_employee": wh.table(EMPLOYEE.table, m),
        "dw.dim_shipper": wh.table(SHIPPER.table, m),
        "dw.dim_date": wh.table("dim_date", m),
        "dw.fact_sales_line": wh.table("fact_sales_line", m),
    }


def q_full_load_rerun(spark, sf_dir):
    """Fact after two full loads into one warehouse, and the runs its log keeps."""
    k = _key(spark, sf_dir, "rerun")
    with _LOCK:
        if k not in _CACHE:
            full = get_scenario(spark, sf_dir).full
            root = scratch_path(spark, "rerun")
            full_load(spark, full, root, RUN_TS)
            _CACHE[k] = (root, full_load(spark, full, root, RUN_TS))
        root, m = _CACHE[k]  # type: ignore[misc]
    wh = Warehouse(spark, root)
    runs = wh.table("etl_run_log", m).agg(F.count(F.lit(1)).cast("int").alias("runs_logged"))
    return _fact(wh, m).join(F.broadcast(runs))  # one row


def q_simulate_changes(spark, sf_dir):
    """Rows of every table after the changes, and what the updates changed."""
    is_ = lambda c: F.sum(F.when(c, 1).otherwise(0))
    changed = {
        "Customers relocated": ("customers", is_(F.col("ContactTitle") == RELOCATED)),
        "Products price sum": ("products", F.sum("UnitPrice")),
        "Employees renamed": ("employees", is_(F.col("FirstName").endswith(RENAME_SUFFIX))),
        "Shippers renamed": ("shippers", is_(F.col("CompanyName") == SHIPPER_NEW_NAME)),
    }
    return source_counts(get_scenario(spark, sf_dir).t1_by_inserts, changed)


def q_pk_check(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    checks = [
        Q.primary_key_check(wh.table(CUSTOMER.table, m), ["customer_sk"], "dw.dim_customer"),
        Q.primary_key_check(wh.table(PRODUCT.table, m), ["product_sk"], "dw.dim_product"),
        Q.primary_key_check(wh.table(EMPLOYEE.table, m), ["employee_sk"], "dw.dim_employee"),
        Q.primary_key_check(wh.table(SHIPPER.table, m), ["shipper_sk"], "dw.dim_shipper"),
        Q.primary_key_check(wh.table("dim_date", m), ["date_sk"], "dw.dim_date"),
        Q.primary_key_check(wh.table("fact_sales_line", m), list(FACT_KEY), "dw.fact_sales_line"),
        Q.primary_key_check(wh.watermark_table(m), ["entity"], "ctl.watermark"),
        Q.primary_key_check(wh.sequence_table(m), ["dim_name"], "ctl.surrogate_key_seq"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def q_pk_check_violations(spark, sf_dir):
    """The key check on keys of the test tables that do repeat."""
    read = lambda name: read_table(spark, sf_dir, name)
    checks = [
        Q.primary_key_check(read("lineitem"), ["l_orderkey", "l_partkey"], "lineitem by order and part"),
        Q.primary_key_check(read("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem by order and line"),
        Q.primary_key_check(read("orders"), ["o_custkey"], "orders by customer"),
        Q.primary_key_check(read("part"), ["p_brand", "p_type"], "part by brand and type"),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2]).unionByName(checks[3])


def _twice(spark, sf_dir, spec: DimensionSpec) -> DataFrame:
    """A dimension in which every third member has a second current version."""
    wh, m = single_pass_warehouse(spark, sf_dir)
    dim = wh.table(spec.table, m)
    again = dim.where(F.col(spec.sk) % 3 == 1).withColumn(spec.sk, F.col(spec.sk) + 1_000_000_000)
    return dim.unionByName(again)


def q_check_one_current_violations(spark, sf_dir):
    out = []
    for spec in (CUSTOMER, PRODUCT):
        found = Q.check_one_current(_twice(spark, sf_dir, spec), spec)
        out.append(found.select(F.lit(spec.table).alias("dim_name"), F.col(spec.bk).cast("string").alias("bk"), "current_rows"))
    return out[0].unionByName(out[1])


def q_check_overlap_violations(spark, sf_dir):
    out = []
    for spec in (CUSTOMER, PRODUCT):
        found = Q.check_overlap(_twice(spark, sf_dir, spec), spec)
        out.append(found.select(F.lit(spec.table).alias("dim_name"), F.col(spec.bk).cast("string").alias("bk")))
    return out[0].unionByName(out[1])


def q_validate_counts(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.row_counts(_warehouse_tables(b.wh(spark), b.incremental))


def q_recent_runs(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.recent_runs(_run_log(b.wh(spark), b.incremental), 10)


def q_check_one_current_customer(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.check_one_current(b.wh(spark).table(CUSTOMER.table, b.incremental), CUSTOMER)


def q_check_one_current_product(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.check_one_current(b.wh(spark).table(PRODUCT.table, b.incremental), PRODUCT)


def q_check_overlap(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.check_overlap(b.wh(spark).table(CUSTOMER.table, b.incremental), CUSTOMER)


def q_check_overlap_product(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.check_overlap(b.wh(spark).table(PRODUCT.table, b.incremental), PRODUCT)


def q_check_interval(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    c = Q.check_interval(wh.table(CUSTOMER.table, m), CUSTOMER)
    p = Q.check_interval(wh.table(PRODUCT.table, m), PRODUCT)
    return _member_rows(c, CUSTOMER, "effective_from", "effective_to").unionByName(
        _member_rows(p, PRODUCT, "effective_from", "effective_to")
    )


def q_scd2_same_day_change(spark, sf_dir):
    """Customer dimension after a second change with the same effective date."""
    b = built_warehouse(spark, sf_dir)
    return b.wh(spark).table(CUSTOMER.table, b.same_day)


def q_check_interval_same_day(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    c = Q.check_interval(b.wh(spark).table(CUSTOMER.table, b.same_day), CUSTOMER)
    return _member_rows(c, CUSTOMER, "effective_from", "effective_to")


def q_check_overlap_same_day(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.check_overlap(b.wh(spark).table(CUSTOMER.table, b.same_day), CUSTOMER)


def q_check_one_current_same_day(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.check_one_current(b.wh(spark).table(CUSTOMER.table, b.same_day), CUSTOMER)


def q_unknown_audit(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.unknown_audit(b.wh(spark).table("fact_sales_line", b.incremental))


def q_reconcile_net(spark, sf_dir):
    b = built_warehouse(spark, sf_dir)
    return Q.reconcile_net(b.wh(spark).table("fact_sales_line", b.incremental), b.scenario.t1.order_details)


def q_star_sales_by_customer_attr(spark, sf_dir):
    """Net sales by customer segment *as it was at sale time*, after the
    full and the incremental load (SK 0 reported as 'Unknown')."""
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    return Q.as_of_star_query(
        wh.table("fact_sales_line", m), wh.table(CUSTOMER.table, m), "customer_sk", "contact_title"
    )


def q_star_sales_by_month_category_segment(spark, sf_dir):
    """Net sales by order month, ship month, product category and customer
    segment, each as it was at sale time."""
    b = built_warehouse(spark, sf_dir)
    wh, m = b.wh(spark), b.incremental
    date = wh.table("dim_date", m)
    axes = [
        Q.Axis("order_date_sk", date, "date_sk", {"order_year": "year", "order_month": "month_name"}),
        Q.Axis("shipped_date_sk", date, "date_sk", {"ship_month": "month_name"}),
        Q.Axis("product_sk", wh.table(PRODUCT.table, m), "product_sk", {"category": "category_name"}, grows=True),
        Q.Axis("customer_sk", wh.table(CUSTOMER.table, m), "customer_sk", {"segment": "contact_title"}, grows=True),
    ]
    return Q.star_query(wh.table("fact_sales_line", m), axes)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_date": q_dim_date,
    "unknown_members": q_unknown_members,
    "record_hash": q_record_hash,
    "stage_customer": q_stage_customer,
    "stage_product": q_stage_product,
    "stage_employee": q_stage_employee,
    "stage_shipper": q_stage_shipper,
    "surrogate_keys": q_surrogate_keys,
    "sk_sequence": q_sk_sequence,
    "scd2_initial_customer": q_scd2_initial_customer,
    "scd2_initial_product": q_scd2_initial_product,
    "scd2_delta_customer": q_scd2_delta_customer,
    "scd2_delta_product": q_scd2_delta_product,
    "scd2_close": q_scd2_close,
    "scd2_insert": q_scd2_insert,
    "scd2_apply_customer": q_scd2_apply_customer,
    "scd2_apply_product": q_scd2_apply_product,
    "scd1_overwrite": q_scd1_overwrite,
    "scd1_insert_new": q_scd1_insert_new,
    "scd1_apply_employee": q_scd1_apply_employee,
    "scd1_apply_shipper": q_scd1_apply_shipper,
    "scd1_initial_employee": q_scd1_initial_employee,
    "scd1_initial_shipper": q_scd1_initial_shipper,
    "stage_sales_lines": q_stage_sales_lines,
    "incremental_lines": q_incremental_lines,
    "resolve_keys": q_resolve_keys,
    "date_roles": q_date_roles,
    "line_number": q_line_number,
    "line_measures": q_line_measures,
    "freight_allocation": q_freight_allocation,
    "fact_dedup": q_fact_dedup,
    "watermark": q_watermark,
    "run_log_full": q_run_log_full,
    "run_log_incremental": q_run_log_incremental,
    "full_load_fact": q_full_load_fact,
    "incremental_fact": q_incremental_fact,
    "landed_lines_fact": q_landed_lines_fact,
    "fact_sales_line": q_fact_sales_line,
    "full_load_rerun": q_full_load_rerun,
    "simulate_changes": q_simulate_changes,
    "pk_check": q_pk_check,
    "pk_check_violations": q_pk_check_violations,
    "check_one_current_violations": q_check_one_current_violations,
    "check_overlap_violations": q_check_overlap_violations,
    "validate_counts": q_validate_counts,
    "recent_runs": q_recent_runs,
    "check_one_current_customer": q_check_one_current_customer,
    "check_one_current_product": q_check_one_current_product,
    "check_overlap": q_check_overlap,
    "check_overlap_product": q_check_overlap_product,
    "check_interval": q_check_interval,
    "scd2_same_day_change": q_scd2_same_day_change,
    "check_interval_same_day": q_check_interval_same_day,
    "check_overlap_same_day": q_check_overlap_same_day,
    "check_one_current_same_day": q_check_one_current_same_day,
    "unknown_audit": q_unknown_audit,
    "reconcile_net": q_reconcile_net,
    "star_sales_by_customer_attr": q_star_sales_by_customer_attr,
    "star_sales_by_month_category_segment": q_star_sales_by_month_category_segment,
}
