"""Full load, changes in the source, incremental load - on the invented source
of ``tests.sample_source``."""

import dataclasses
import datetime as dt

import pytest

from starloom.operators import quality as Q
from starloom.plans.loads import full_load, incremental_load
from starloom.plans.validation import run_checks
from starloom.plans.warehouse import Warehouse
from starloom.schemas import CUSTOMER, PRODUCT
from starloom.session import scratch_path
from tests.sample_source import EFF, NEW_ORDERS, OLD_ORDERS, TS, base_source, changed_source, net, share


@pytest.fixture(scope="module")
def loaded(spark):
    root = scratch_path(spark, "scenario")
    src = base_source(spark)
    m1 = full_load(spark, src, root, TS)
    src2 = changed_source(spark, src)
    m2 = incremental_load(spark, src2, root, EFF, TS)
    return root, src, src2, m1, m2


def facts(wh, m):
    return {(r.order_id, r.product_id): r for r in wh.table("fact_sales_line", m).collect()}


def test_full_load(spark, loaded):
    root, _, _, m1, _ = loaded
    assert m1.rows["dim_customer#current"] == 1 + 2 and m1.rows["dim_product#current"] == 1 + 3  # with the unknown member
    assert m1.watermark == max(OLD_ORDERS)
    assert m1.next_sk == {"customer": 3, "product": 4, "employee": 3, "shipper": 3}
    got = facts(Warehouse(spark, root), m1)
    assert set(got) == {(o, p) for o, (_, lines) in OLD_ORDERS.items() for p in lines}
    for (o, p), r in got.items():
        head, lines = OLD_ORDERS[o]
        assert r.line_number == sorted(lines).index(p) + 1
        assert r.net_amount == pytest.approx(net(lines[p])) and r.freight_allocated == pytest.approx(share(OLD_ORDERS, o, p))
        assert r.order_date_sk == int(head[2].replace("-", "")) and r.required_date_sk == int(head[3].replace("-", ""))
        assert r.shipped_date_sk == int((head[4] or "0").replace("-", ""))
    assert got[43, 10].employee_sk == 0 and got[43, 10].shipper_sk == 0  # nobody has these ids


def test_versions_after_the_change(spark, loaded):
    root, _, _, _, m2 = loaded
    wh = Warehouse(spark, root)
    cust = {(r.customer_id, r.is_current): r for r in wh.table("dim_customer", m2).collect()}
    old, new = cust["WHEEL", False], cust["WHEEL", True]
    assert (old.city, old.effective_to) == ("Utrecht", EFF - dt.timedelta(days=1))
    assert (new.city, new.effective_from, new.effective_to) == ("Amersfoort", EFF, dt.date(9999, 12, 31))
    assert cust["PEDAL", True].effective_from == EFF and cust["UNKNOWN", True].customer_sk == 0
    # keys are handed out in business-key order: PEDAL before WHEEL
    assert (cust["PEDAL", True].customer_sk, new.customer_sk) == (3, 4)
    assert m2.next_sk["customer"] == 5 and m2.next_sk["product"] == 6
    log = {r.run_id: r for r in wh.table("etl_run_log", m2).collect()}
    lines = sum(len(x) for _, x in NEW_ORDERS.values())
    assert (log[2].rows_dim_customer, log[2].rows_dim_product, log[2].rows_fact_sales) == (2, 2, lines)
    assert (log[1].run_type, log[2].run_type, log[2].effective_date) == ("FULL", "INCREMENTAL", EFF)


def test_facts_after_the_change(spark, loaded):
    root, _, _, _, m2 = loaded
    wh = Warehouse(spark, root)
    customers = {r.customer_sk: r for r in wh.table("dim_customer", m2).collect()}
    products = {r.product_sk: r for r in wh.table("dim_product", m2).collect()}
    got = facts(wh, m2)
    for o, (_, lines) in NEW_ORDERS.items():
        for p, line in lines.items():
            assert got[o, p].net_amount == pytest.approx(net(line))
            assert got[o, p].freight_allocated == pytest.approx(share(NEW_ORDERS, o, p))
    assert customers[got[57, 10].customer_sk].city == "Amersfoort" and products[got[57, 10].product_sk].list_unit_price == 3.6
    assert customers[got[58, 77].customer_sk].customer_id == "PEDAL" and got[58, 77].shipped_date_sk == 0
    assert got[59, 20].customer_sk == 0  # no version of the customer was valid yet
    assert customers[got[41, 10].customer_sk].city == "Utrecht"  # older facts keep their version
    assert m2.watermark == max(NEW_ORDERS)


def test_validation_suite_passes(spark, loaded):
    root, _, src2, _, m2 = loaded
    wh = Warehouse(spark, root)
    for spec in (CUSTOMER, PRODUCT):
        dim = wh.table(spec.table, m2)
        assert Q.check_one_current(dim, spec).count() == Q.check_overlap(dim, spec).count() == Q.check_interval(dim, spec).count() == 0
    audit = Q.unknown_audit(wh.table("fact_sales_line", m2)).first()
    assert audit.unknown_customer_rows == audit.unknown_employee_rows == audit.unknown_shipper_rows == 1
    assert Q.reconcile_net(wh.table("fact_sales_line", m2), src2.order_details).first().diff == 0


def test_run_checks_summary(spark, loaded):
    root, _, src2, _, m2 = loaded
    res = {r.check: r for r in run_checks(Warehouse(spark, root), m2, src2.order_details, raise_on_violation=True)}
    assert res["pk:fact_sales_line"].violations == 0 and res["overlap:dim_customer"].violations == 0
    assert "dw_net_sales" in res["info:reconcile_net"].detail


def test_rerun_is_idempotent_and_rewrites_no_dimension(spark, loaded):
    root, _, src2, _, m2 = loaded
    m3 = incremental_load(spark, src2, root, EFF, TS)
    assert m3.run_id == 3
    for key in ("fact_sales_line", "dim_customer#current", "dim_product#current", "dim_employee", "dim_shipper", "dim_date"):
        assert m3.parts[key] == m2.parts[key], key
    last = Warehouse(spark, root).table("etl_run_log", m3).where("run_id = 3").first()
    assert (last.rows_dim_customer, last.rows_dim_product, last.rows_fact_sales) == (0, 0, 0)


def test_guarded_insert_is_idempotent(spark):
    src = base_source(spark)
    once = changed_source(spark, src)
    twice = changed_source(spark, once)
    for t in ("customers", "products", "orders", "order_details"):
        assert sorted(map(repr, once.tables()[t].collect())) == sorted(map(repr, twice.tables()[t].collect()))
    assert once.customers.where("CustomerID = 'WHEEL'").first().City == "Amersfoort"


def test_lowered_watermark_dedups_already_loaded_lines(spark):
    root = scratch_path(spark, "dedup")
    src = base_source(spark)
    m1 = full_load(spark, src, root, TS)
    wh = Warehouse(spark, root)
    wh.publish(dataclasses.replace(m1, run_id=2, watermark=41), after=1)  # orders 42 and 43 are above it but loaded
    m3 = incremental_load(spark, changed_source(spark, src), root, EFF, TS)
    got = wh.table("fact_sales_line", m3)
    old, new = (sum(len(x) for _, x in o.values()) for o in (OLD_ORDERS, NEW_ORDERS))
    assert got.count() == old + new == got.select("order_id", "product_id").distinct().count()
    above = sum(len(OLD_ORDERS[o][1]) for o in (42, 43))
    assert wh.table("etl_run_log", m3).where("run_id = 3").first().rows_fact_sales == above + new  # staged, before de-dup
