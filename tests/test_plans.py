"""Scale properties of the executed plans (regression guards).

Big dimensions are simulated by turning automatic broadcasts off."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality as Q
from starloom.operators.facts import build_fact
from starloom.operators.joins import key_lookup, validity_lookup
from starloom.operators.scd import scd2_apply, scd2_initial
from starloom.operators.staging import stage_customer
from starloom.plans.catalog import built_warehouse
from starloom.plans.loads import full_load, incremental_load, star_dimensions
from starloom.plans.warehouse import CURRENT
from starloom.schemas import CUSTOMER
from starloom.session import list_folder
from starloom.sources.driver_tables import scenario

SF = "/root/testdata/sf0.001"
JOBS = 140
NO_AUTO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def big(spark):
    old = {k: spark.conf.get(k, None) for k in NO_AUTO_BROADCAST}
    for k, v in NO_AUTO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(df) -> str:
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|SinglePartition)", plan)


def test_fact_build_plan_at_scale(spark, big):
    b = built_warehouse(spark, SF)
    dims = star_dimensions(b.wh(spark), b.incremental)
    t1 = b.scenario.t1
    plan = _plan(build_fact(t1.orders, t1.order_details, dims, dt.datetime(2024, 1, 1), b.full.watermark))
    ex = _exchanges(plan)
    assert "SinglePartition" not in ex and "rangepartitioning" not in ex  # the lines were ranged once, before
    assert "Window" not in plan and "lineitem" not in plan
    assert re.search(r"SortMergeJoin \[customer_id", plan) and re.search(r"SortMergeJoin \[product_id", plan)


def test_rows_without_a_key_are_spread(spark, big):
    """A third of the rows have no customer: no task of the join gets them all."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(9000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN CAST(id % 500 AS STRING) END AS customer_id", "DATE '2023-01-01' AS order_date")
        dim = spark.range(500).selectExpr("id + 1 AS customer_sk", "CAST(id AS STRING) AS customer_id", "DATE '2000-01-01' AS effective_from", "DATE '9999-12-31' AS effective_to")
        out = validity_lookup(facts, dim, "customer_id", "customer_id", "order_date", "customer_sk", "sk")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 1.5 * 9000 / 8 and out.where("sk = 0").count() == 3000
        keyed = key_lookup(facts, dim, "customer_id", "customer_id", "customer_sk", "sk")
        assert max(r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()) < 1.5 * 9000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_narrow_rows_are_pinned(spark, wh_root):
    """Initial dimensions and SCD2 changes pin keys and hashes, not members."""
    b = built_warehouse(spark, SF)
    staged = stage_customer(b.scenario.full.customers)
    scd2_initial(staged, CUSTOMER, pins=f"{wh_root}/initial")
    current = b.wh(spark).table(CUSTOMER.table, b.full, part=CURRENT)
    scd2_apply(current, stage_customer(b.scenario.t1.customers), CUSTOMER, dt.date(2000, 1, 1), b.full.next_sk["customer"], pins=f"{wh_root}/change")
    for folder in ("initial", "change"):
        for pin in list_folder(spark, f"{wh_root}/{folder}"):
            assert spark.read.parquet(f"{wh_root}/{folder}/{pin}").columns == ["customer_id", "record_hash", "__place"]


def test_jobs_of_two_loads(spark, wh_root):
    """Jobs as AQE submits them, a stage each; the bench reports the same count."""
    sc = scenario(spark, SF, workdir=f"{wh_root}/src")
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None))
    full_load(spark, sc.t0, f"{wh_root}/wh", dt.datetime(2024, 1, 1))
    incremental_load(spark, sc.t1, f"{wh_root}/wh", dt.date(2000, 1, 1), dt.datetime(2024, 1, 1))
    assert max(tracker.getJobIdsForGroup(None)) - before < JOBS


def test_star_query_pre_aggregates(spark, big):
    b = built_warehouse(spark, SF)
    wh = b.wh(spark)
    plan = _plan(Q.as_of_star_query(wh.table("fact_sales_line", b.incremental), wh.table(CUSTOMER.table, b.incremental), "customer_sk", "contact_title"))
    assert re.search(r"HashAggregate\(keys=\[customer_sk#\d+L\], functions=\[partial_count", plan)
    assert "SinglePartition" not in plan
