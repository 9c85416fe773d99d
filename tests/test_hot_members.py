"""As-of lookups where one member holds a third of all rows, without broadcasts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.facts import resolve_dimension_keys
from starloom.operators.joins import HotMembers, hot_members, may_broadcast, validity_lookup
from starloom.operators.staging import stage_sales_lines
from starloom.plans.catalog import built_warehouse
from starloom.plans.loads import star_dimensions
from tests.test_plans import SF, big  # noqa: F401

DIM = "sk long, k string, a date, b date"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def versions(spark):
    """Every member has versions of ten days; the first and last are open, one is inverted, one has no start."""
    rows = [(1000 * k + v, f"m{k}", day(10 * v) if v else dt.date(1900, 1, 1), day(10 * v + 9) if v < 39 else dt.date(9999, 12, 31)) for k in range(9) for v in range(40)]
    return spark.createDataFrame([*rows, (99_001, "m0", day(30), day(20)), (99_002, "m0", None, day(5)), (99_003, "m8", day(3), None)], DIM)


def facts(spark, n=30_000):
    """A third of the rows on m0, a tenth without a key, some without a date, some of no known member."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 'm0' WHEN id % 10 = 1 THEN NULL WHEN id % 97 = 2 THEN 'none' ELSE concat('m', id % 9) END")
    at = F.expr("CASE WHEN id % 101 = 5 THEN NULL ELSE date_add(DATE '2019-12-01', cast(id * 7 % 500 AS int)) END")
    return spark.range(0, n, 1, 5).select("id", key.alias("key"), at.alias("day"))


def lookup(f, d, hot):
    return validity_lookup(f, d, "key", "k", "day", "sk", "out", "a", "b", hot=hot)


def test_hot_members_are_found(spark):
    f = facts(spark)
    hot = hot_members(f, "key", f, "day", share=5)
    assert hot == HotMembers(("m0",), dt.date(2019, 12, 1), dt.date(2021, 4, 13))
    assert hot_members(f.where("key IS NULL"), "key", f, "day") is None
    assert hot_members(f.limit(0), "key", f, "day") is None
    assert hot_members(f.where("key <> 'm0'"), "key", f, "day", share=5) is None


def test_results_do_not_change(spark, big):  # noqa: F811
    f, d = facts(spark), versions(spark)
    plain = sorted(map(tuple, lookup(f, d, None).collect()), key=repr)
    assert len(plain) == 30_000 and sum(r[3] > 0 for r in plain) > 20_000
    for keys, first, last in ((("m0",), day(-31), day(470)), (("m0", "m8", "none"), day(100), day(120)), (tuple(f"m{i}" for i in range(9)), day(5), day(5))):
        assert sorted(map(tuple, lookup(f, d, HotMembers(keys, first, last)).collect()), key=repr) == plain


def test_a_third_of_all_rows_spreads_over_all_tasks(spark, big):  # noqa: F811
    f, d = facts(spark), versions(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def sizes(hot):
            out = lookup(f, d, hot)
            assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
            return [r["count"] for r in out.where("key = 'm0'").groupBy(F.spark_partition_id()).count().collect()]

        assert sizes(None) == [10_000]
        spread = sizes(hot_members(f, "key", f, "day", share=5))
        assert len(spread) == 8 and max(spread) < 1.5 * 10_000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def star(spark):
    b = built_warehouse(spark, SF)
    return star_dimensions(b.wh(spark), b.incremental), stage_sales_lines(b.scenario.t1.orders, b.scenario.t1.order_details)


def test_resolved_keys_without_broadcasts(spark, star, request):
    dims, lines = star
    assert may_broadcast(dims.customer) and may_broadcast(dims.product)
    # every third order is one customer's
    lines = lines.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, lines.select(F.min("customer_id")).first()[0]).otherwise(F.col("customer_id")))
    plain = resolve_dimension_keys(lines, dims).collect()
    request.getfixturevalue("big")
    assert not may_broadcast(dims.customer)
    out = resolve_dimension_keys(lines, dims)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, out.collect())) == sorted(map(repr, plain))
