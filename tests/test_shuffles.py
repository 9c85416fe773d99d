"""What a load shuffles and sends to the driver grows with its rows, and each row is shuffled narrow."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality as Q
from starloom.operators.facts import build_fact, number_within_groups, resolve_dimension_keys
from starloom.operators.joins import hot_keys, key_lookup
from starloom.operators.keys import clustered_index
from starloom.operators.staging import stage_sales_lines
from starloom.plans.catalog import built_warehouse
from starloom.plans.loads import star_dimensions
from tests.test_plans import SF, _plan, big  # noqa: F401


def test_lines_meet_their_order_without_a_shuffle(spark, big):  # noqa: F811
    b = built_warehouse(spark, SF)
    t1 = b.scenario.t1
    plan = _plan(build_fact(t1.orders, t1.order_details, star_dimensions(b.wh(spark), b.incremental), dt.datetime(2024, 1, 1), b.full.watermark))
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+L?[^)]*\)", plan.split("Initial Plan")[0])
    assert len(by_order) == 1 and "Bucketed: true" in plan  # the header's; neither the lines' nor the totals'


def test_measures_are_not_pinned(spark, wh_root):
    b = built_warehouse(spark, SF)
    t1 = b.scenario.t1
    build_fact(t1.orders, t1.order_details, star_dimensions(b.wh(spark), b.incremental), dt.datetime(2024, 1, 1), pins=f"{wh_root}/pins")
    pinned = set(spark.read.parquet(f"{wh_root}/pins/*").columns)
    assert "unit_price" in pinned and not pinned & {"gross_amount", "net_amount"}


def test_places_in_groups(spark, wh_root):
    """Rows in any order and partitioning, a hot group or none, keys that repeat or are null."""
    calm = [(g, o) for g in range(500) for o in range(1 + g % 5)] + [(None, 1), (None, 2), (7, None)]
    for rows in (calm, calm + [(1000, o) for o in range(2000)]):
        df = spark.createDataFrame(rows, "g long, o long").repartition(5)
        assert bool(hot_keys(df, "g")) == (len(rows) > len(calm))
        got = sorted((r.g, -1 if r.o is None else r.o, r.n) for r in number_within_groups(df, "g", "o", "n", pins=f"{wh_root}/p").collect())
        want = []
        for g in sorted({g for g, _ in rows if g is not None}):
            places = sorted(-1 if o is None else o for x, o in rows if x == g)
            want += [(g, o, i + 1) for i, o in enumerate(places)]
        assert got == want


def test_the_pin_leaves_no_table(spark, wh_root):
    tables = {t.name for t in spark.catalog.listTables()}
    df = clustered_index(spark.range(100).selectExpr("id % 10 AS g", "id AS o"), "g", "o", "i", wh_root)
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert df.count() == 100 and df.select("i").distinct().count() == 100


def test_a_lookup_carries_only_the_fact_key_for_spreading(spark, big):  # noqa: F811
    facts = spark.range(100).selectExpr("id AS order_id", "id AS product_id", "id AS employee_id", "uuid() AS note")
    dim = spark.range(50).selectExpr("id AS employee_id", "id + 1 AS employee_sk")
    plan = key_lookup(facts, dim, "employee_id", "employee_id", "employee_sk", "sk").select("order_id", "sk")._jdf.queryExecution().optimizedPlan().toString()
    assert "note" not in plan
    b = built_warehouse(spark, SF)
    t1 = b.scenario.t1
    r = resolve_dimension_keys(stage_sales_lines(t1.orders, t1.order_details), star_dimensions(b.wh(spark), b.incremental))
    assert "AS unit_price" not in r.select("order_id", "product_sk")._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_checked_at_their_width(spark, big):  # noqa: F811
    fact = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3), (None, 3)], "order_id long, product_id long")
    df = Q.duplicate_keys({"fact": fact, "dim": fact.select("product_id")})
    assert {(r.key, r.duplicate_keys, r.example) for r in df.collect()} == {("fact", 2, "(null)|3"), ("dim", 2, "1")}
    assert re.search(r"hashpartitioning\(order_id#\d+L, product_id#\d+L", _plan(df))
    assert Q.duplicate_keys({"fact": fact.where("order_id = 2")}).count() == 0


@pytest.mark.parametrize("grows", [True, False])
def test_star_query_by_several_axes(spark, grows):
    fact = spark.createDataFrame([(1, 1, 0.1), (1, 2, 0.2), (0, 2, 5.0), (2, 1, None), (9, 1, 1.0)], "a_sk long, b_sk long, net_amount double")
    a = spark.createDataFrame([(0, None), (1, "x"), (2, "x")], "a_sk long, name string")
    b = spark.createDataFrame([(1, "p"), (2, "q"), (2, "q")], "b_sk long, name string")  # a key that repeats counts as a join does
    df = Q.star_query(fact, [Q.Axis("a_sk", a, "a_sk", {"a": "name"}, grows), Q.Axis("b_sk", b, "b_sk", {"b": "name"}, grows)])
    assert {(r.a, r.b, r.lines, r.net_sales) for r in df.collect()} == {("x", "p", 2, 0.1), ("x", "q", 2, 0.4), ("Unknown", "q", 2, 10.0), (None, "p", 1, 1.0)}
    assert ("BroadcastHashJoin" in _plan(df).split("Initial Plan")[0]) != grows


def test_a_sketch_takes_each_order_once(spark, wh_root, monkeypatch):
    from starloom.plans import warehouse as W

    seen = []
    build = W.build_sketch
    monkeypatch.setattr(W, "build_sketch", lambda df, key, bits: seen.append((df.count(), df.distinct().count())) or build(df, key, bits))
    b = built_warehouse(spark, SF)
    path = b.full.parts["fact_sales_line"][0]
    lines = spark.read.parquet(path)
    lines.write.parquet(f"{wh_root}/part")
    W.Warehouse(spark, wh_root).write_sketch(f"{wh_root}/part", lines.count())
    orders = lines.select(F.count_distinct("order_id")).first()[0]
    assert seen == [(orders, orders)] and orders < lines.count()
