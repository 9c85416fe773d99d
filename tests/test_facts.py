import datetime as dt
import math
import random
import sys
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starloom.functions.exact import totals, value
from starloom.operators.facts import allocate_freight, build_fact, fact_dedup, line_measures, line_number, number_within_groups
from starloom.operators.keys import dense_index
from starloom.plans.loads import star_dimensions
from starloom.plans.loads import full_load
from starloom.plans.warehouse import Warehouse
from tests.sample_source import base_source

LINES = "order_id long, product_id long, freight double, quantity long, unit_price double, discount double"


def hot_lines(spark, parts):
    """One order with a third of all lines, of amounts that don't add up exactly in floating point."""
    rows = [(1, p, 77.7, 1 + p % 9, 0.1 + p * 0.37, (p % 7) / 10) for p in range(3000, 0, -1)]
    rows += [(o, p, float(o), p + 1, 3.3, 0.05) for o in range(2, 1502) for p in range(4)]
    return spark.createDataFrame(rows, LINES).repartition(parts)


def test_hot_order_same_bits_for_any_partitioning(spark):
    got = []
    for parts in (3, 29):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            df = allocate_freight(line_measures(line_number(hot_lines(spark, parts))))
            got.append(sorted((r.order_id, r.product_id, r.line_number, r.freight_allocated.hex()) for r in df.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got[0] == got[1]
    assert [n for o, _, n, _ in got[0] if o == 1] == list(range(1, 3001))


def test_no_task_numbers_a_whole_hot_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread, n = dense_index(hot_lines(spark, 8).select("order_id", "product_id"), ["order_id", "product_id"])
        per_task = spread.where("order_id = 1").groupBy(F.shiftright(F.monotonically_increasing_id(), 33)).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert n == 9000 and max(r["count"] for r in per_task) < 3000


def test_fact_build_scans_the_lines_once_and_has_no_window(spark, wh_root):
    src = base_source(spark)
    path = f"{wh_root}/lines"
    src.order_details.write.parquet(path)
    m = full_load(spark, src, f"{wh_root}/wh", dt.datetime(2024, 1, 1))
    lines = spark.read.parquet(path)
    df = build_fact(src.orders, lines, star_dimensions(Warehouse(spark, f"{wh_root}/wh"), m), dt.datetime(2024, 1, 1))
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert path not in plan and "Window" not in plan  # read once, before, when the lines were numbered


def test_number_within_groups_generic(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "g string, o int")
    got = {(r.g, r.o): r.n for r in number_within_groups(df, "g", "o", "n").collect()}
    assert got == {("a", 1): 1, ("a", 3): 2, ("b", 2): 1}
    assert number_within_groups(df.limit(0), "g", "o", "n").count() == 0


def test_freight_shares_sum_to_header_and_zero_net(spark):
    rows = [(1, 1, 18.4, 40, 3.25, 0.0), (1, 2, 18.4, 2, 61.0, 0.15), (2, 1, 9.0, 3, 7.0, 1.0)]
    out = {(r.order_id, r.product_id): r.freight_allocated for r in allocate_freight(line_measures(spark.createDataFrame(rows, LINES))).collect()}
    first, second = 40 * 3.25, 2 * 61.0 * 0.85
    assert out[1, 1] == pytest.approx(18.4 * first / (first + second)) and out[1, 2] == pytest.approx(18.4 * second / (first + second))
    assert out[2, 1] == 0.0


def test_exact_sums(spark):
    """Any finite values, any partitioning: the nearest DOUBLE to the true total."""
    r = random.Random(7)
    edges = [5e-324, 2.0**42, 2.0**-20, 1.7e308, 1e-23, 2.0**60, 2.0**120 - 2.0**67, 1e12, 3e-5, 2.0**-60 + 1.0, 0.0]
    draws = [lambda: r.uniform(-1e6, 1e6), lambda: math.ldexp(r.uniform(-1, 1), r.randint(-1074, 1000)), lambda: math.ldexp(r.uniform(-1, 1), r.randint(-80, 80)), lambda: r.choice((-1, 1)) * r.choice(edges)]
    groups = {g: [r.choice(draws)() for _ in range(r.choice((1, 2, 5, 40)))] for g in range(150)}
    for g in range(0, 150, 3):  # most of it cancels
        groups[g] += [-v for v in groups[g][1:]] + [None]
    groups |= {1000: [None], 1001: [1e-23] * 1000, 1002: [0.1] * 10_000 + [1e12, -1e12, -0.1], 1003: [1.7e308] * 3, 1004: [-1.7e308, 1.0] * 3}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v double")

    def nearest(vs):
        total = sum(map(Fraction, vs))
        return (math.inf if total > 0 else -math.inf) if abs(total) > Fraction(sys.float_info.max) else float(total)

    want = {g: nearest([v for v in vs if v is not None]) if vs != [None] else None for g, vs in groups.items()}
    for parts in (3, 29):
        got = {x.g: x.s for x in totals(df.repartition(parts), ["g"], "v", "s").collect()}
        assert got == want
    assert totals(df.where("g = 1002"), [], "v", "s").first().s == want[1002]
    assert totals(df.limit(0), [], "v", "s").first().s is None
    for odd in (math.nan, math.inf):
        with pytest.raises(Exception, match="amount out of range"):
            totals(spark.createDataFrame([(odd,)], "v double"), [], "v", "s").collect()


def test_exact_sums_of_very_many_rows(spark):
    """Totals as large as 2^40 rows of the largest ordinary amount leave."""
    high, low = 2**102 + 12345, 2**92 + 1
    far = [(-3, 7), (1, -(2**61))]
    held = spark.sql(f"SELECT named_struct('high', {high}BD, 'low', CAST({low}BD AS DECIMAL(38,0)), 'far', f) AS n, named_struct('high', CAST(-{high}BD AS DECIMAL(38,0)), 'low', CAST({low}BD AS DECIMAL(38,0)), 'far', slice(f, 1, 0)) AS m FROM VALUES (array({', '.join(f"named_struct('bin', {b}, 'units', CAST({u} AS DECIMAL(38,0)))" for b, u in far)})) AS t(f)")
    got = held.select(value("n"), value("m")).first()
    near = lambda h: Fraction(h, 2**20) + Fraction(low, 2**72)
    assert got[0] == float(near(high) + sum(u * Fraction(2) ** (60 * b) for b, u in far)) and got[1] == float(near(-high))


def test_fact_dedup_prunes_with_watermark(spark):
    new = spark.createDataFrame([(5, 1), (5, 2), (6, 1)], "order_id long, product_id long")
    fact = spark.createDataFrame([(5, 1), (1, 1)], "order_id long, product_id long")
    got = sorted(tuple(r) for r in fact_dedup(new, fact, min_order_id_exclusive=4).collect())
    assert got == [(5, 2), (6, 1)]
