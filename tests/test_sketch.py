import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import sketch as S
from starloom.plans.loads import KeyViolation, check_keys, full_load, incremental_load
from starloom.plans.warehouse import FACT_TABLE, Warehouse, sketch_path
from starloom.session import list_folder, scratch_path
from starloom.streaming.micro_batch import apply_batch
from tests.sample_source import EFF, TS, base_source, changed_source


def test_no_key_is_missed_and_few_are_found_by_mistake(spark):
    parts = [(0, 20_000), (20_000, 21_000), (50_000, 50_001)]
    sketches = []
    for lo, hi in parts:
        bits = S.bits_for(hi - lo)
        rows = spark.range(lo, hi, 1, 7).withColumnRenamed("id", "order_id").unionByName(spark.createDataFrame([(None,)], "order_id long"))
        sketches.append((S.build_sketch(rows, "order_id", bits), bits))
    asked = spark.range(0, 60_000, 1, 3).withColumnRenamed("id", "order_id").unionByName(spark.createDataFrame([(None,), (7,), (7,)], "order_id long"))
    got = S.probable_members(asked, "order_id", sketches).groupBy("part").agg(F.count("*").alias("n"), *[F.count_if(F.col("order_id").between(lo, hi - 1)).alias(f"in{i}") for i, (lo, hi) in enumerate(parts)]).collect()
    for r in got:
        lo, hi = parts[r["part"]]
        assert r[f"in{r['part']}"] == hi - lo
        assert r["n"] - (hi - lo) < 0.03 * 60_000
    assert S.build_sketch(spark.createDataFrame([], "order_id long"), "order_id", 4096).count() == 0


def test_sketches_are_built_by_partial_aggregation(spark):
    plan = S.build_sketch(spark.range(100).withColumnRenamed("id", "order_id"), "order_id", 4096)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SinglePartition" not in plan


@pytest.fixture
def loaded(spark):
    """A warehouse whose second fact part has the new orders; the third has a late line's order."""
    root = scratch_path(spark, "sketch")
    base = base_source(spark)
    full_load(spark, base, root, TS)
    changed = changed_source(spark, base)
    m = incremental_load(spark, changed, root, EFF, TS)
    return root, changed, m


def test_lookup_reads_only_parts_whose_sketch_hits(spark, loaded):
    root, changed, m = loaded
    wh = Warehouse(spark, root)
    first, second = m.parts[FACT_TABLE]
    assert all(m.part_stats[p]["sketch_bits"] for p in (first, second))

    def ask(*orders):
        return wh.fact_paths_holding(spark.createDataFrame([(o,) for o in orders], "order_id long"), m)

    assert ask(41) == [first] and ask(58) == [second] and ask(42, 57) == [first, second]
    assert ask(1_000) == [] and ask() == []
    # 44..56 lie between the ranges; 41 and 59 as ends of a batch meet both ranges, the sketch tells
    m.part_stats[second]["min_order_id"] = 1
    assert ask(41) == [first] and ask(43) == [first]
    files = wh.fact(ask(41)).inputFiles()
    assert files and all(first.split("/runs/")[1] in f for f in files)
    plan = wh.fact(ask(41))._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    del m.part_stats[first]["sketch_bits"]  # a part of an earlier version
    assert ask(58) == [first, second]


def test_landed_line_rewrites_only_its_part(spark, loaded):
    root, changed, m = loaded
    first, second = m.parts[FACT_TABLE]
    late = spark.createDataFrame([(42, 10, 3.0, 5, 0.0)], changed.order_details.schema)
    after = apply_batch(spark, root, changed, late, 0, EFF + dt.timedelta(days=1), TS)
    assert second in after.parts[FACT_TABLE] and first not in after.parts[FACT_TABLE]
    wh = Warehouse(spark, root)
    rows = wh.table(FACT_TABLE, after)
    assert rows.count() == wh.table(FACT_TABLE, m).count() + 1
    assert [r[0] for r in rows.where("order_id = 42").orderBy("product_id").select("line_number").collect()] == [1, 2, 3]
    assert all(list_folder(spark, sketch_path(p)) for p in after.parts[FACT_TABLE])


def test_a_key_of_an_older_part_is_refused(spark, loaded):
    root, _, m = loaded
    wh = Warehouse(spark, root)
    first, second = m.parts[FACT_TABLE]
    check_keys(wh, m, second)
    again, n, stats = wh.write_part_observed(9, FACT_TABLE, wh.fact([first]).where("order_id = 41 AND product_id = 20"), tag="again", metrics={"min_order_id": F.min("order_id"), "max_order_id": F.max("order_id")})
    m.parts[FACT_TABLE].append(again)
    m.part_stats[again] = stats
    with pytest.raises(KeyViolation, match="41"):
        check_keys(wh, m, again)
