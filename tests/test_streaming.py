import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts
from starloom.plans import loads
from starloom.plans.loads import full_load, incremental_load
from starloom.plans.warehouse import Warehouse
from starloom.session import scratch_path
from starloom.streaming.micro_batch import apply_batch, start_incremental_stream
from tests.sample_source import DETAILS, EFF, TS, base_source, changed_source


def rows(wh, m):
    return sorted(map(tuple, wh.table("fact_sales_line", m).drop("etl_loaded_at").collect()))


@pytest.fixture(scope="module")
def batch_load(spark):
    """What one incremental load makes of all new lines."""
    root = scratch_path(spark, "all-at-once")
    base = base_source(spark)
    changed = changed_source(spark, base)
    full_load(spark, base, root, TS)
    m = incremental_load(spark, changed, root, EFF, TS)
    return rows(Warehouse(spark, root), m)


def start(spark, name):
    root = scratch_path(spark, name)
    base = base_source(spark)
    full_load(spark, base, root, TS)
    changed = changed_source(spark, base)
    return root, changed, changed.order_details.where("OrderID > 43")


def test_descending_and_split_orders_give_the_same_fact(spark, batch_load):
    root, changed, new = start(spark, "descending")
    pieces = [new.where("OrderID = 59"), new.where("OrderID = 57 AND ProductID = 77"), new.where("OrderID = 58"), new.where("OrderID = 57 AND ProductID = 10"), new.where("OrderID >= 58")]
    for i, piece in enumerate(pieces):
        m = apply_batch(spark, root, changed, piece, i, EFF, TS, dimension_version="after")
    wh = Warehouse(spark, root)
    assert rows(wh, m) == batch_load
    assert m.rejected_lines == 0 and m.rows["fact_sales_line"] == len(batch_load)
    # dimensions were applied by the first batch only
    assert all(p.split("/runs/")[1].startswith("2-") for p in m.parts["dim_customer#current"])


def test_lines_wait_for_their_header_and_null_keys_are_counted(spark, batch_load):
    root, changed, new = start(spark, "waiting")
    early = changed.with_tables(orders=changed.orders.where("OrderID <> 58"))
    broken = spark.createDataFrame([(None, 10, 1.0, 1, 0.0), (57, None, 1.0, 1, 0.0), (None, None, 1.0, 1, 0.0)], DETAILS)
    m = apply_batch(spark, root, early, new.unionByName(broken), 0, EFF, TS)
    assert m.rows["pending_lines"] == 1 and m.rejected_lines == 3
    m = apply_batch(spark, root, changed, new.limit(0), 1, EFF, TS)
    assert "pending_lines" not in m.rows and m.rejected_lines == 3
    assert rows(Warehouse(spark, root), m) == batch_load


def test_stream_of_landed_files_loads_each_batch_once(spark, batch_load):
    root, changed, new = start(spark, "stream-wh")
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")
    schema = spark.createDataFrame([], DETAILS).schema
    for i, where in enumerate(("OrderID > 57", "OrderID = 57")):
        new.where(where).write.mode("append").parquet(landing)
        start_incremental_stream(spark, root, changed, landing, schema, ckpt, EFF).awaitTermination(300)
        assert Warehouse(spark, root).latest().stream_batch_id == i
    m = Warehouse(spark, root).latest()
    assert rows(Warehouse(spark, root), m) == batch_load
    assert apply_batch(spark, root, changed, new, 1, EFF, TS) is None  # a replayed micro-batch
    assert Warehouse(spark, root).latest().run_id == m.run_id


def test_a_later_load_goes_on_from_landed_lines(spark):
    root, changed, new = start(spark, "mixed")
    apply_batch(spark, root, changed, new.where("OrderID = 59"), 0, EFF, TS)
    m = incremental_load(spark, changed.with_tables(order_details=changed.order_details), root, EFF + dt.timedelta(days=1), TS)
    fact = Warehouse(spark, root).table("fact_sales_line", m)
    assert fact.groupBy("order_id", "product_id").count().where(F.col("count") > 1).count() == 0


def test_landed_lines_are_read_once_and_new_orders_numbered_once(spark, batch_load, monkeypatch):
    root, changed, new = start(spark, "read-once")
    read = spark.sparkContext.accumulator(0)

    def seen(n):
        read.add(1)
        return n

    lines = new.withColumn("Quantity", F.udf(seen, new.schema["Quantity"].dataType)("Quantity"))
    n, renumbered = lines.count(), []
    monkeypatch.setattr(loads, "renumbered", lambda *a: renumbered.append(a) or facts.renumbered(*a))
    read.value = 0
    m = apply_batch(spark, root, changed, lines, 0, EFF, TS)
    assert 0 < read.value <= n and not renumbered
    assert rows(Warehouse(spark, root), m) == batch_load
    again = apply_batch(spark, root, changed, lines, 1, EFF, TS)
    assert rows(Warehouse(spark, root), again) == batch_load and again.rows["fact_sales_line"] == m.rows["fact_sales_line"]
