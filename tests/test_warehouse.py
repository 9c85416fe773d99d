import datetime as dt

import pytest

from pyspark.sql import functions as F

from starloom.plans.loads import KeyViolation, full_load, incremental_load, init_warehouse
from starloom.plans.warehouse import MAX_PARTS, ConcurrentRunError, Manifest, Warehouse, sketch_path
from starloom.session import create_small_file, list_folder, temporary_folder
from starloom.sources.driver_tables import scenario
from tests.sample_source import DETAILS, EFF, OLD_ORDERS, ORDERS, base_source, changed_source

TS = dt.datetime(2024, 1, 1)


def test_init_is_idempotent_and_tables_empty(spark, wh_root):
    m = init_warehouse(spark, wh_root)
    assert m.run_id == 0
    assert init_warehouse(spark, wh_root).run_id == 0
    wh = Warehouse(spark, wh_root)
    for t in ("dim_customer", "fact_sales_line", "etl_run_log", "dim_date"):
        assert wh.table(t).count() == 0
    assert wh.watermark_table().count() == 0
    with pytest.raises(RuntimeError):
        incremental_load(spark, base_source(spark), wh_root, dt.date(2000, 1, 1), TS)


def test_unpublished_run_is_invisible(spark, wh_root):
    src = base_source(spark)
    m1 = full_load(spark, src, wh_root, TS)
    wh = Warehouse(spark, wh_root)
    # a run that wrote parts but died before publishing its manifest
    wh.write_part(m1.run_id + 1, "fact_sales_line", wh.table("fact_sales_line", m1).limit(1))
    assert wh.latest().run_id == m1.run_id
    assert wh.table("fact_sales_line").count() == m1.table_rows("fact_sales_line")


def test_full_load_rerun_resets_but_keeps_log(spark, wh_root):
    src = base_source(spark)
    m1 = full_load(spark, src, wh_root, TS)
    m2 = full_load(spark, src, wh_root, TS)
    wh = Warehouse(spark, wh_root)
    assert m2.run_id == m1.run_id + 1
    assert wh.table("fact_sales_line", m2).count() == wh.table("fact_sales_line", m1).count()
    assert sorted(r.run_id for r in wh.table("etl_run_log", m2).collect()) == [1, 2]
    assert wh.manifest(1).run_id == 1  # time travel


def test_empty_full_load_leaves_null_watermark(spark, wh_root):
    src = base_source(spark)
    empty = src.with_tables(orders=src.orders.limit(0), order_details=src.order_details.limit(0))
    m1 = full_load(spark, empty, wh_root, TS)
    assert m1.watermark is None and m1.table_rows("fact_sales_line") == 0
    m2 = incremental_load(spark, src, wh_root, EFF, TS)
    assert m2.watermark is None and m2.table_rows("fact_sales_line") == 0


def test_manifest_round_trip():
    m = Manifest(run_id=3, run_type="FULL", next_sk={"a": 1}, parts={"x": ["p"]}, rows={"x": 2})
    assert Manifest.from_json(m.to_json()) == m


def test_driver_scenario_expectations_sf0001(spark, wh_root):
    sc = scenario(spark, "/root/testdata/sf0.001")
    m1 = full_load(spark, sc.t0, wh_root, TS)
    m2 = incremental_load(spark, sc.t1, wh_root, dt.date(2000, 1, 1), TS)
    assert m1.watermark == 1199 and m1.table_rows("fact_sales_line") == 4776
    assert m2.table_rows("fact_sales_line") - m1.table_rows("fact_sales_line") == 1166
    log = Warehouse(spark, wh_root).table("etl_run_log", m2).where("run_id = 2").first()
    assert (log.rows_dim_customer, log.rows_dim_product) == (35, 38)


def test_fact_parts_pruned_by_recorded_order_range(spark, wh_root):
    src = base_source(spark)
    m1 = full_load(spark, src, wh_root, TS)
    wh = Warehouse(spark, wh_root)
    (path,) = m1.parts["fact_sales_line"]
    assert m1.part_stats[path] == {"min_order_id": min(OLD_ORDERS), "max_order_id": max(OLD_ORDERS), "sketch_bits": 4096}
    assert wh.fact_paths_above(m1.watermark, m1) == []  # nothing can collide: no de-dup scan
    assert wh.fact(wh.fact_paths_above(min(OLD_ORDERS), m1)).count() == m1.table_rows("fact_sales_line")


def test_overlapping_runs_one_fails_cleanly(spark, wh_root):
    src = base_source(spark)
    m1 = full_load(spark, src, wh_root, TS)
    wh = Warehouse(spark, wh_root)
    # another writer publishes run 2 while "our" run 2 (started from run 1) is still going
    Warehouse(spark, wh_root).publish(Manifest(**{**m1.__dict__, "run_id": 2}), after=1)
    with pytest.raises(ConcurrentRunError):
        wh.publish(Manifest(**{**m1.__dict__, "run_id": 2}), after=1)
    # a fresh run starts from the winner and succeeds; attempts never share folders
    m3 = incremental_load(spark, changed_source(spark, src), wh_root, EFF, TS)
    assert m3.run_id == 3
    assert all(p.split("/runs/")[1].split("/")[0].startswith(("1-", "3-")) for v in m3.parts.values() for p in v)


def test_first_run_race_is_refused(spark, wh_root):
    one, two = Warehouse(spark, wh_root), Warehouse(spark, wh_root)
    one.publish(Manifest(run_id=1, run_type="FULL", watermark=5), after=None)
    with pytest.raises(ConcurrentRunError):
        two.publish(Manifest(run_id=1, run_type="FULL", watermark=6), after=None)
    assert one.latest().watermark == 5
    assert not create_small_file(spark, f"{wh_root}/_manifests/1.json", "{}")  # also when both pass the first look


def test_only_a_missing_folder_means_no_warehouse(spark, wh_root):
    assert Warehouse(spark, wh_root).latest() is None
    with pytest.raises(Exception, match="No FileSystem|UnsupportedFileSystem"):
        Warehouse(spark, "nosuchscheme://x/y").latest()


def _doubled(src, table, where):
    t = src.tables()[table]
    return src.with_tables(**{table: t.unionByName(t.where(where))})


BROKEN = [("customers", "CustomerID = 'WHEEL'"), ("products", "ProductID = 10"), ("employees", "EmployeeID = 7"), ("orders", "OrderID = 42"), ("order_details", "OrderID = 42 AND ProductID = 20")]


@pytest.mark.parametrize("table,where", BROKEN)
def test_full_load_with_a_repeated_key_publishes_nothing(spark, wh_root, table, where):
    with pytest.raises(KeyViolation):
        full_load(spark, _doubled(base_source(spark), table, where), wh_root, TS)
    assert Warehouse(spark, wh_root).latest() is None
    assert list_folder(spark, f"{wh_root}/runs") == []  # nothing is left of the attempt


def test_incremental_load_with_a_repeated_key_publishes_nothing(spark, wh_root):
    src = base_source(spark)
    m1 = full_load(spark, src, wh_root, TS)
    changed = changed_source(spark, src)
    for table, where in (("customers", "CustomerID = 'PEDAL'"), ("products", "ProductID = 10"), ("order_details", "OrderID = 57 AND ProductID = 77"), ("orders", "OrderID = 58")):
        with pytest.raises(KeyViolation):
            incremental_load(spark, _doubled(changed, table, where), wh_root, EFF, TS)
    assert Warehouse(spark, wh_root).latest() == m1
    assert incremental_load(spark, changed, wh_root, EFF, TS).run_id == 2


def test_a_run_leaves_its_parts_only(spark, wh_root):
    m = full_load(spark, base_source(spark), wh_root, TS)
    (folder,) = list_folder(spark, f"{wh_root}/runs")
    assert folder.startswith("1-")
    parts = [p for v in m.parts.values() for p in v] + [sketch_path(p) for p in m.parts["fact_sales_line"]]
    assert sorted(list_folder(spark, f"{wh_root}/runs/{folder}")) == sorted(p.rsplit("/", 1)[1] for p in parts)


def test_state_stays_bounded_over_many_runs(spark, wh_root):
    src = base_source(spark)
    m = full_load(spark, src, wh_root, TS)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        sizes = []
        for i in range(50):
            city = F.when(F.col("CustomerID") == "CHAIN", F.lit(f"Town {i}")).otherwise(F.col("City"))
            orders = spark.createDataFrame([(100 + i, "CHAIN", 7, dt.datetime(2023, 5, 1), None, None, 31, 1.0)], ORDERS)
            lines = spark.createDataFrame([(100 + i, 10, 2.0, 1, 0.0)], DETAILS)
            now = src.with_tables(customers=src.customers.withColumn("City", city), orders=orders, order_details=lines)
            m = incremental_load(spark, now, wh_root, EFF + dt.timedelta(days=i), TS)
            sizes.append((max(len(p) for p in m.parts.values()), len(m.to_json())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert max(n for n, _ in sizes) <= MAX_PARTS + 1
    assert max(b for _, b in sizes[25:]) <= 1.05 * max(b for _, b in sizes[:25])
    wh = Warehouse(spark, wh_root)
    assert wh.table("fact_sales_line", m).count() == m.rows["fact_sales_line"] == 6 + 50
    assert wh.table("etl_run_log", m).count() == 51
    assert wh.table("dim_customer", m, part="history").count() == m.rows["dim_customer#history"] == 50
    assert sum(m.part_rows[p] for p in m.parts["fact_sales_line"]) == 56


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        temporary_folder("spark://head:7077")
    with pytest.raises(RuntimeError):
        temporary_folder("local-cluster[2,1,1024]")
    assert temporary_folder("local[4]") != temporary_folder("local")
