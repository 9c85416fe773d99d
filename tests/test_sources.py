import datetime as dt

from starloom.plans.loads import full_load
from starloom.session import scratch_path
from starloom.sources.source import SOURCE_KEYS, Source
from tests.sample_source import base_source

TS = dt.datetime(2024, 1, 1)


def test_catalog_and_parquet_sources_load_the_same(spark):
    src = base_source(spark)
    names = {}
    for t, df in src.tables().items():
        df.createOrReplaceTempView(f"oltp_{t}")
        names[t] = f"oltp_{t}"
    from_catalog = Source.from_catalog(spark, names)
    path = scratch_path(spark, "oltp")
    for t, df in src.tables().items():
        df.write.parquet(f"{path}/{t}")
    from_parquet = Source.from_parquet(spark, path)
    assert set(from_catalog.tables()) == set(SOURCE_KEYS)
    m1 = full_load(spark, from_catalog, scratch_path(spark, "wh-cat"), TS)
    m2 = full_load(spark, from_parquet, scratch_path(spark, "wh-pq"), TS)
    for t in ("dim_customer", "dim_product", "fact_sales_line"):
        assert m1.table_rows(t) == m2.table_rows(t)
    assert m1.watermark == m2.watermark == 43
