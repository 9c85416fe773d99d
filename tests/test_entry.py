"""Driver contract: entry() runs, every query has an oracle, and every query
equals its DuckDB oracle at sf0.001 (exact values; floats by repr)."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from starloom.plans.catalog import QUERIES
from starloom.plans.oracle import oracle_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, decimal.Decimal):
                v = format(v.normalize(), "f")
            elif isinstance(v, float):
                v = repr(v + 0.0)
            vals.append(str(v))
        out.append("|".join(vals))
    return sorted(out)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"attribute_value", "lines", "net_sales"}
    assert sum(r.lines for r in rows) == 5942
    assert "Unknown" in {r.attribute_value for r in rows}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert len(QUERIES) >= 58


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    rel = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.collect(), sdf.columns) == _canon(rel.fetchall(), dcols)


def test_fact_invariants_on_built_warehouse(spark):
    from pyspark.sql import functions as F

    from starloom.plans.catalog import built_warehouse

    b = built_warehouse(spark, SF)
    fact = b.wh(spark).table("fact_sales_line", b.incremental)
    per_order = fact.groupBy("order_id").agg(
        F.sum("freight_allocated").alias("alloc"),
        F.max("order_freight").alias("freight"),
        F.sum("net_amount").alias("net"),
        F.count(F.lit(1)).alias("n"),
        F.max("line_number").alias("max_ln"),
        F.countDistinct("line_number").alias("distinct_ln"),
    )
    bad = per_order.where(
        (F.abs(F.col("alloc") - F.when(F.col("net") == 0, 0.0).otherwise(F.col("freight"))) > 1e-6 * F.greatest(F.lit(1.0), F.col("freight")))
        | (F.col("max_ln") != F.col("n"))
        | (F.col("distinct_ln") != F.col("n"))
    )
    assert bad.count() == 0
