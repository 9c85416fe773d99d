import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.keys import assign_surrogate_keys, dense_index


def test_dense_index_equals_global_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(10**6), f"k{rnd.randrange(10**6):07d}") for _ in range(5000)]
    rows = list({r[1]: r for r in rows}.values())  # unique order key
    df = spark.createDataFrame(rows, "v long, k string").repartition(13)
    got, n = dense_index(df, ["k"], start=5, index_col="idx")
    assert n == len(rows)
    want = df.withColumn("idx", F.row_number().over(Window.orderBy("k")) + 4)
    assert sorted(got.select("k", "idx").collect()) == sorted(want.select("k", "idx").collect())


def test_dense_index_multi_column_and_partitions(spark):
    rows = [(o, p) for o in range(50) for p in range(o % 7 + 1)]
    df = spark.createDataFrame(rows, "o long, p long").repartition(5)
    got, n = dense_index(df, ["o", "p"], start=0, index_col="i")
    idx = sorted((r["o"], r["p"], r["i"]) for r in got.collect())
    assert [i for _, _, i in idx] == list(range(n))


def test_dense_index_empty(spark):
    df = spark.createDataFrame([], "k long")
    out, n = dense_index(df, ["k"])
    assert n == 0 and out.count() == 0


def test_assign_surrogate_keys_string_order(spark):
    df = spark.createDataFrame([("10",), ("9",), ("100",), ("1",)], "bk string")
    out, n = assign_surrogate_keys(df, ["bk"], 7, "sk")
    assert n == 4
    assert out.columns[0] == "sk"
    assert [(r.bk, r.sk) for r in out.orderBy("sk").collect()] == [("1", 7), ("10", 8), ("100", 9), ("9", 10)]
