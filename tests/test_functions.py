import datetime as dt
import hashlib

from pyspark.sql import functions as F

from starloom.functions import date_key, day_name, is_weekend, month_name, record_hash, week_of_year_monday


def test_record_hash_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([("a", None, 3), (None, "x|y", None)], "a string, b string, c int")
    got = [r[0] for r in df.select(record_hash(["a", "b", "c"])).collect()]
    want = [hashlib.md5(t.encode()).hexdigest() for t in ("a||3", "|x|y|")]
    assert got == want


def test_record_hash_null_and_empty_hash_alike(spark):
    df = spark.createDataFrame([("", "k"), (None, "k")], "a string, b string")
    h = [r[0] for r in df.select(record_hash(["a", "b"])).collect()]
    assert h[0] == h[1]


def test_calendar_attributes_match_python_strftime(spark):
    start = dt.date(1995, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(3653)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        "d",
        date_key("d").alias("k"),
        week_of_year_monday("d").alias("w"),
        month_name("d").alias("m"),
        day_name("d").alias("n"),
        is_weekend("d").alias("we"),
    ).collect()
    for r in rows:
        d = r["d"]
        assert r["k"] == int(d.strftime("%Y%m%d"))
        assert r["w"] == int(d.strftime("%W"))
        assert r["m"] == d.strftime("%B")
        assert r["n"] == d.strftime("%A")
        assert r["we"] == (d.strftime("%w") in ("0", "6"))


def test_week_zero_before_first_monday(spark):
    # 2023-01-01 is a Sunday -> week 0; 2023-01-02 is the first Monday -> week 1
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),)], "d date")
    assert [r[0] for r in df.select(week_of_year_monday(F.col("d"))).collect()] == [0, 1]
