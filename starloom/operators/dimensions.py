"""Calendar dimension and unknown members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import date_key, day_name, is_weekend, month_name, week_of_year_monday
from starloom.schemas import DATE_PAD_DAYS, DIM_DATE, OPEN_END, OPEN_START, UNKNOWN_DATE, DimensionSpec


def unknown_member(spark: SparkSession, spec: DimensionSpec) -> DataFrame:
    """The SK-0 row of a dimension: the spec's fixed values, full validity for
    SCD2 dimensions, NULL everywhere else (including the hash, so it never
    compares as changed)."""
    values = dict(spec.unknown)
    if spec.kind == "scd2":
        values.update(effective_from=OPEN_START, effective_to=OPEN_END, is_current=True)
    row = tuple(values.get(f.name) for f in spec.schema.fields)
    return spark.createDataFrame([row], spec.schema)


def unknown_date(spark: SparkSession) -> DataFrame:
    row = tuple(UNKNOWN_DATE.get(f.name) for f in DIM_DATE.fields)
    return spark.createDataFrame([row], DIM_DATE)


def calendar_days(orders: DataFrame, date_col: str = "OrderDate", pad_days: int = DATE_PAD_DAYS) -> DataFrame:
    """One row per day from min(date) to max(date) + pad_days, inclusive.

    One global min/max aggregate (partial aggregation, no data shuffle); the
    series size depends on the date span only, never on the row count."""
    bounds = orders.agg(
        F.min(F.to_date(F.col(date_col))).alias("lo"),
        F.max(F.to_date(F.col(date_col))).alias("hi"),
    )
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.date_add(F.col("hi"), pad_days))).alias("date")
    )


def build_dim_date(orders: DataFrame, date_col: str = "OrderDate", pad_days: int = DATE_PAD_DAYS) -> DataFrame:
    """Calendar dimension plus the unknown row (date_sk 0, 1900-01-01).

    Quarter is the calendar quarter (1-4)."""
    d = F.col("date")
    days = calendar_days(orders, date_col, pad_days).select(
        date_key(d).alias("date_sk"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        month_name(d).alias("month_name"),
        day_name(d).alias("day_name"),
        week_of_year_monday(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        is_weekend(d).alias("is_weekend"),
    )
    return unknown_date(orders.sparkSession).unionByName(days)
