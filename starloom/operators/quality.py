"""Validation and reporting over the warehouse tables.

Every check is a distributed aggregate or a bounded window; nothing is
collected. Checks return the offending rows (empty = pass) except the
summaries (counts, audit, reconciliation).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.exact import binned, held, part_sums, value
from starloom.schemas import UNKNOWN_SK, DimensionSpec


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` - one global count per table, one job."""
    return _union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, df in tables.items()
        ]
    )


def primary_key_check(df: DataFrame, key: list[str], table_name: str) -> DataFrame:
    """``(table_name, rows, duplicate_keys)``: keys held by more than one row.

    ``groupBy(key).count()`` is partially aggregated map-side, so a hot key
    costs one pre-aggregated row per task, not its raw rows."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)), F.lit(0)).cast("long").alias("duplicate_keys"),
    ).select(F.lit(table_name).alias("table_name"), "rows", "duplicate_keys")


def duplicate_keys(frames: dict[str, DataFrame]) -> DataFrame:
    """``(key, duplicate_keys, example)`` of each named key (a frame of its
    columns) that more than one row holds; no row for a unique one. Keys of one
    column share an aggregation as text; wider ones are grouped by their own
    columns, so rows are shuffled at their width. All partially aggregated map-side."""

    def named(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        return df.select(F.lit(name).alias("key"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in columns]).alias("value"))

    single = [named(df, name, df.columns) for name, df in frames.items() if len(df.columns) == 1]
    wide = {name: df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1") for name, df in frames.items() if len(df.columns) > 1}
    held = [named(df, name, df.columns[:-1]) for name, df in wide.items()]
    if single:
        held.append(_union_all(single).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return _union_all(held).groupBy("key").agg(F.count(F.lit(1)).alias("duplicate_keys"), F.min("value").alias("example"))


def recent_runs(run_log: DataFrame, n: int = 10) -> DataFrame:
    """Top-n runs by id, newest first (a top-k: TakeOrderedAndProject)."""
    return run_log.orderBy(F.desc("run_id")).limit(n)


def check_one_current(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Business keys whose number of current versions is not exactly one
    (the unknown member excluded)."""
    return (
        dim.where(F.col("is_current") & (F.col(spec.sk) != UNKNOWN_SK))
        .groupBy(spec.bk)
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .where(F.col("current_rows") != 1)
    )


def check_overlap(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Business keys with two versions whose validity ranges overlap:
    ``a.from <= b.to AND b.from <= a.to`` for some a != b (SK 0 excluded).

    Exact, without pairing versions. In ``from`` order a valid version b
    overlaps an earlier one iff the running max of earlier ``to`` reaches
    b.from. An inverted version b (to < from, left by two changes with the same
    effective date) overlaps a iff a.from <= b.to and a.to >= b.from; that is a
    lookup of the running max at position b.to, done by a probe row sorted in
    among the real ones. One window per business key: its size is the number
    of versions of that key, which grows by at most one per load run (source
    business keys are unique), never with the data volume.
    """
    base = dim.where(F.col(spec.sk) != UNKNOWN_SK).select(
        F.col(spec.bk).alias("bk"),
        F.col(spec.sk).alias("sk"),
        F.col("effective_from").alias("f"),
        F.col("effective_to").alias("t"),
    )
    real = base.select("bk", F.col("f").alias("pos"), F.lit(0).alias("kind"), "sk", "t", "f")
    probes = base.where(F.col("t") < F.col("f")).select(
        "bk", F.col("t").alias("pos"), F.lit(1).alias("kind"), "sk", F.lit(None).cast("date").alias("t"), "f"
    )
    w = Window.partitionBy("bk").orderBy("pos", "kind", "sk").rowsBetween(Window.unboundedPreceding, -1)
    scanned = real.unionByName(probes).withColumn("prev_max_to", F.max("t").over(w))
    valid_hit = (F.col("kind") == 0) & (F.col("t") >= F.col("f")) & (F.col("prev_max_to") >= F.col("f"))
    probe_hit = (F.col("kind") == 1) & (F.col("prev_max_to") >= F.col("f"))
    return scanned.where(valid_hit | probe_hit).select(F.col("bk").alias(spec.bk)).distinct()


def check_interval(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Versions that end before they start (two changes, same effective date)."""
    return dim.where(F.col("effective_from") > F.col("effective_to")).select(
        spec.bk, spec.sk, "effective_from", "effective_to"
    )


_AUDITED = [
    ("customer_sk", "unknown_customer_rows"),
    ("product_sk", "unknown_product_rows"),
    ("employee_sk", "unknown_employee_rows"),
    ("shipper_sk", "unknown_shipper_rows"),
    ("order_date_sk", "unknown_order_date_rows"),
]


def unknown_audit(fact: DataFrame) -> DataFrame:
    """Fact rows pointing at the unknown member, per foreign key (NULL sums
    on an empty fact, like SQL)."""
    return fact.agg(
        *[F.sum(F.when(F.col(c) == UNKNOWN_SK, 1).otherwise(0)).cast("long").alias(a) for c, a in _AUDITED]
    )


def reconcile_net(fact: DataFrame, order_details: DataFrame) -> DataFrame:
    """Warehouse net sales vs. net computed straight from the source lines
    (lines are not joined to headers, so orphan lines show as a difference).

    Both totals are exact sums (:mod:`starloom.functions.exact`) from one
    aggregate over the union of the two inputs; the difference is taken before
    either is rounded to a DOUBLE."""
    src_net = (
        F.col("Quantity").cast("double") * F.col("UnitPrice").cast("double") * (F.lit(1) - F.col("Discount").cast("double"))
    )
    both = fact.select(F.lit(True).alias("__dw"), F.col("net_amount").alias("__net")).unionByName(
        order_details.select(F.lit(False).alias("__dw"), src_net.alias("__net"))
    )
    parts = binned(both, "__dw", "__net").groupBy("__dw", "__bin").agg(*part_sums())
    sums = parts.agg(held("dw", plus="__dw"), held("src", plus="NOT __dw"), held("d", plus="__dw", minus="NOT __dw"))
    out = sums.select(value("dw").alias("dw_net_sales"), value("src").alias("oltp_net_sales"), value("d").alias("diff"))
    return out.withColumn("diff", F.expr("CASE WHEN dw_net_sales IS NOT NULL AND oltp_net_sales IS NOT NULL THEN diff END"))


def as_of_star_query(
    fact: DataFrame,
    dim: DataFrame,
    sk: str,
    attribute: str,
    measure: str = "net_amount",
    label: str = "attribute_value",
    unknown_label: str = "Unknown",
) -> DataFrame:
    """Sales by the dimension attribute *valid at sale time*.

    Facts carry the SK of the version valid on their date, so joining on the
    SK (not the business key) attributes each sale to the value it had then.
    The fact is pre-aggregated per SK first (partial aggregation map-side):
    the join then sees one row per version, so neither a hot member nor the
    unknown member can skew it; the final regroup is by attribute value.
    """
    per_sk = binned(fact, sk, measure).groupBy(sk, "__bin").agg(F.sum("__once").alias("lines"), *part_sums())
    d = dim.select(F.col(sk).alias("__sk"), F.col(attribute).alias("__attr"))
    j = per_sk.join(d, per_sk[sk] == d["__sk"], "left")
    named = F.when(F.col(sk) == UNKNOWN_SK, F.lit(unknown_label)).otherwise(F.col("__attr"))
    parts = j.groupBy(named.alias(label), "__bin").agg(F.sum("lines").alias("lines"), *part_sums())
    out = parts.groupBy(label).agg(F.sum("lines").cast("long").alias("lines"), held())
    return out.select(label, "lines", value().alias("net_sales"))


@dataclass(frozen=True)
class Axis:
    """One axis of a star query: the fact's key column, the dimension, its key
    column, and the attributes (output name -> dimension column) to group by.
    ``grows``: the dimension has more members with more data, so it is joined by
    a shuffle: its files' size, which decides on broadcasts, is far below what its
    rows take on the driver."""

    fact_sk: str
    dim: DataFrame
    dim_sk: str
    attributes: dict[str, str]
    grows: bool = False


def star_query(fact: DataFrame, axes: list[Axis], measure: str = "net_amount", unknown_label: str = "Unknown") -> DataFrame:
    """Lines and net sales by attributes of several dimensions, each as it was
    at sale time; a dimension may take part in several roles (order month and
    ship month). Rows of a few keys and the measure are joined to the dimensions
    one after another and grouped once, by the attributes: combinations of the
    keys of several dimensions are nearly as many as the rows, so grouping by
    them first would only shuffle wider rows. SK 0 is reported as ``unknown_label``."""
    out = fact.select(*dict.fromkeys(a.fact_sk for a in axes), measure)
    done: list[str] = []
    for i, axis in enumerate(axes):
        left = list(dict.fromkeys(a.fact_sk for a in axes[i + 1 :]))
        d = axis.dim.select(F.col(axis.dim_sk).alias("__sk"), *[F.col(c).cast("string").alias(f"__a_{n}") for n, c in axis.attributes.items()])
        j = out.join(d.hint("merge") if axis.grows else d, F.col(axis.fact_sk) == F.col("__sk"), "left")
        named = [F.when(F.col(axis.fact_sk) == UNKNOWN_SK, F.lit(unknown_label)).otherwise(F.col(f"__a_{n}")).alias(n) for n in axis.attributes]
        out = j.select(*done, *left, *named, measure)
        done += axis.attributes
    parts = binned(out, *done, measure).groupBy(*done, "__bin").agg(F.sum("__once").alias("lines"), *part_sums())
    out = parts.groupBy(*done).agg(F.sum("lines").cast("long").alias("lines"), held())
    return out.select(*done, "lines", value().alias("net_sales"))
