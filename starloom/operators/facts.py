"""Order-line fact: key resolution, line numbers, measures, freight allocation.

Plan shape of :func:`build_fact` (the hot path of every load), the same for
every order whatever its number of lines:

* dimension lookups whose inputs live on the order header (customer as of the
  order date, shipper, employee, date roles) run on the header - one row per
  order instead of one per line;
* new lines are anti-joined against already-loaded keys *before* numbering;
* the (narrow) lines are sorted by ``(order_id, product_id)`` and indexed once,
  in a pin bucketed by order: the lines are not shuffled again for the order's
  totals or its header. Where one order holds a large share of all lines, they
  get a dense index over ranges instead, so that order spans many tasks. An
  order's first index and its net total come from partial aggregation; the total
  is an exact sum of whole numbers (:mod:`starloom.functions.exact`), so it
  depends neither on partitioning nor on order. A line's number is its index
  minus the order's first one;
* lines meet their order (header, first index, total) in one join on
  ``order_id``; after ranges, AQE splits it where an order is large;
* the product as-of lookup follows, and what is computed from a line's own
  columns (measures, freight share) only after it, so no shuffle carries it.

Where a type-2 dimension is too large for a broadcast, members that a large share
of the rows refers to are looked up by time bucket and salt
(:mod:`starloom.operators.joins`).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.exact import binned, held, part_sums, totals, value
from starloom.operators.joins import HotMembers, hot_keys, hot_members, key_lookup, may_broadcast, validity_lookup
from starloom.operators.keys import clustered_index, dense_index
from starloom.operators.staging import stage_order_header, stage_order_lines
from starloom.schemas import FACT_KEY, FACT_SALES_LINE, OPEN_START, project_to


@dataclass
class StarDimensions:
    """Dimension frames the fact resolves against."""

    customer: DataFrame
    product: DataFrame
    employee: DataFrame
    shipper: DataFrame
    date: DataFrame


# (output column, required input columns)
_STEPS = [
    ("customer_sk", ("customer_id", "order_date")),
    ("employee_sk", ("employee_id",)),
    ("shipper_sk", ("ship_via",)),
    ("order_date_sk", ("order_date",)),
    ("required_date_sk", ("required_date",)),
    ("shipped_date_sk", ("shipped_date",)),
    ("product_sk", ("product_id", "order_date")),
]


def hot_of(dims: StarDimensions, header: DataFrame, lines: DataFrame) -> dict[str, HotMembers | None]:
    """Hot customers of the orders and hot products of the lines, looked for
    where the dimension can't be broadcast (no job otherwise)."""
    out = {}
    if not may_broadcast(dims.customer):
        out["customer_sk"] = hot_members(header, "customer_id", header, "order_date")
    if not may_broadcast(dims.product):
        out["product_sk"] = hot_members(lines, "product_id", header, "order_date")
    return out


def _resolve_one(df: DataFrame, out: str, dims: StarDimensions, hot: HotMembers | None = None) -> DataFrame:
    if out == "customer_sk":
        return validity_lookup(df, dims.customer, "customer_id", "customer_id", "order_date", "customer_sk", out, hot=hot)
    if out == "product_sk":
        return validity_lookup(df, dims.product, "product_id", "product_id", "order_date", "product_sk", out, hot=hot)
    if out == "employee_sk":
        return key_lookup(df, dims.employee, "employee_id", "employee_id", "employee_sk", out)
    if out == "shipper_sk":
        return key_lookup(df, dims.shipper, "ship_via", "shipper_id", "shipper_sk", out)
    date_col = out[: -len("_sk")]
    key = F.col(date_col)
    if date_col == "shipped_date":  # not shipped yet -> the unknown date row
        key = F.coalesce(key, F.lit(OPEN_START))
    return key_lookup(df, dims.date, key, "date", "date_sk", out, cast="int")


def resolve_available_keys(
    df: DataFrame, dims: StarDimensions, skip: tuple[str, ...] = (), hot: dict[str, HotMembers | None] | None = None
) -> DataFrame:
    """Resolve every surrogate key whose inputs are present on ``df``."""
    for out, needs in _STEPS:
        if out in skip or out in df.columns or not all(c in df.columns for c in needs):
            continue
        df = _resolve_one(df, out, dims, (hot or {}).get(out))
    return df


def resolve_dimension_keys(staged_lines: DataFrame, dims: StarDimensions) -> DataFrame:
    """All seven surrogate keys of a staged sales line; 0 where nothing matches."""
    return resolve_available_keys(staged_lines, dims, hot=hot_of(dims, staged_lines, staged_lines))


def line_measures(df: DataFrame) -> DataFrame:
    """gross = quantity x unit price; net = gross x (1 - discount)."""
    gross = F.col("quantity") * F.col("unit_price")
    return df.withColumns(
        {"gross_amount": gross, "net_amount": gross * (F.lit(1) - F.col("discount"))}
    )


def _freight_share(freight, net, order_net):
    """Header freight split by the line's share of the order's net value;
    0 on every line of an order whose net total is 0."""
    return F.when(order_net == 0, F.lit(0.0)).otherwise(freight * (net / order_net))


def _indexed(df: DataFrame, group_col: str, order_col: str, pins: str | None) -> DataFrame:
    """Rows of ``df`` that have a group, with ``__idx``, which grows by one from
    row to row of a group: in buckets by group, or dense over ranges that split a hot one."""
    df = df.where(F.col(group_col).isNotNull())  # the joins on the group drop the others
    if hot_keys(df, group_col):
        return dense_index(df, [group_col, order_col], start=0, index_col="__idx", pins=pins)[0]
    return clustered_index(df, group_col, order_col, index_col="__idx", pins=pins)


def _group_stats(indexed: DataFrame, group_col: str, total_of: str | None) -> DataFrame:
    """Per group the first ``__idx`` and, for ``total_of``, ``__total``: what
    its exact sum is read from."""
    first = F.min("__idx").alias("__first")
    if not total_of:
        return indexed.groupBy(group_col).agg(first)
    parts = binned(indexed, group_col, "__idx", total_of).groupBy(group_col, "__bin").agg(first, *part_sums())
    return parts.groupBy(group_col).agg(F.min("__first").alias("__first"), held("__total"))


def number_within_groups(
    df: DataFrame,
    group_col: str,
    order_col: str,
    out_col: str,
    total: tuple[str, str] | None = None,
    pins: str | None = None,
) -> DataFrame:
    """1-based position of each row inside its group in ``order_col`` order
    (``row_number() OVER (PARTITION BY group ORDER BY order)``) and, with
    ``total=(col, out)``, the group's exact sum of ``col``. No task holds a
    whole hot group: see :func:`_indexed`."""
    indexed = _indexed(df, group_col, order_col, pins)
    stats = _group_stats(indexed, group_col, total[0] if total else None)
    if total:
        stats = stats.withColumn(total[1], value("__total")).drop("__total")
    out = indexed.join(stats, group_col)
    return out.withColumn(out_col, F.col("__idx") - F.col("__first") + 1).drop("__idx", "__first")


def line_number(df: DataFrame) -> DataFrame:
    """Order of the line within its order, by product id."""
    return number_within_groups(df, "order_id", "product_id", "line_number")


def allocate_freight(df: DataFrame) -> DataFrame:
    """Add ``freight_allocated`` to lines carrying ``freight`` and
    ``net_amount``; the order total is an exact sum by partial aggregation."""
    owed = totals(df, ["order_id"], "net_amount", "__order_net").withColumnRenamed("order_id", "__order")
    out = df.join(owed, F.col("order_id") == F.col("__order"))
    share = _freight_share(F.col("freight"), F.col("net_amount"), F.col("__order_net"))
    return out.withColumn("freight_allocated", share).drop("__order", "__order_net")


def fact_dedup(new_lines: DataFrame, fact: DataFrame | None, min_order_id_exclusive: int | None = None) -> DataFrame:
    """Drop lines whose (order_id, product_id) is already loaded (NOT EXISTS,
    applied before lines are numbered).

    Only fact rows above the watermark can match lines above it, so that
    predicate is applied to the fact side too (pushed to its parquet scan).
    ``fact=None`` means no loaded part can collide and plans no join."""
    if fact is None:
        return new_lines
    keys = fact.select(*FACT_KEY)
    if min_order_id_exclusive is not None:
        keys = keys.where(F.col("order_id") > F.lit(min_order_id_exclusive))
    return new_lines.join(keys, list(FACT_KEY), "left_anti")


def fact_inputs(
    orders: DataFrame,
    lines: DataFrame,
    min_order_id_exclusive: int | None = None,
    existing_fact: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Staged ``(header, lines)`` of a fact build: the watermark filter on both
    (pushed to both scans) and NOT EXISTS de-dup on the lines."""
    header = stage_order_header(orders)
    body = stage_order_lines(lines, header.columns)
    if min_order_id_exclusive is not None:
        wm = F.lit(min_order_id_exclusive)
        header = header.where(F.col("order_id") > wm)
        body = body.where(F.col("order_id") > wm)
    return header, fact_dedup(body, existing_fact, min_order_id_exclusive)


def build_fact(
    orders: DataFrame,
    lines: DataFrame,
    dims: StarDimensions,
    run_ts: _dt.datetime,
    min_order_id_exclusive: int | None = None,
    existing_fact: DataFrame | None = None,
    pins: str | None = None,
) -> DataFrame:
    """Fact rows for every (order, line) pair, in the warehouse column order.
    ``pins``: folder for the numbered lines (see :func:`_indexed`)."""
    header, body = fact_inputs(orders, lines, min_order_id_exclusive, existing_fact)

    # header-level lookups (the product as-of lookup needs the line, so it waits)
    hot = hot_of(dims, header, body)
    header = resolve_available_keys(header, dims, skip=("product_sk",), hot=hot)

    numbered = _indexed(body, "order_id", "product_id", pins)
    stats = _group_stats(line_measures(numbered), "order_id", "net_amount")
    stats = stats.select(F.col("order_id").alias("__order"), "__first", value("__total").alias("__order_net"))
    per_order = header.join(stats, F.col("order_id") == F.col("__order")).drop("__order")
    fact = numbered.join(per_order, "order_id")
    fact = fact.withColumn("line_number", F.col("__idx") - F.col("__first") + 1).drop("__idx", "__first")
    fact = line_measures(resolve_available_keys(fact, dims, hot=hot))
    fact = fact.withColumns(
        {
            "order_freight": F.col("freight"),
            "freight_allocated": _freight_share(F.col("freight"), F.col("net_amount"), F.col("__order_net")),
            "etl_loaded_at": F.lit(run_ts).cast("timestamp"),
        }
    )
    return project_to(fact, FACT_SALES_LINE)


def renumbered(fact: DataFrame, pins: str | None = None) -> DataFrame:
    """Whole orders of fact rows with line numbers and freight shares anew."""
    rows = number_within_groups(
        fact.drop("line_number", "freight_allocated"), "order_id", "product_id", "line_number", ("net_amount", "__order_net"), pins
    )
    share = _freight_share(F.col("order_freight"), F.col("net_amount"), F.col("__order_net"))
    return project_to(rows.withColumn("freight_allocated", share), FACT_SALES_LINE)
