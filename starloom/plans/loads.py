"""Warehouse runs: init, full historical load, incremental load.

Each run computes new parts from the source and the previous manifest, writes
them, and publishes a manifest last (all-or-nothing). Independent dimensions
are built as concurrent Spark jobs (one driver thread each), so small
dimensions do not wait on each other. Dimensions are read back from the parts
just written before the fact is built: the fact plan starts from files (short
lineage, measured row counts for broadcast decisions).
"""

from __future__ import annotations

import datetime as _dt
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.parallel import run_parallel
from starloom.operators.dimensions import build_dim_date, unknown_member
from starloom.operators.facts import StarDimensions, build_fact, renumbered
from starloom.operators.quality import duplicate_keys
from starloom.operators.scd import scd1_apply, scd1_initial, scd2_apply, scd2_initial
from starloom.operators.staging import (
    stage_customer,
    stage_employee,
    stage_product,
    stage_sales_lines,
    stage_shipper,
)
from starloom.plans.warehouse import CODEC, CURRENT, HISTORY, SORT, Manifest, Warehouse, add_part, carry_parts, part_key
from starloom.schemas import (
    CUSTOMER,
    DIMENSIONS,
    EMPLOYEE,
    ETL_RUN_LOG,
    FACT_KEY,
    FULL_NOTE,
    INCREMENTAL_NOTE,
    OPEN_START,
    PRODUCT,
    SHIPPER,
    DimensionSpec,
)
from starloom.session import remove_folder
from starloom.sources.source import Source

RUN_LOG = "etl_run_log"
FACT = "fact_sales_line"

class KeyViolation(RuntimeError):
    """A key that must be unique isn't; the run was not published."""


def _iso(v) -> str | None:
    return v.isoformat() if v is not None else None


@dataclass
class _Written:
    """Parts written by one step: (part key, path, rows, append?)."""

    parts: list[tuple[str, str, int, bool]]
    members: int = 0  # members counted for the run log / key sequence
    next_sk: int | None = None


def _add(m: Manifest, written: _Written) -> None:
    for key, path, n, append in written.parts:
        add_part(m, key, path, n, append)


def init_warehouse(spark: SparkSession, root: str) -> Manifest:
    """Create the empty warehouse (idempotent: an existing one is left alone)."""
    wh = Warehouse(spark, root)
    prev = wh.latest()
    if prev is not None:
        return prev
    return wh.publish(Manifest(run_id=0, run_type="INIT"))


def star_dimensions(wh: Warehouse, m: Manifest) -> StarDimensions:
    return StarDimensions(
        customer=wh.table(CUSTOMER.table, m),
        product=wh.table(PRODUCT.table, m),
        employee=wh.table(EMPLOYEE.table, m),
        shipper=wh.table(SHIPPER.table, m),
        date=wh.table("dim_date", m),
    )


def _ranges_meet(a: dict, b: dict | None) -> bool:
    return not b or a["min_order_id"] <= b["max_order_id"] and a["max_order_id"] >= b["min_order_id"]


def check_keys(wh: Warehouse, m: Manifest, new_fact: str | None) -> None:
    """Raise unless every key of the state ``m`` is unique: surrogate keys,
    the business keys of current members, and the keys of the fact rows that
    the run wrote, among themselves and against the older parts (which were
    checked by their run). Of those only parts are read that may hold one of the
    new orders, by range and sketch. One aggregation; a duplicated source row
    shows as a member with two current versions."""
    frames = {}
    for spec in DIMENSIONS:
        dim = wh.table(spec.table, m, part=CURRENT if spec.kind == "scd2" else None)
        frames[f"{spec.table}.{spec.sk}"] = dim.select(spec.sk)
        frames[f"{spec.table}.{spec.bk}"] = dim.select(spec.bk)
    if new_fact is not None:
        new = wh.fact([new_fact]).select(*FACT_KEY)
        mine = m.part_stats.get(new_fact)
        older = [p for p in m.parts.get(FACT, []) if p != new_fact and mine and _ranges_meet(mine, m.part_stats.get(p))]
        if older:
            older = wh.fact_paths_holding(new, m, older)
        if older:
            new = new.unionByName(wh.fact(older).select(*FACT_KEY).join(new, list(FACT_KEY), "left_semi"))
        frames[f"{FACT}({', '.join(FACT_KEY)})"] = new
    bad = duplicate_keys(frames).collect()  # a row per broken key column
    if bad:
        raise KeyViolation("; ".join(f"{r.key}: {r.duplicate_keys} duplicated, such as {r.example}" for r in bad))


def _staged(src: Source) -> dict:
    """Per dimension, what stages its members."""
    return {
        CUSTOMER: lambda: stage_customer(src.customers),
        PRODUCT: lambda: stage_product(src.products, src.categories, src.suppliers),
        EMPLOYEE: lambda: stage_employee(src.employees),
        SHIPPER: lambda: stage_shipper(src.shippers),
    }


def _attempt(load):
    """Run a load; leave no pins, and nothing at all of a failed attempt."""

    @functools.wraps(load)
    def run(spark: SparkSession, src: Source, root: str, *args, **kwargs) -> Manifest:
        wh = Warehouse(spark, root)
        prev = wh.latest()
        run_id = (prev.run_id if prev else 0) + 1
        failed = True
        try:
            done = load(wh, prev, run_id, src, *args, **kwargs)
            failed = False
            return done
        finally:
            wh.end_attempt(run_id, failed)

    return run


def run_log_row(
    spark: SparkSession,
    run_id: int,
    run_ts: _dt.datetime,
    run_type: str,
    effective_date: _dt.date,
    rows_customer: int,
    rows_product: int,
    rows_fact: int,
    notes: str,
) -> DataFrame:
    return spark.createDataFrame(
        [(run_id, run_ts, run_type, effective_date, rows_customer, rows_product, rows_fact, notes)], ETL_RUN_LOG
    )


def _write_fact(wh: Warehouse, run_id: int, fact: DataFrame, tag: str | None = None) -> tuple[str, int, dict]:
    """Write a fact part; its order-id range is observed during the write and
    kept in the manifest (prunes the de-dup of later runs to nothing), and the
    sketch of its order ids is kept beside it."""
    path, n, m = wh.write_part_observed(
        run_id,
        FACT,
        fact,
        sort_by=SORT[FACT],
        tag=tag or f"r{run_id}",
        metrics={"min_order_id": F.min("order_id"), "max_order_id": F.max("order_id")},
    )
    if n:
        m["sketch_bits"] = wh.write_sketch(path, n)
    return path, n, m


# ------------------------------------------------------------------ full load
def _initial_dimension(wh: Warehouse, run_id: int, spec: DimensionSpec, staged: DataFrame) -> _Written:
    build = scd2_initial if spec.kind == "scd2" else scd1_initial
    initial, n_init = build(staged, spec, start=1, pins=wh.pins)
    dim = unknown_member(wh.spark, spec).unionByName(initial)
    part = CURRENT if spec.kind == "scd2" else None
    path, n = wh.write_part(run_id, spec.table, dim, part=part)
    return _Written([(part_key(spec.table, part), path, n, False)], members=n_init, next_sk=n_init + 1)


def _log_run(wh: Warehouse, m: Manifest, customers: int, products: int, facts: int, notes: str) -> None:
    ts, eff = _dt.datetime.fromisoformat(m.run_ts), _dt.date.fromisoformat(m.effective_date)
    log = run_log_row(wh.spark, m.run_id, ts, m.run_type, eff, customers, products, facts, notes)
    path, n = wh.write_part(m.run_id, RUN_LOG, log)
    add_part(m, RUN_LOG, path, n, append=True)


@_attempt
def _full_load(wh: Warehouse, prev: Manifest | None, run_id: int, src: Source, run_ts: _dt.datetime) -> Manifest:
    m = Manifest(run_id, "FULL", _iso(run_ts), _iso(OPEN_START), watermark_updated_at=_iso(run_ts))
    m.stream_batch_id = prev.stream_batch_id if prev else None
    carry_parts(m, prev, [RUN_LOG])

    def calendar() -> _Written:
        path, n = wh.write_part(run_id, "dim_date", build_dim_date(src.orders))
        return _Written([("dim_date", path, n, False)])

    tasks = {"dim_date": calendar}
    for spec, staged in _staged(src).items():
        tasks[spec.name] = lambda spec=spec, staged=staged: _initial_dimension(wh, run_id, spec, staged())
    done = run_parallel(tasks)
    for w in done.values():
        _add(m, w)  # type: ignore[arg-type]
    m.next_sk = {spec.name: done[spec.name].next_sk for spec in DIMENSIONS}

    # fact, resolved against the dimensions just written
    fact = build_fact(src.orders, src.order_details, star_dimensions(wh, m), run_ts, pins=wh.pins)
    path, n_fact, stats = _write_fact(wh, run_id, fact)
    add_part(m, FACT, path, n_fact, append=False)
    if n_fact:
        m.part_stats[path] = stats
    m.watermark = m.fact_max_order_id = stats["max_order_id"]
    check_keys(wh, m, path)
    _log_run(wh, m, done[CUSTOMER.name].members, done[PRODUCT.name].members, n_fact, FULL_NOTE)
    return wh.publish(wh.merge_parts(m), after=prev.run_id if prev else None)


def full_load(spark: SparkSession, src: Source, root: str, run_ts: _dt.datetime) -> Manifest:
    """Rebuild every dimension and the fact from the whole source.

    Replaces dimensions, fact, watermark and key sequences (a re-run starts
    from scratch); the run log is kept and the run id continues from it.
    Raises :class:`KeyViolation`, publishing nothing, if a source key isn't unique."""
    return _full_load(spark, src, root, run_ts)


# ------------------------------------------------------------------ incremental load
def _scd2_step(
    wh: Warehouse, prev: Manifest, run_id: int, spec: DimensionSpec, staged: DataFrame, effective_date: _dt.date
) -> _Written:
    """Apply one type-2 dimension. The new current set (kept + opened) and
    the versions closed by this run come out of one partitioned write: the
    current part replaces the previous one, closed versions are appended to
    the history."""
    current = wh.table(spec.table, prev, part=CURRENT)
    res = scd2_apply(current, staged, spec, effective_date, prev.next_sk.get(spec.name, 1), wh.pins)
    out = _Written([], members=res.delta_rows, next_sk=res.next_sk)
    if res.delta_rows:
        written = wh.write_split_parts(
            run_id, spec.table, res.versions, F.col("is_current"), (CURRENT, HISTORY)
        )
        if CURRENT in written:
            path, n = written[CURRENT]
            out.parts.append((part_key(spec.table, CURRENT), path, n, False))
        if HISTORY in written:
            path, n = written[HISTORY]
            out.parts.append((part_key(spec.table, HISTORY), path, n, True))
    return out


def _scd1_step(wh: Warehouse, prev: Manifest, run_id: int, spec: DimensionSpec, staged: DataFrame) -> _Written:
    res = scd1_apply(wh.table(spec.table, prev), staged, spec, prev.next_sk.get(spec.name, 1), wh.pins)
    if not res.changed:
        return _Written([], members=0, next_sk=res.next_sk)
    path, n = wh.write_part(run_id, spec.table, res.dim)
    return _Written([(spec.table, path, n, False)], members=res.new_rows, next_sk=res.next_sk)


def _next(wh: Warehouse, prev: Manifest | None, run_id: int, effective_date: _dt.date, run_ts: _dt.datetime) -> Manifest:
    """Manifest of an incremental run that so far changes nothing."""
    prev = wh.require() if prev is None else prev
    if prev.run_type == "INIT":
        raise RuntimeError("incremental load needs a full load first")
    m = Manifest(run_id, "INCREMENTAL", _iso(run_ts), _iso(effective_date), prev.watermark, _iso(run_ts), prev.fact_max_order_id)
    m.next_sk, m.stream_batch_id = dict(prev.next_sk), prev.stream_batch_id
    m.dimension_version, m.rejected_lines = prev.dimension_version, prev.rejected_lines
    return carry_parts(m, prev, list(prev.parts))


def _dimension_steps(wh: Warehouse, prev: Manifest, run_id: int, src: Source, effective_date: _dt.date) -> dict:
    tasks = {}
    for spec, staged in _staged(src).items():
        if spec.kind == "scd2":
            tasks[spec.name] = lambda spec=spec, staged=staged: _scd2_step(wh, prev, run_id, spec, staged(), effective_date)
        else:
            tasks[spec.name] = lambda spec=spec, staged=staged: _scd1_step(wh, prev, run_id, spec, staged())
    return tasks


def _add_dimensions(m: Manifest, done: dict) -> tuple[int, int]:
    """Take over the written dimensions; new and changed customers, products."""
    for spec in DIMENSIONS:
        if spec.name in done:
            _add(m, done[spec.name])
            m.next_sk[spec.name] = done[spec.name].next_sk
    return tuple(done[s.name].members if s.name in done else 0 for s in (CUSTOMER, PRODUCT))


@_attempt
def _incremental_load(
    wh: Warehouse, prev: Manifest | None, run_id: int, src: Source, effective_date: _dt.date, run_ts: _dt.datetime
) -> Manifest:
    m = _next(wh, prev, run_id, effective_date, run_ts)
    wm = m.watermark
    # fact parts that could hold an order above the watermark (normally none), then those that may hold a new one
    colliding = wh.fact_paths_above(wm, m) if wm is not None else []
    if colliding:
        new_orders = src.orders.select(F.col("OrderID").cast("long").alias("order_id")).where(F.col("order_id") > wm)
        colliding = wh.fact_paths_holding(new_orders, m, colliding)
    tasks = _dimension_steps(wh, prev, run_id, src, effective_date)
    if colliding:  # else keys are unique, so every staged line is one fact row written below
        tasks["staged_lines"] = lambda: stage_sales_lines(src.orders, src.order_details, min_order_id_exclusive=wm).count()
    done = run_parallel(tasks)
    customers, products = _add_dimensions(m, done)

    n_new, path = 0, None
    if wm is not None:  # a NULL watermark ("order id > NULL") selects nothing
        dims = star_dimensions(wh, m)
        fact = build_fact(src.orders, src.order_details, dims, run_ts, wm, existing_fact=wh.fact(colliding) if colliding else None, pins=wh.pins)
        path, n_new, stats = _write_fact(wh, run_id, fact)
        _add_fact(m, path, n_new, stats)
    check_keys(wh, m, path if n_new else None)
    m.watermark = m.fact_max_order_id if m.fact_max_order_id is not None else wm
    _log_run(wh, m, customers, products, done.get("staged_lines", n_new), INCREMENTAL_NOTE)
    return wh.publish(wh.merge_parts(m), after=prev.run_id)


def _add_fact(m: Manifest, path: str, n: int, stats: dict) -> None:
    if n:
        add_part(m, FACT, path, n, append=True)
        m.part_stats[path] = stats
        m.fact_max_order_id = max(stats["max_order_id"], m.fact_max_order_id or stats["max_order_id"])


def incremental_load(
    spark: SparkSession, src: Source, root: str, effective_date: _dt.date, run_ts: _dt.datetime
) -> Manifest:
    """Apply source changes as of ``effective_date`` and load new orders.

    Type-2 members new or changed since the last run get a version valid from
    ``effective_date`` (older orders of a brand-new member therefore resolve
    to the unknown member); type-1 members are overwritten or appended; order
    lines above the watermark and not yet loaded become fact rows, resolved
    against the dimensions as updated by this run. Raises
    :class:`KeyViolation`, publishing nothing, if a source key isn't unique."""
    return _incremental_load(spark, src, root, effective_date, run_ts)


# ------------------------------------------------------------------ landed lines
PENDING = "pending_lines"  # landed lines whose order header is not there yet


@_attempt
def _lines_load(
    wh: Warehouse,
    prev: Manifest | None,
    run_id: int,
    src: Source,
    lines: DataFrame,
    batch_id: int,
    effective_date: _dt.date,
    run_ts: _dt.datetime,
    dimension_version: str | None,
) -> Manifest:
    m = _next(wh, prev, run_id, effective_date, run_ts)
    m.stream_batch_id = batch_id
    done = {}
    if dimension_version is None or dimension_version != prev.dimension_version:
        done = run_parallel(_dimension_steps(wh, prev, run_id, src, effective_date))
        m.dimension_version = dimension_version
    customers, products = _add_dimensions(m, done)

    key = ["OrderID", "ProductID"]
    no_key = F.col("OrderID").isNull() | F.col("ProductID").isNull()
    landed = lines
    if prev.parts.get(PENDING):
        landed = landed.unionByName(wh.spark.read.schema(landed.schema).parquet(*prev.parts[PENDING]))
    rest = [c for c in landed.columns if c not in key]
    # a line that landed twice counts once; what follows reads lines and headers many times, so both are pinned
    once = landed.groupBy(*key).agg(F.min(F.struct(*rest)).alias("l"), F.count(F.lit(1)).alias("__n")).select(*key, "l.*", "__n")
    once = _pinned(wh, once, "landed_lines")
    m.rejected_lines += once.where(no_key).agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    landed = once.where(~no_key).drop("__n")
    ids = landed.select("OrderID").distinct()
    headers = _pinned(wh, src.orders.join(ids, "OrderID", "left_semi"), "landed_headers")
    waiting = landed.join(headers.select("OrderID"), "OrderID", "left_anti")
    path = f"{wh.root}/runs/{run_id}-{wh.attempt}/{PENDING}"
    waiting.write.parquet(path)
    n_waiting = wh.spark.read.schema(waiting.schema).parquet(path).count()
    m.parts.pop(PENDING, None)
    m.rows.pop(PENDING, None)
    if n_waiting:
        add_part(m, PENDING, path, n_waiting, append=False)

    # lines not loaded yet, and the loaded lines of the orders they belong to, from the parts that may hold these orders
    touched = ids.select(F.col("OrderID").cast("long").alias("order_id"))
    holding = wh.fact_paths_holding(touched, m)
    old = wh.fact(holding).join(touched, "order_id", "left_semi") if holding else None
    new = build_fact(headers, landed, star_dimensions(wh, m), run_ts, existing_fact=old, pins=wh.pins)
    n_old = 0
    if not holding:  # all orders are new: their lines are numbered and their freight is shared as they will stay
        path, n_new, stats = _write_fact(wh, run_id, new)
        _add_fact(m, path, n_new, stats)
    else:
        fresh, n_new, _ = wh.write_part_observed(run_id, FACT, new, tag="landed")
    if holding and n_new:
        new = wh.fact([fresh])
        again = old.join(new.select("order_id").distinct(), "order_id", "left_semi")
        path, n_all, stats = _write_fact(wh, run_id, renumbered(again.unionByName(new), wh.pins))
        n_old = n_all - n_new
        if n_old:
            _take_out(wh, m, wh.fact([path]).select("order_id").distinct(), holding)
        _add_fact(m, path, n_all, stats)
        remove_folder(wh.spark, fresh)
    check_keys(wh, m, path if n_new else None)
    m.watermark = m.fact_max_order_id
    _log_run(wh, m, customers, products, n_new, f"{STREAM_NOTE}: {n_old} lines renumbered, {n_waiting} waiting")
    return wh.publish(wh.merge_parts(m), after=prev.run_id)


STREAM_NOTE = "Landed lines loaded"


def _pinned(wh: Warehouse, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once for this run, and read back."""
    path = f"{wh.pins}/{name}"
    df.write.parquet(path, compression=CODEC)
    return wh.spark.read.schema(df.schema).parquet(path)


def _take_out(wh: Warehouse, m: Manifest, orders: DataFrame, holding: list[str]) -> None:
    """Rewrite, without these orders, the fact parts that may hold one."""
    for i, p in enumerate(holding):
        kept = wh.fact([p]).join(orders, "order_id", "left_anti")
        path, n, new_stats = _write_fact(wh, m.run_id, kept, tag=f"without{i}")
        at = m.parts[FACT].index(p)
        m.parts[FACT][at : at + 1] = [path] if n else []
        m.rows[FACT] += n - m.part_rows.get(p, n)
        m.part_rows[path] = n
        m.part_stats.pop(p, None)
        if n:
            m.part_stats[path] = new_stats


def lines_load(
    spark: SparkSession,
    src: Source,
    root: str,
    lines: DataFrame,
    batch_id: int,
    effective_date: _dt.date,
    run_ts: _dt.datetime,
    dimension_version: str | None = None,
) -> Manifest:
    """Load order lines in whatever order they land, without a watermark.

    A line is loaded once, by its (order, product); lines of an order that has
    fact rows already renumber the whole order and share its freight anew, so
    orders split over batches end as if loaded at once. Lines whose header is
    missing wait in the warehouse and are tried again with every batch; lines
    without an order or product id are counted in the manifest. Dimensions are
    applied only if ``dimension_version`` differs from the last run's (or is
    ``None``)."""
    return _lines_load(spark, src, root, lines, batch_id, effective_date, run_ts, dimension_version)
