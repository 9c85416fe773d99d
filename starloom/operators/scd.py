"""Slowly changing dimensions as functions ``dim' = f(dim, source)``.

Parquet has no row-level UPDATE, so every operator returns new frames that the
warehouse publishes as a new snapshot:

* type 2 (history): a run splits the *current* versions into "still current"
  and "closed"; closed versions are appended to the history part and never
  rewritten again, new versions join the current part.
* type 1 (overwrite): changed attributes are replaced in place, new members
  appended; surrogate keys never change.

All joins are on the business key; surrogate keys are assigned on narrow
(business key, hash) rows, pinned once in the run's ``pins`` folder, and the
full rows are fetched by a join. Source business keys are unique (a load
checks them before it publishes).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import assign_surrogate_keys
from starloom.schemas import OPEN_END, OPEN_START, UNKNOWN_SK, DimensionSpec, project_to


def _project(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    return project_to(df, spec.schema)


# --------------------------------------------------------------------------- SCD2
def _numbered_rows(
    staged: DataFrame, keys: DataFrame, spec: DimensionSpec, start: int, pins: str | None
) -> tuple[DataFrame, int]:
    """Rows of ``staged`` whose (business key, hash) is in ``keys``, with
    surrogate keys from ``start`` in business-key order."""
    numbered, n = assign_surrogate_keys(keys.select(spec.bk, "record_hash"), [spec.bk], start, spec.sk, pins)
    return _rows_for_keys(staged.select(*spec.staged_columns), numbered, spec, "inner"), n


def _opened(rows: DataFrame, spec: DimensionSpec, effective_from: _dt.date) -> DataFrame:
    """Versions valid from a date, open-ended and current."""
    return _project(
        rows.withColumns(
            {"effective_from": F.lit(effective_from), "effective_to": F.lit(OPEN_END), "is_current": F.lit(True)}
        ),
        spec,
    )


def scd2_initial(
    staged: DataFrame, spec: DimensionSpec, start: int = 1, pins: str | None = None
) -> tuple[DataFrame, int]:
    """First population: SKs from ``start`` in business-key order, every
    version valid 1900-01-01..9999-12-31 and current."""
    rows, n = _numbered_rows(staged, staged, spec, start, pins)
    return _opened(rows, spec, OPEN_START), n


def scd2_delta_keys(staged: DataFrame, current: DataFrame, spec: DimensionSpec) -> DataFrame:
    """``(business key, record_hash)`` of source rows that are new (no current
    version) or whose hash differs from the current version. Only these two
    narrow columns are shuffled for the comparison. A NULL stored hash (the
    unknown member) never compares as different."""
    d = current.where(F.col("is_current")).select(
        F.col(spec.bk).alias("__d_bk"), F.col("record_hash").alias("__d_hash")
    )
    j = staged.select(spec.bk, "record_hash").join(d, F.col(spec.bk) == F.col("__d_bk"), "left")
    changed = F.col("__d_bk").isNull() | (F.col("__d_hash") != F.col("record_hash"))
    return j.where(changed).select(spec.bk, "record_hash")


def _rows_for_keys(staged: DataFrame, keys: DataFrame, spec: DimensionSpec, how: str) -> DataFrame:
    """Full staged rows whose (business key, hash) is in ``keys`` (null-safe),
    with the extra columns of ``keys``."""
    k = keys.withColumnsRenamed({spec.bk: "__k_bk", "record_hash": "__k_hash"})
    cond = F.col(spec.bk).eqNullSafe(F.col("__k_bk")) & (F.col("record_hash") == F.col("__k_hash"))
    return staged.join(k, cond, how).drop("__k_bk", "__k_hash")


def scd2_delta(staged: DataFrame, current: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Source rows that are new or changed (see :func:`scd2_delta_keys`)."""
    keys = scd2_delta_keys(staged, current, spec)
    return _rows_for_keys(staged.select(*spec.staged_columns), keys, spec, "left_semi")


def scd2_close(
    current: DataFrame, delta: DataFrame, spec: DimensionSpec, effective_date: _dt.date
) -> DataFrame:
    """Current versions with the run's closings applied, in one pass.

    A current version is closed when the delta holds its business key with a
    different hash; it then ends the day before ``effective_date`` and stops
    being current. The delta is folded to one row per key (min/max hash) so
    the join never multiplies dimension rows."""
    marks = delta.groupBy(F.col(spec.bk).alias("__x_bk")).agg(
        F.min("record_hash").alias("__h_lo"), F.max("record_hash").alias("__h_hi")
    )
    j = current.join(marks, F.col(spec.bk) == F.col("__x_bk"), "left")
    h = F.col("record_hash")
    closing = F.col("is_current") & F.coalesce((F.col("__h_lo") != h) | (F.col("__h_hi") != h), F.lit(False))
    out = j.withColumns(
        {
            "effective_to": F.when(closing, F.date_sub(F.lit(effective_date), 1)).otherwise(F.col("effective_to")),
            "is_current": F.when(closing, F.lit(False)).otherwise(F.col("is_current")),
        }
    )
    return _project(out, spec)


def scd2_insert(
    staged: DataFrame,
    delta_keys: DataFrame,
    spec: DimensionSpec,
    effective_date: _dt.date,
    start: int,
    pins: str | None = None,
) -> tuple[DataFrame, int]:
    """New versions (changed members) and new members: the rows of ``staged``
    named by ``delta_keys``, SKs from ``start`` in business-key order, valid
    from ``effective_date``, open-ended, current."""
    rows, n = _numbered_rows(staged, delta_keys, spec, start, pins)
    return _opened(rows, spec, effective_date), n


@dataclass
class Scd2Result:
    versions: DataFrame  # every version touched by the run: still current, closed now, opened now
    inserted: DataFrame  # versions opened by this run
    delta_rows: int  # size of the delta = how far the SK sequence advances
    next_sk: int

    @property
    def current(self) -> DataFrame:
        return self.versions.where(F.col("is_current"))

    @property
    def closed(self) -> DataFrame:
        return self.versions.where(~F.col("is_current"))


def scd2_apply(
    current: DataFrame,
    staged: DataFrame,
    spec: DimensionSpec,
    effective_date: _dt.date,
    next_sk: int,
    pins: str | None = None,
) -> Scd2Result:
    """Delta, close, insert in that order. ``current`` must hold only the
    current versions (history rows are untouched and need not be read); the
    result's ``versions`` are the new current set plus the versions this run
    closed, computed in one pass over ``current``."""
    keys = scd2_delta_keys(staged, current, spec)
    inserted, n = scd2_insert(staged, keys, spec, effective_date, next_sk, pins)
    marked = scd2_close(current, inserted.select(spec.bk, "record_hash"), spec, effective_date)
    return Scd2Result(marked.unionByName(inserted), inserted, n, next_sk + n)


# --------------------------------------------------------------------------- SCD1
def scd1_initial(
    staged: DataFrame, spec: DimensionSpec, start: int = 1, pins: str | None = None
) -> tuple[DataFrame, int]:
    """First population of an overwrite dimension: SKs in business-key order."""
    rows, n = _numbered_rows(staged, staged, spec, start, pins)
    return _project(rows, spec), n


def scd1_changed_keys(dim: DataFrame, staged: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Business keys of known members whose hash differs in the source."""
    s = staged.select(F.col(spec.bk).alias("__s_bk"), F.col("record_hash").alias("__s_hash"))
    known = dim.where(F.col(spec.sk) != UNKNOWN_SK).select(spec.bk, "record_hash")
    return known.join(s, (F.col(spec.bk) == F.col("__s_bk")) & (F.col("record_hash") != F.col("__s_hash"))).select(spec.bk)


def scd1_overwrite(dim: DataFrame, staged: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Overwrite the attributes (and hash) of members whose hash changed.

    The unknown member is never touched and surrogate keys never change, so
    facts already pointing at a member now show its new attributes."""
    attrs = spec.attributes + ["record_hash"]
    s = staged.selectExpr(f"`{spec.bk}` AS __s_bk", *[f"`{a}` AS `__s_{a}`" for a in attrs])
    j = dim.join(s, F.col(spec.bk) == F.col("__s_bk"), "left")
    changed = (
        f"(__s_bk IS NOT NULL AND `{spec.sk}` <> {UNKNOWN_SK} AND coalesce(record_hash <> __s_record_hash, false))"
    )
    out = j.selectExpr(
        *[
            (f"CASE WHEN {changed} THEN `__s_{f.name}` ELSE `{f.name}` END" if f.name in attrs else f"`{f.name}`")
            + f" AS `{f.name}`"
            for f in spec.schema.fields
        ]
    )
    return _project(out, spec)


def scd1_new_member_keys(dim: DataFrame, staged: DataFrame, spec: DimensionSpec) -> DataFrame:
    """``(business key, record_hash)`` of source members whose key is not in
    the dimension at all (only narrow columns take part in the anti-join)."""
    return staged.select(spec.bk, "record_hash").join(dim.select(spec.bk), spec.bk, "left_anti")


def scd1_insert_new(
    dim: DataFrame, staged: DataFrame, spec: DimensionSpec, start: int, pins: str | None = None
) -> tuple[DataFrame, int]:
    """New members numbered from ``start`` in business-key order."""
    rows, n = _numbered_rows(staged, scd1_new_member_keys(dim, staged, spec), spec, start, pins)
    return _project(rows, spec), n


@dataclass
class Scd1Result:
    dim: DataFrame
    inserted: DataFrame
    new_rows: int
    next_sk: int
    changed: bool  # whether the dimension differs from what it was


def scd1_apply(
    dim: DataFrame, staged: DataFrame, spec: DimensionSpec, next_sk: int, pins: str | None = None
) -> Scd1Result:
    """Overwrite changed members, then append new ones (both against the
    dimension as it was before the run)."""
    inserted, n = scd1_insert_new(dim, staged, spec, next_sk, pins)
    changed = n > 0 or not scd1_changed_keys(dim, staged, spec).isEmpty()
    overwritten = scd1_overwrite(dim, staged, spec)
    return Scd1Result(overwritten.unionByName(inserted), inserted, n, next_sk + n, changed)
