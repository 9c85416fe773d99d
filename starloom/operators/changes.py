"""Source-change simulation: constant updates by predicate and guarded inserts.

Used to exercise incremental loads: ``simulate_changes`` returns a *new*
source (nothing is mutated), so the previous snapshot stays readable.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.sources.source import SOURCE_KEYS, SOURCE_LABELS, Source


@dataclass(frozen=True)
class Update:
    """``UPDATE <table> SET col = expr, ... WHERE predicate``."""

    table: str
    where: Column
    set: dict[str, Column] = field(default_factory=dict)


def apply_update(df: DataFrame, upd: Update) -> DataFrame:
    """Rewrite the matching rows column by column (the predicate is evaluated
    on the row as it was before the update, like SQL)."""
    flag = "__upd_hit"
    out = df.withColumn(flag, F.coalesce(upd.where, F.lit(False)))
    out = out.withColumns(
        {c: F.when(F.col(flag), v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in upd.set.items()}
    )
    return out.drop(flag)


def guarded_insert(target: DataFrame, rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """``INSERT ... SELECT ... WHERE NOT EXISTS (same key)`` - re-running it
    adds nothing. Only candidate rows are compared against the target keys."""
    fresh = rows.select(*target.columns).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh)


def simulate_changes(
    src: Source,
    inserts: dict[str, DataFrame] | None = None,
    updates: list[Update] | None = None,
) -> Source:
    """Apply guarded inserts, then updates (updates also reach inserted rows)."""
    tables = src.tables()
    for name, rows in (inserts or {}).items():
        tables[name] = guarded_insert(tables[name], rows, SOURCE_KEYS[name])
    for upd in updates or []:
        tables[upd.table] = apply_update(tables[upd.table], upd)
    return Source(**tables)


def source_counts(src: Source, measures: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """``(metric, value)``: one row count per source table (``'<Table> total'``)
    and, for ``measures`` (metric -> table, aggregate), what an update changes
    without changing a count. One global aggregate each, planned as one job."""
    wanted = {f"{SOURCE_LABELS[n]} total": (n, F.count(F.lit(1))) for n in src.tables()} | (measures or {})
    parts = [
        src.tables()[table].agg(a.cast("decimal(38,2)").alias("value")).select(F.lit(metric).alias("metric"), "value")
        for metric, (table, a) in wanted.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
