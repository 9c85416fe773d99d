"""Sums of DOUBLE columns that don't depend on the order of addition.

Every finite DOUBLE is written as whole numbers of fixed units. A value that
is zero, or from 2^-20 up to 2^42 in size, is ``high`` units of 2^-20 and
``low`` units of 2^-72. Any other value is cut at the multiples of 60 bits its
digits span: one or two whole numbers of units 2^(60 * bin). Whole numbers
(DECIMALs) add up exactly in any order and grouping, so partial aggregation
gives the same total for every partitioning; the total is rounded once, to the
nearest DOUBLE.

Rows are grouped by their keys and ``__bin`` first (``NEAR`` for ordinary
values, so ordinary data has one such group per key), then by the keys alone:
a group carries its near total and at most 40 far ones. NaN and infinite
values are refused with an error; NULLs are ignored, as SUM ignores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 99  # no far bin has this number
_LEAST, _MOST = -20, 20  # far bins: 2^-1200 to 2^1200 and room for carries
_DEC = "DECIMAL(28,0)"
_SUM = "DECIMAL(38,0)"
_BIN = f"{2**60}BD"


def _parts(v: str) -> str:
    """SQL for the parts of the DOUBLE ``v``: an array of (bin, high, low,
    once); ``once`` is 1 in the first part of a value and 0 in others."""
    part = "named_struct('__bin', {}, '__high', CAST({} AS " + _DEC + "), '__low', CAST({} AS " + _DEC + "), '__once', {}L)"
    scaled = f"({v} * {2.0**20!r}D)"
    near = part.format(NEAR, f"floor{scaled}", f"floor(({scaled} - floor{scaled}) * {2.0**52!r}D)", 1)
    bin_ = f"CAST(floor(log2(abs({v})) / 60) AS INT)"
    half = f"power(2D, -30 * {bin_})"
    units = f"(abs({v}) * {half} * {half})"  # from 1/2 to 2^61: exact, and so are its whole part and the rest
    sign = f"CAST(signum({v}) AS INT)"
    far = f"{part.format(bin_, f'{sign} * floor{units}', 0, 1)}, {part.format(f'{bin_} - 1', f'{sign} * floor(({units} - floor{units}) * {2.0**60!r}D)', 0, 0)}"
    return f"""CASE WHEN {v} IS NULL OR {v} = 0 OR abs({v}) >= {2.0**-20!r}D AND abs({v}) < {2.0**42!r}D THEN array({near})
        WHEN isnan({v}) OR abs({v}) = double('infinity') THEN raise_error(concat('amount out of range: ', CAST({v} AS STRING)))
        ELSE array({far}) END"""


def binned(df: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of ``df`` and the parts of its last one: ``__bin``, ``__high``,
    ``__low``, ``__once``; a row per part."""
    *kept, value = cols
    return df.select(*kept, F.col(value).cast("double").alias("__v")).selectExpr(*[f"`{c}`" for c in kept], f"inline({_parts('__v')})")


def part_sums() -> list[Column]:
    """Aggregates of the parts that fall into one group and bin."""
    return [F.sum("__high").alias("__high"), F.sum("__low").alias("__low")]


def _near(part: str, where: str) -> str:
    return f"sum(CASE WHEN __bin = {NEAR}{where} THEN {part} END)"


def held(out: str = "__sum", minus: str | None = None, plus: str | None = None) -> Column:
    """Aggregate of the groups of one key, over all bins: a struct that
    :func:`value` reads. ``plus`` and ``minus`` are conditions on the group's
    rows: those that count, and those that count with the opposite sign."""
    if plus is None:
        high, low, far = "__high", "__low", "__high"
        where = ""
    else:
        signed = f"CASE WHEN {plus} THEN 1 {f'WHEN {minus} THEN -1 ' if minus else ''}END"
        high, low, far = (f"CAST({signed} * {c} AS {_SUM})" for c in ("__high", "__low", "__high"))
        where = f" AND ({plus}{f' OR {minus}' if minus else ''})"
    listed = f"collect_list(CASE WHEN __bin <> {NEAR}{where} THEN named_struct('bin', __bin, 'units', CAST({far} AS {_SUM})) END)"
    return F.expr(f"named_struct('high', CAST({_near(high, where)} AS {_SUM}), 'low', CAST({_near(low, where)} AS {_SUM}), 'far', {listed})").alias(out)


def _near_value(s: str) -> str:
    """Nearest DOUBLE of ``high`` units of 2^-20 and ``low`` of 2^-72."""
    low = f"pmod({s}.low, {2**52}BD)"
    high = f"({s}.high + ({s}.low - {low}) div {2**52}BD)"
    # beyond 2^70 units the low part only tells on which side of a tie the total lies
    return f"""CASE WHEN abs({high}) < {2**70}BD THEN CAST(CAST({high} AS DECIMAL(22,0)) * {2**52}BD + CAST({low} AS DECIMAL(16,0)) AS DOUBLE) / {2.0**72!r}D
        ELSE CAST({high} * 2BD + CASE WHEN {low} = 0 THEN 0BD ELSE 1BD END AS DOUBLE) / {2.0**21!r}D END"""


def _far_value(s: str) -> str:
    """Nearest DOUBLE of all parts: digits of 60 bits with carries, the lowest
    first; of a negative total those of its opposite."""
    low, high = f"coalesce({s}.low, 0BD)", f"coalesce({s}.high, 0BD)"
    rest = f"pmod({low}, {2**52}BD)"
    carried = f"({high} + ({low} - {rest}) div {2**52}BD)"
    below = f"pmod({carried}, {2**20}BD)"

    def entry(at: int, units: str) -> str:
        return f"named_struct('bin', {at}, 'units', CAST({units} AS {_SUM}))"

    near = ", ".join([entry(-2, f"CAST({rest} AS DECIMAL(16,0)) * {2**48}BD"), entry(-1, f"CAST({below} AS DECIMAL(7,0)) * {2**40}BD"), entry(0, f"({carried} - {below}) / CAST({2**20} AS DECIMAL(7,0))")])
    parts = f"concat({s}.far, array({near}))"
    zero = f"CAST(0 AS {_SUM})"

    def digits(sign: str) -> str:
        total = f"CAST(a.carry + aggregate(filter({parts}, p -> p.bin = b), {zero}, (t, p) -> CAST(t + {sign} * p.units AS {_SUM})) AS {_SUM})"
        step = f"element_at(transform(array({total}), t -> named_struct('carry', CAST((t - pmod(t, {_BIN})) div {_BIN} AS {_SUM}), 'digits', concat(a.digits, array(CAST(pmod(t, {_BIN}) AS {_SUM}))))), 1)"
        return f"aggregate(sequence({_LEAST}, {_MOST}), named_struct('carry', {zero}, 'digits', CAST(array() AS ARRAY<{_SUM}>)), (a, b) -> {step})"

    def rounded(d: str) -> str:
        top = f"coalesce(array_max(filter(sequence(2, {_MOST - _LEAST + 1}), i -> element_at({d}, i) > 0)), 2)"
        sticky = "CASE WHEN exists(slice(d, 1, at - 2), x -> x > 0) THEN 1BD ELSE 0BD END"
        whole = f"(CAST(element_at(d, at) AS DECIMAL(19,0)) * {2**61}BD + CAST(element_at(d, at - 1) AS DECIMAL(19,0)) * 2BD + {sticky})"
        bits = f"(60 * (at - 2 + {_LEAST}) - 1)"  # place of the last bit of ``whole``
        scaled = f"CAST({whole} AS DOUBLE) * power(2D, {bits} div 2) * power(2D, {bits} - {bits} div 2)"
        return f"element_at(transform(array({d}), d -> element_at(transform(array({top.replace(d, 'd')}), at -> {scaled}), 1)), 1)"

    one = f"element_at(transform(array({digits('1')}), r -> CASE WHEN r.carry = 0 THEN {rounded('r.digits')} ELSE -{rounded(f'{digits("-1")}.digits')} END), 1)"
    return one


def value(column: str = "__sum") -> Column:
    """DOUBLE nearest to the total that a struct of :func:`held` stands for;
    null if no value went into it."""
    s = f"`{column}`"
    return F.expr(f"CASE WHEN size({s}.far) = 0 THEN CASE WHEN {s}.high IS NOT NULL THEN {_near_value(s)} END ELSE {_far_value(s)} END")


def totals(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """Exact sum of ``col`` per group of ``keys`` (all rows without keys)."""
    groups = binned(df, *keys, col).groupBy(*keys, "__bin").agg(*part_sums())
    return groups.groupBy(*keys).agg(held()).select(*keys, value().alias(out))
