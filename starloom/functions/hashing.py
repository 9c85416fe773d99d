"""Change-detection hash over a list of attribute columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.schemas import HASH_SEPARATOR


def record_hash(cols: Iterable[str | Column], sep: str = HASH_SEPARATOR) -> Column:
    """md5 (32 lowercase hex chars) of the separator-joined attribute text.

    Every input is cast to text and NULL becomes the empty string *before*
    joining, so NULL and '' hash alike and no position is ever skipped
    (``concat_ws`` alone would drop NULL inputs and shift the positions).
    Numbers are hashed through their text form: hash money as DECIMAL, not as
    DOUBLE, because engines print large doubles differently.
    """
    cols = list(cols)
    if not cols:
        raise ValueError("record_hash needs at least one column")
    if all(isinstance(c, str) for c in cols):  # one SQL expression: a single call to build
        quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
        inner = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '')" for c in cols)
        return F.expr(f"md5(concat_ws('{quoted}', {inner}))")
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))
