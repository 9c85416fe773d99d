"""Column-level building blocks (all JVM-side built-ins, so they stay in codegen)."""

from starloom.functions.calendar import date_key, day_name, is_weekend, month_name, week_of_year_monday
from starloom.functions.hashing import record_hash

__all__ = ["date_key", "day_name", "is_weekend", "month_name", "record_hash", "week_of_year_monday"]
