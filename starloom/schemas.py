"""Typed schemas of the warehouse (control + star) and the dimension specs.

The column lists, types and unknown-member values below are fixed by the
warehouse contract the library reproduces; they are data, not logic.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the warehouse contract
# ---------------------------------------------------------------------------
OPEN_START = _dt.date(1900, 1, 1)  # validity start of initial versions / unknown date
OPEN_END = _dt.date(9999, 12, 31)  # validity end of current versions
UNKNOWN_SK = 0  # surrogate key of every unknown member
HASH_SEPARATOR = "|"  # separator of the attribute string fed to md5
DATE_PAD_DAYS = 365  # calendar runs until max(order date) + this many days
FULL_NOTE = "Full historical load completed"
INCREMENTAL_NOTE = "Incremental load completed (SCD2 + new fact rows)"
WATERMARK_ENTITY = "orders"

S, L, I, D, B, DT, TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
)


def project_to(df, schema: T.StructType):
    """``df`` with exactly ``schema``'s columns, in order, cast to its types.

    Built as one ``selectExpr`` (parsed JVM-side in a single call) rather than
    one Column object per column; the casts are the same Cast expressions."""
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def _schema(*cols: tuple[str, T.DataType], not_null: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in not_null) for n, t in cols])


# --- control -----------------------------------------------------------------
WATERMARK = _schema(("entity", S), ("last_order_id", L), ("updated_at", TS), not_null=("entity",))
SURROGATE_KEY_SEQ = _schema(("dim_name", S), ("next_sk", L), not_null=("dim_name",))
ETL_RUN_LOG = _schema(
    ("run_id", L),
    ("run_ts", TS),
    ("run_type", S),
    ("effective_date", DT),
    ("rows_dim_customer", L),
    ("rows_dim_product", L),
    ("rows_fact_sales", L),
    ("notes", S),
)

# --- dimensions ----------------------------------------------------------------
DIM_DATE = _schema(
    ("date_sk", I),
    ("date", DT),
    ("year", I),
    ("month", I),
    ("day", I),
    ("month_name", S),
    ("day_name", S),
    ("week_of_year", I),
    ("quarter", I),
    ("is_weekend", B),
    not_null=("date_sk",),
)

SCD2_COLUMNS = (("effective_from", DT), ("effective_to", DT), ("is_current", B))

DIM_CUSTOMER = _schema(
    ("customer_sk", L),
    ("customer_id", S),
    ("company_name", S),
    ("contact_name", S),
    ("contact_title", S),
    ("address", S),
    ("city", S),
    ("region", S),
    ("postal_code", S),
    ("country", S),
    ("phone", S),
    ("fax", S),
    *SCD2_COLUMNS,
    ("record_hash", S),
    not_null=("customer_sk",),
)

DIM_PRODUCT = _schema(
    ("product_sk", L),
    ("product_id", L),
    ("product_name", S),
    ("quantity_per_unit", S),
    ("list_unit_price", D),
    ("units_in_stock", L),
    ("units_on_order", L),
    ("reorder_level", L),
    ("discontinued", B),
    ("category_id", L),
    ("category_name", S),
    ("supplier_id", L),
    ("supplier_name", S),
    ("supplier_country", S),
    *SCD2_COLUMNS,
    ("record_hash", S),
    not_null=("product_sk",),
)

DIM_EMPLOYEE = _schema(
    ("employee_sk", L),
    ("employee_id", L),
    ("first_name", S),
    ("last_name", S),
    ("title", S),
    ("city", S),
    ("region", S),
    ("country", S),
    ("hire_date", DT),
    ("birth_date", DT),
    ("record_hash", S),
    not_null=("employee_sk",),
)

DIM_SHIPPER = _schema(
    ("shipper_sk", L),
    ("shipper_id", L),
    ("company_name", S),
    ("phone", S),
    ("record_hash", S),
    not_null=("shipper_sk",),
)

FACT_SALES_LINE = _schema(
    ("order_id", L),
    ("product_id", L),
    ("line_number", L),
    ("customer_sk", L),
    ("product_sk", L),
    ("employee_sk", L),
    ("shipper_sk", L),
    ("order_date_sk", I),
    ("required_date_sk", I),
    ("shipped_date_sk", I),
    ("quantity", L),
    ("unit_price", D),
    ("discount", D),
    ("gross_amount", D),
    ("net_amount", D),
    ("order_freight", D),
    ("freight_allocated", D),
    ("etl_loaded_at", TS),
    not_null=("order_id", "product_id"),
)
FACT_KEY = ("order_id", "product_id")


@dataclass(frozen=True, eq=False)
class DimensionSpec:
    """Everything the generic SCD operators need to know about one dimension."""

    name: str  # short name, also the key in the surrogate-key sequence
    table: str  # warehouse table name
    schema: T.StructType
    sk: str
    bk: str
    kind: str  # "scd2" | "scd1"
    unknown: dict = field(default_factory=dict)  # non-NULL values of the unknown member

    @property
    def attributes(self) -> list[str]:
        """Tracked attribute columns (everything but keys, validity and hash)."""
        skip = {self.sk, self.bk, "record_hash", "effective_from", "effective_to", "is_current"}
        return [f.name for f in self.schema.fields if f.name not in skip]

    @property
    def staged_columns(self) -> list[str]:
        """Columns of the staged source frame: business key, attributes, hash."""
        return [self.bk, *self.attributes, "record_hash"]


# Unknown-member values (fixed by the warehouse contract; every other column is NULL).
CUSTOMER = DimensionSpec(
    "customer",
    "dim_customer",
    DIM_CUSTOMER,
    "customer_sk",
    "customer_id",
    "scd2",
    {"customer_sk": 0, "customer_id": "UNKNOWN", "company_name": "Unknown"},
)
PRODUCT = DimensionSpec(
    "product",
    "dim_product",
    DIM_PRODUCT,
    "product_sk",
    "product_id",
    "scd2",
    {"product_sk": 0, "product_id": -1, "product_name": "Unknown"},
)
EMPLOYEE = DimensionSpec(
    "employee",
    "dim_employee",
    DIM_EMPLOYEE,
    "employee_sk",
    "employee_id",
    "scd1",
    {"employee_sk": 0, "employee_id": -1, "first_name": "Unknown", "last_name": "Unknown"},
)
SHIPPER = DimensionSpec(
    "shipper",
    "dim_shipper",
    DIM_SHIPPER,
    "shipper_sk",
    "shipper_id",
    "scd1",
    {"shipper_sk": 0, "shipper_id": -1, "company_name": "Unknown"},
)
DIMENSIONS = (CUSTOMER, PRODUCT, EMPLOYEE, SHIPPER)
UNKNOWN_DATE = {"date_sk": 0, "date": OPEN_START, "month_name": "Unknown", "day_name": "Unknown"}

WAREHOUSE_TABLES: dict[str, T.StructType] = {
    "watermark": WATERMARK,
    "surrogate_key_seq": SURROGATE_KEY_SEQ,
    "etl_run_log": ETL_RUN_LOG,
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_employee": DIM_EMPLOYEE,
    "dim_shipper": DIM_SHIPPER,
    "fact_sales_line": FACT_SALES_LINE,
}
