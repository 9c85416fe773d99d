"""Staging: rename source columns to warehouse names, cast, and hash.

The inputs follow the operational source schema (Customers, Products,
Categories, Suppliers, Employees, Shippers, Orders, "Order Details"); see
``starloom.sources.source``. Every function is a single projection (plus two
lookup joins for products), so Catalyst prunes the scan to the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import record_hash


def _project(df: DataFrame, mapping: list[tuple[str, str]], hash_cols: list[str]) -> DataFrame:
    """``SELECT <expr> AS <target>, ..., md5(...) AS record_hash`` as one
    ``selectExpr`` (parsed JVM-side in a single call)."""
    exprs = [f"{expr} AS `{target}`" for target, expr in mapping]
    return df.select(*[F.expr(e) for e in exprs], record_hash(hash_cols).alias("record_hash"))


def _varchar(c: str) -> str:
    return f"CAST(`{c}` AS STRING)"


# Source columns hashed for change detection, in hash order (fixed contract).
CUSTOMER_HASH = [
    "CustomerID",
    "CompanyName",
    "ContactName",
    "ContactTitle",
    "Address",
    "City",
    "Region",
    "PostalCode",
    "Country",
    "Phone",
    "Fax",
]
PRODUCT_HASH = [
    "ProductID",
    "ProductName",
    "QuantityPerUnit",
    "UnitPrice",
    "UnitsInStock",
    "UnitsOnOrder",
    "ReorderLevel",
    "Discontinued",
    "CategoryID",
    "CategoryName",
    "SupplierID",
    "SupplierCompanyName",
    "SupplierCountry",
]
EMPLOYEE_HASH = [
    "EmployeeID",
    "FirstName",
    "LastName",
    "Title",
    "City",
    "Region",
    "Country",
    "HireDate",
    "BirthDate",
]
SHIPPER_HASH = ["ShipperID", "CompanyName", "Phone"]


def stage_customer(customers: DataFrame, hash_cols: list[str] = CUSTOMER_HASH) -> DataFrame:
    return _project(
        customers,
        [
            ("customer_id", _varchar("CustomerID")),
            ("company_name", _varchar("CompanyName")),
            ("contact_name", _varchar("ContactName")),
            ("contact_title", _varchar("ContactTitle")),
            ("address", _varchar("Address")),
            ("city", _varchar("City")),
            ("region", _varchar("Region")),
            ("postal_code", _varchar("PostalCode")),
            ("country", _varchar("Country")),
            ("phone", _varchar("Phone")),
            ("fax", _varchar("Fax")),
        ],
        hash_cols,
    )


def stage_product(
    products: DataFrame,
    categories: DataFrame,
    suppliers: DataFrame,
    hash_cols: list[str] = PRODUCT_HASH,
) -> DataFrame:
    """Products denormalised with their category and supplier (left lookups,
    so a product with a dangling reference is kept with NULL attributes)."""
    c = categories.select(
        F.col("CategoryID").alias("CategoryID_c"),
        F.col("CategoryID").alias("CategoryID"),
        F.col("CategoryName"),
    )
    s = suppliers.select(
        F.col("SupplierID").alias("SupplierID_s"),
        F.col("SupplierID").alias("SupplierID"),
        F.col("CompanyName").alias("SupplierCompanyName"),
        F.col("Country").alias("SupplierCountry"),
    )
    p = products.drop("CategoryName", "SupplierCompanyName", "SupplierCountry").withColumnsRenamed(
        {"CategoryID": "p_CategoryID", "SupplierID": "p_SupplierID"}
    )
    j = p.join(c, F.col("p_CategoryID") == F.col("CategoryID_c"), "left").join(
        s, F.col("p_SupplierID") == F.col("SupplierID_s"), "left"
    )
    return _project(
        j,
        [
            ("product_id", "CAST(`ProductID` AS BIGINT)"),
            ("product_name", _varchar("ProductName")),
            ("quantity_per_unit", _varchar("QuantityPerUnit")),
            ("list_unit_price", "CAST(`UnitPrice` AS DOUBLE)"),
            ("units_in_stock", "CAST(`UnitsInStock` AS BIGINT)"),
            ("units_on_order", "CAST(`UnitsOnOrder` AS BIGINT)"),
            ("reorder_level", "CAST(`ReorderLevel` AS BIGINT)"),
            ("discontinued", "(`Discontinued` = 1)"),
            ("category_id", "CAST(`CategoryID` AS BIGINT)"),
            ("category_name", _varchar("CategoryName")),
            ("supplier_id", "CAST(`SupplierID` AS BIGINT)"),
            ("supplier_name", _varchar("SupplierCompanyName")),
            ("supplier_country", _varchar("SupplierCountry")),
        ],
        hash_cols,
    )


def stage_employee(employees: DataFrame, hash_cols: list[str] = EMPLOYEE_HASH) -> DataFrame:
    return _project(
        employees,
        [
            ("employee_id", "CAST(`EmployeeID` AS BIGINT)"),
            ("first_name", _varchar("FirstName")),
            ("last_name", _varchar("LastName")),
            ("title", _varchar("Title")),
            ("city", _varchar("City")),
            ("region", _varchar("Region")),
            ("country", _varchar("Country")),
            ("hire_date", "to_date(`HireDate`)"),
            ("birth_date", "to_date(`BirthDate`)"),
        ],
        hash_cols,
    )


def stage_shipper(shippers: DataFrame, hash_cols: list[str] = SHIPPER_HASH) -> DataFrame:
    return _project(
        shippers,
        [
            ("shipper_id", "CAST(`ShipperID` AS BIGINT)"),
            ("company_name", _varchar("CompanyName")),
            ("phone", _varchar("Phone")),
        ],
        hash_cols,
    )


# --- sales lines ---------------------------------------------------------------
# Column contract of a staged sales line: warehouse name -> (source column, cast).
# The source column may live on the order header or on the order line; the
# staging join resolves each name on whichever side carries it.
SALES_LINE_COLUMNS = [
    ("order_id", "OrderID", "long"),
    ("product_id", "ProductID", "long"),
    ("customer_id", "CustomerID", "string"),
    ("employee_id", "EmployeeID", "long"),
    ("ship_via", "ShipVia", "long"),
    ("order_date", "OrderDate", "date"),
    ("required_date", "RequiredDate", "date"),
    ("shipped_date", "ShippedDate", "date"),
    ("freight", "Freight", "double"),
    ("quantity", "Quantity", "long"),
    ("unit_price", "UnitPrice", "double"),
    ("discount", "Discount", "double"),
]


def _cast(c: str, t: str) -> str:
    return f"to_date(`{c}`)" if t == "date" else f"CAST(`{c}` AS {t})"


def stage_order_header(orders: DataFrame) -> DataFrame:
    """Header-level part of the sales-line contract (columns present on orders)."""
    have = set(orders.columns)
    return orders.selectExpr(*[f"{_cast(src, t)} AS `{dst}`" for dst, src, t in SALES_LINE_COLUMNS if src in have])


def stage_order_lines(lines: DataFrame, header_columns: list[str]) -> DataFrame:
    """Line-level part: the line's own columns that the header does not carry."""
    have = set(lines.columns)
    keep = [
        f"{_cast(src, t)} AS `{dst}`"
        for dst, src, t in SALES_LINE_COLUMNS
        if src in have and (dst not in header_columns or dst == "order_id")
    ]
    return lines.selectExpr(*keep)


def stage_sales_lines(orders: DataFrame, lines: DataFrame, min_order_id_exclusive: int | None = None) -> DataFrame:
    """Header inner-join lines on the order id, projected to the contract.

    ``min_order_id_exclusive`` is the high-water-mark filter: the literal is
    applied to both inputs so it reaches both parquet scans as a pushed filter.
    """
    header = stage_order_header(orders)
    body = stage_order_lines(lines, header.columns)
    if min_order_id_exclusive is not None:
        header = header.where(F.col("order_id") > F.lit(min_order_id_exclusive))
        body = body.where(F.col("order_id") > F.lit(min_order_id_exclusive))
    joined = body.join(header, "order_id", "inner")
    return joined.select(*[dst for dst, _, _ in SALES_LINE_COLUMNS])
