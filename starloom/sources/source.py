"""The operational source: eight named tables in the source schema.

| table          | columns read by the loads                                              |
| -------------- | ---------------------------------------------------------------------- |
| customers      | CustomerID, CompanyName, ContactName, ContactTitle, Address, City,     |
|                | Region, PostalCode, Country, Phone, Fax                                |
| products       | ProductID, ProductName, SupplierID, CategoryID, QuantityPerUnit,       |
|                | UnitPrice, UnitsInStock, UnitsOnOrder, ReorderLevel, Discontinued      |
| categories     | CategoryID, CategoryName                                               |
| suppliers      | SupplierID, CompanyName, Country                                       |
| employees      | EmployeeID, FirstName, LastName, Title, City, Region, Country,         |
|                | HireDate, BirthDate                                                    |
| shippers       | ShipperID, CompanyName, Phone                                          |
| orders         | OrderID, CustomerID, EmployeeID, ShipVia, OrderDate, RequiredDate,     |
|                | ShippedDate, Freight                                                   |
| order_details  | OrderID, ProductID, UnitPrice, Quantity, Discount                      |

A sales-line column may sit on the header or on the line (e.g. a per-line
ship date); staging resolves each on whichever side carries it.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession

# Primary keys of the source tables (used by guarded inserts and PK checks).
SOURCE_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("CustomerID",),
    "products": ("ProductID",),
    "categories": ("CategoryID",),
    "suppliers": ("SupplierID",),
    "employees": ("EmployeeID",),
    "shippers": ("ShipperID",),
    "orders": ("OrderID",),
    "order_details": ("OrderID", "ProductID"),
}

# Display names of the source tables.
SOURCE_LABELS: dict[str, str] = {
    "customers": "Customers",
    "products": "Products",
    "categories": "Categories",
    "suppliers": "Suppliers",
    "employees": "Employees",
    "shippers": "Shippers",
    "orders": "Orders",
    "order_details": "Order Details",
}


@dataclass(frozen=True)
class Source:
    customers: DataFrame
    products: DataFrame
    categories: DataFrame
    suppliers: DataFrame
    employees: DataFrame
    shippers: DataFrame
    orders: DataFrame
    order_details: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def with_tables(self, **tables: DataFrame) -> Source:
        return replace(self, **tables)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: dict[str, str] | None = None) -> Source:
        """One parquet dataset per table: ``<root>/<name>`` (override via ``names``)."""
        names = names or {}
        return cls(**{t: spark.read.parquet(f"{root}/{names.get(t, t)}") for t in SOURCE_KEYS})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str]) -> Source:
        """Tables registered in the session catalog (``spark.table``)."""
        return cls(**{t: spark.table(names[t]) for t in SOURCE_KEYS})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        names: dict[str, str],
        properties: dict[str, str] | None = None,
        partitioning: dict[str, tuple[str, int, int, int]] | None = None,
    ) -> Source:
        """Operational database over JDBC; ``partitioning[table] = (column,
        lower, upper, num_partitions)`` splits a big table into parallel reads."""
        props = properties or {}
        out = {}
        for t in SOURCE_KEYS:
            part = (partitioning or {}).get(t)
            if part:
                col, lo, hi, n = part
                out[t] = spark.read.jdbc(
                    url, names[t], column=col, lowerBound=lo, upperBound=hi, numPartitions=n, properties=props
                )
            else:
                out[t] = spark.read.jdbc(url, names[t], properties=props)
        return cls(**out)
