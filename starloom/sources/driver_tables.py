"""Stand-in source built from the driver's TPC-H-like test tables.

This module only reshapes rows into the source schema of
``starloom.sources.source``; it does none of the warehouse's work (no hashing,
no keys, no history). Role mapping:

| source role     | built from                                                             |
| --------------- | ---------------------------------------------------------------------- |
| Customers       | customer + nation + region; CustomerID = text of c_custkey,            |
|                 | CompanyName = c_name, ContactTitle = c_mktsegment, Region = r_name,    |
|                 | Country = n_name; ContactName, Address, City, PostalCode, Phone from   |
|                 | segment, key and nation; Fax = c_acctbal as text, NULL below 0         |
| Categories      | distinct p_type, id = position in p_type order                         |
| Suppliers       | distinct p_brand, id = the number after '#'; Country = the nation of   |
|                 | that number modulo 25                                                  |
| Products        | part; UnitPrice = p_retailprice as DECIMAL(18,2), UnitsInStock = p_size|
|                 | and from it QuantityPerUnit, UnitsOnOrder, ReorderLevel, Discontinued  |
| Employees       | supplier + nation + region; EmployeeID = s_suppkey, FirstName = s_name,|
|                 | Title by s_acctbal, HireDate and BirthDate by s_suppkey (some NULL)    |
| Shippers        | distinct o_orderpriority; id = leading digit, name = text after '-'    |
| Orders          | orders; RequiredDate = order date + 28 days, Freight = o_totalprice,   |
|                 | ShipVia = priority digit                                               |
| Order Details   | lineitem at the (order, part) grain; UnitPrice = extended price /      |
|                 | quantity; per line: EmployeeID = l_suppkey, ShippedDate = l_shipdate   |
|                 | when l_linestatus = 'F' else NULL                                      |

``scenario`` derives the snapshots of the incremental tests: ``t0`` (an
earlier state: some members not yet created, the latest orders not yet
placed), ``t1`` = ``simulate_changes(t0, ...)`` with guarded inserts of
everything else and rule-based attribute changes, and ``t2`` = ``t1`` with a
second change to some customers (loaded with the same effective date). All
snapshots hold whole tables; the rules only decide *which* members are new or
changed - the loads find them by hash comparison.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.changes import Update, simulate_changes
from starloom.operators.keys import assign_surrogate_keys
from starloom.parallel import run_parallel
from starloom.sources.source import Source

# Fixed parameters of the change scenario.
REQUIRED_DAYS = 28  # required date = order date + 28 days
T0_HOLDOUT_MOD, T0_HOLDOUT_REM = 10, 9  # members with key % 10 = 9 appear only in t1
T0_ORDER_FRACTION = (8, 10)  # t0 holds orders up to max(o_orderkey) * 8 // 10
RELOCATE_MOD = 7  # t1: customers with key % 7 = 0 get ContactTitle 'RELOCATED'
RELOCATED = "RELOCATED"
REPRICE_MOD, REPRICE_DELTA = 11, 20  # t1: products with key % 11 = 0 cost 20 more
RENAME_MOD, RENAME_SUFFIX = 4, " *"  # t1: employees with key % 4 = 0 get a suffix
SHIPPER_RENAMED_ID, SHIPPER_NEW_NAME = 1, "URGENT EXPRESS"  # t1: shipper 1 renamed
SHIPPER_HELD_OUT_ID = 5  # shipper 5 appears only in t1
RELOCATE_AGAIN_MOD, RELOCATED_AGAIN = 14, "RELOCATED AGAIN"  # t2: customers with key % 14 = 0 move again
EFFECTIVE_DATE_ISO = "2000-01-01"  # effective date of the t1 run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, geo = read_table(spark, sf_dir, "customer"), _places(spark, sf_dir)
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").selectExpr(
        "CAST(c_custkey AS STRING) AS CustomerID",
        "c_name AS CompanyName",
        "c_mktsegment || ' desk' AS ContactName",
        "c_mktsegment AS ContactTitle",
        "'No. ' || c_custkey || ', ' || n_name AS Address",
        "n_name || '-' || (c_custkey % 7) AS City",
        "r_name AS Region",
        "lpad(CAST(c_custkey AS STRING), 8, '0') AS PostalCode",
        "n_name AS Country",
        "(c_nationkey + 10) || '-' || lpad(CAST(c_custkey AS STRING), 7, '0') AS Phone",
        "CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) END AS Fax",
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part types numbered in type order."""
    types = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("CategoryName")).distinct()
    numbered, _ = assign_surrogate_keys(types, ["CategoryName"], 1, "CategoryID")
    return numbered.select("CategoryID", "CategoryName")


_BRAND = "CAST(substring_index(p_brand, '#', -1) AS BIGINT)"


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = read_table(spark, sf_dir, "part").select("p_brand").distinct()
    geo = _places(spark, sf_dir)
    return brands.join(geo, F.expr(f"{_BRAND} % 25 = n_nationkey"), "left").selectExpr(
        f"{_BRAND} AS SupplierID", "p_brand AS CompanyName", "n_name AS Country"
    )


def products(spark: SparkSession, sf_dir: str, cats: DataFrame) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.join(cats, p.p_type == cats.CategoryName, "left").selectExpr(
        "p_partkey AS ProductID",
        "p_name AS ProductName",
        f"{_BRAND} AS SupplierID",
        "CategoryID",
        "p_size || ' x ' || p_brand AS QuantityPerUnit",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice",
        "CAST(p_size AS BIGINT) AS UnitsInStock",
        "CASE WHEN p_size % 3 = 0 THEN CAST(2 * p_size AS BIGINT) END AS UnitsOnOrder",
        "CAST(p_size % 10 AS BIGINT) AS ReorderLevel",
        "CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS Discontinued",
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, geo = read_table(spark, sf_dir, "supplier"), _places(spark, sf_dir)
    born = "TIMESTAMP '1960-01-01 00:00:00' + make_interval(0, 0, 0, CAST(s_suppkey * 37 % 9000 AS INT))"
    return s.join(geo, s.s_nationkey == geo.n_nationkey, "left").selectExpr(
        "s_suppkey AS EmployeeID",
        "s_name AS FirstName",
        "substring_index(s_name, '#', -1) AS LastName",
        "CASE WHEN s_acctbal >= 5000 THEN 'Senior' ELSE 'Junior' END AS Title",
        "n_name AS City",
        "r_name AS Region",
        "n_name AS Country",
        "TIMESTAMP '1990-01-01 08:30:00' + make_interval(0, 0, 0, CAST(s_suppkey % 3000 AS INT)) AS HireDate",
        f"CASE WHEN s_suppkey % 6 <> 5 THEN {born} END AS BirthDate",
    )


def _priority_digit(col: str = "o_orderpriority"):
    return F.substring(F.col(col), 1, 1).cast("long")


def shippers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pr = read_table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return pr.select(
        _priority_digit().alias("ShipperID"),
        F.substring_index(F.col("o_orderpriority"), "-", -1).alias("CompanyName"),
        F.concat(F.lit("800-"), F.substring("o_orderpriority", 1, 1)).alias("Phone"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        _priority_digit().alias("ShipVia"),
        F.col("o_orderdate").alias("OrderDate"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {REQUIRED_DAYS} DAYS")).alias("RequiredDate"),
        F.col("o_totalprice").alias("Freight"),
    )


_LINE_ORDER = [
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, part): the first duplicate in ``_LINE_ORDER`` order.

    A ``min(struct)`` aggregate instead of a window: partial aggregation runs
    map-side, so a key with many duplicates never lands whole in one task."""
    li = read_table(spark, sf_dir, "lineitem")
    first = li.groupBy("l_orderkey", "l_partkey").agg(F.min(F.struct(*_LINE_ORDER)).alias("l"))
    return first.select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l.l_suppkey").alias("EmployeeID"),
        F.when(F.col("l.l_linestatus") == "F", F.col("l.l_shipdate")).alias("ShippedDate"),
        (F.col("l.l_extendedprice") / F.col("l.l_quantity")).alias("UnitPrice"),
        F.col("l.l_quantity").cast("int").alias("Quantity"),
        F.col("l.l_discount").alias("Discount"),
    )


def driver_source(spark: SparkSession, sf_dir: str) -> Source:
    """All driver rows as one source snapshot."""
    cats = categories(spark, sf_dir)
    return Source(
        customers=customers(spark, sf_dir),
        products=products(spark, sf_dir, cats),
        categories=cats,
        suppliers=suppliers(spark, sf_dir),
        employees=employees(spark, sf_dir),
        shippers=shippers(spark, sf_dir),
        orders=orders(spark, sf_dir),
        order_details=order_details(spark, sf_dir),
    )


def materialize(src: Source, path: str) -> Source:
    """Write every table once as parquet (concurrent jobs) and return the
    source reading them back: loads then scan plain tables, as they would in
    production, instead of re-deriving the stand-in rows in every Spark job."""
    run_parallel({n: lambda n=n, df=df: df.write.mode("overwrite").parquet(f"{path}/{n}", compression="zstd") for n, df in src.tables().items()})
    return Source.from_parquet(src.customers.sparkSession, path)


@dataclass(frozen=True)
class Scenario:
    full: Source  # every row of the test tables
    t0: Source
    t1: Source
    t1_by_inserts: Source  # the rows of t1, as t0 after guarded inserts of what it lacks
    effective_date_iso: str
    order_cut: int

    @property
    def t2(self) -> Source:
        """t1 plus a second change to some customers, to be loaded with the
        *same* effective date as t1 (the case that leaves a version whose end
        precedes its start)."""
        return simulate_changes(
            self.t1,
            updates=[
                Update(
                    "customers",
                    _number("CustomerID") % RELOCATE_AGAIN_MOD == 0,
                    {"ContactTitle": F.lit(RELOCATED_AGAIN)},
                )
            ],
        )


def _number(col: str):
    """A key as a number; NULL for text, as the optimizer may move the rule to other keys joined to it."""
    return F.col(col).try_cast("long")


def _early(col: str):
    """Members that are there from the start."""
    return (_number(col) % T0_HOLDOUT_MOD) != T0_HOLDOUT_REM


def scenario(spark: SparkSession, sf_dir: str, workdir: str | None = None) -> Scenario:
    """The t0/t1 snapshots; with ``workdir`` the stand-in source is written
    there once, and both snapshots are views over that copy."""
    full = driver_source(spark, sf_dir)
    if workdir:
        full = materialize(full, workdir)
    max_key = read_table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("m")).first()["m"] or 0
    num, den = T0_ORDER_FRACTION
    cut = (max_key * num) // den
    early = {
        "customers": _early("CustomerID"),
        "products": _early("ProductID"),
        "employees": _early("EmployeeID"),
        "shippers": F.col("ShipperID") != SHIPPER_HELD_OUT_ID,
        "orders": F.col("OrderID") <= cut,
        "order_details": F.col("OrderID") <= cut,
    }
    tables = full.tables()
    t0 = full.with_tables(**{name: tables[name].where(c) for name, c in early.items()})
    updates = [
        Update("customers", _number("CustomerID") % RELOCATE_MOD == 0, {"ContactTitle": F.lit(RELOCATED)}),
        Update("products", F.col("ProductID") % REPRICE_MOD == 0, {"UnitPrice": F.col("UnitPrice") + F.lit(REPRICE_DELTA)}),
        Update("employees", F.col("EmployeeID") % RENAME_MOD == 0, {"FirstName": F.concat(F.col("FirstName"), F.lit(RENAME_SUFFIX))}),
        Update("shippers", F.col("ShipperID") == SHIPPER_RENAMED_ID, {"CompanyName": F.lit(SHIPPER_NEW_NAME)}),
    ]
    t1 = simulate_changes(full, updates=updates)
    inserted = simulate_changes(t0, inserts={name: tables[name].where(~c) for name, c in early.items()}, updates=updates)
    return Scenario(full, t0, t1, inserted, EFFECTIVE_DATE_ISO, cut)
