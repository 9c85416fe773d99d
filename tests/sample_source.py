"""A small invented source - a wholesaler of bicycle parts - and a later state
of it. Tests derive what they expect from the values written down here."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.changes import Update, simulate_changes
from starloom.sources.source import Source

TS = dt.datetime(2024, 1, 1)
EFF = dt.date(2023, 3, 15)

CUSTOMERS = "CustomerID string, CompanyName string, ContactName string, ContactTitle string, Address string, City string, Region string, PostalCode string, Country string, Phone string, Fax string"
PRODUCTS = "ProductID long, ProductName string, SupplierID long, CategoryID long, QuantityPerUnit string, UnitPrice double, UnitsInStock long, UnitsOnOrder long, ReorderLevel long, Discontinued int"
ORDERS = "OrderID long, CustomerID string, EmployeeID long, OrderDate timestamp, RequiredDate timestamp, ShippedDate timestamp, ShipVia long, Freight double"
DETAILS = "OrderID long, ProductID long, UnitPrice double, Quantity int, Discount double"


def at(day):
    return dt.datetime.fromisoformat(day) if day else None


# order id -> customer, employee, placed, wanted, shipped, shipper, freight; lines: product -> price, quantity, discount
OLD_ORDERS = {
    41: (("WHEEL", 7, "2021-02-11", "2021-02-25", "2021-02-13", 31, 18.4), {10: (3.25, 40, 0.0), 20: (61.0, 2, 0.15), 30: (7.5, 12, 0.0)}),
    42: (("CHAIN", 8, "2022-06-03", "2022-06-30", "2022-06-21", 32, 6.6), {20: (63.5, 1, 0.0), 30: (7.75, 100, 0.25)}),
    43: (("WHEEL", 99, "2022-11-30", "2022-12-24", None, 39, 4.0), {10: (3.4, 8, 1.0)}),  # nothing to pay: no share of freight
}
NEW_ORDERS = {
    57: (("WHEEL", 7, "2023-04-02", "2023-04-20", "2023-04-04", 31, 27.3), {10: (3.6, 25, 0.2), 77: (128.0, 4, 0.0)}),
    58: (("PEDAL", 8, "2023-05-17", "2023-06-01", None, 32, 12.9), {77: (126.5, 6, 0.05)}),
    59: (("PEDAL", 8, "2023-01-09", "2023-02-01", None, 32, 2.2), {20: (63.5, 2, 0.0)}),  # placed before its customer's first version
}


def net(line):
    price, quantity, discount = line
    return quantity * price * (1 - discount)


def share(orders, order, product):
    """Freight of one line: the order's, by net value."""
    head, lines = orders[order]
    total = sum(net(x) for x in lines.values())
    return head[-1] * net(lines[product]) / total if total else 0.0


def _orders(spark, orders):
    return spark.createDataFrame([(o, c, e, at(a), at(b), at(s), via, f) for o, ((c, e, a, b, s, via, f), _) in orders.items()], ORDERS)


def _details(spark, orders):
    return spark.createDataFrame([(o, p, price, q, d) for o, (_, lines) in orders.items() for p, (price, q, d) in lines.items()], DETAILS)


def base_source(spark):
    return Source(
        customers=spark.createDataFrame(
            [
                ("WHEEL", "Round Trip Cycles", "Noor Haddad", "Workshop lead", "14 Canal Walk", "Utrecht", None, "3511 AB", "Netherlands", "+31 30 11", None),
                ("CHAIN", "Link & Sprocket", "Piet Vos", "Owner", "3 Hill Lane", "Leeds", "Yorkshire", "LS1 4", "United Kingdom", "+44 113 2", "+44 113 3"),
            ],
            CUSTOMERS,
        ),
        products=spark.createDataFrame(
            [
                (10, "Spoke nipple", 4, 2, "bag of 50", 3.4, 900, 0, 200, 0),
                (20, "Front fork", 5, 3, "1 piece", 63.5, 14, 6, 4, 0),
                (30, "Bar tape", 4, 2, "pair", 7.75, 61, 0, 20, 1),
            ],
            PRODUCTS,
        ),
        categories=spark.createDataFrame([(2, "Small parts"), (3, "Frames and forks")], "CategoryID long, CategoryName string"),
        suppliers=spark.createDataFrame([(4, "Northmill", "Sweden"), (5, "Forkworks", "Taiwan")], "SupplierID long, CompanyName string, Country string"),
        employees=spark.createDataFrame(
            [
                (7, "Ida", "Solberg", "Account manager", "Oslo", None, "Norway", at("2015-09-01 07:45:00"), at("1988-04-23")),
                (8, "Rui", "Matos", "Account manager", "Porto", None, "Portugal", at("2019-01-14"), None),
            ],
            "EmployeeID long, FirstName string, LastName string, Title string, City string, Region string, Country string, HireDate timestamp, BirthDate timestamp",
        ),
        shippers=spark.createDataFrame([(31, "Cargo Bikes Co", "555-31"), (32, "Railbox", "555-32")], "ShipperID long, CompanyName string, Phone string"),
        orders=_orders(spark, OLD_ORDERS),
        order_details=_details(spark, OLD_ORDERS),
    )


def changed_source(spark, src):
    """A customer moves and a price rises; a customer, a product and three orders are new."""
    return simulate_changes(
        src,
        inserts={
            "customers": spark.createDataFrame([("PEDAL", "Pedal Pushers", "Ana Brito", "Buyer", "8 Dock Road", "Faro", None, "8000", "Portugal", "+351 289", None)], CUSTOMERS),
            "products": spark.createDataFrame([(77, "Crank set", 5, 3, "1 set", 128.0, 22, 0, 5, 0)], PRODUCTS),
            "orders": _orders(spark, NEW_ORDERS),
            "order_details": _details(spark, NEW_ORDERS),
        },
        updates=[
            Update("customers", F.col("CustomerID") == "WHEEL", {"City": F.lit("Amersfoort"), "Phone": F.lit("+31 33 7")}),
            Update("products", F.col("ProductID") == 10, {"UnitPrice": F.lit(3.6)}),
        ],
    )
