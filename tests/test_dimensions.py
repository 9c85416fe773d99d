import datetime as dt

from starloom.operators.dimensions import build_dim_date, unknown_member
from starloom.schemas import CUSTOMER, EMPLOYEE, PRODUCT, SHIPPER


def test_unknown_members(spark):
    c = unknown_member(spark, CUSTOMER).first()
    assert (c.customer_sk, c.customer_id, c.company_name, c.city, c.record_hash) == (0, "UNKNOWN", "Unknown", None, None)
    assert (c.effective_from, c.effective_to, c.is_current) == (dt.date(1900, 1, 1), dt.date(9999, 12, 31), True)
    p = unknown_member(spark, PRODUCT).first()
    assert (p.product_sk, p.product_id, p.product_name, p.is_current) == (0, -1, "Unknown", True)
    e = unknown_member(spark, EMPLOYEE).first()
    assert len(e) == 11 and (e.employee_sk, e.employee_id, e.first_name, e.last_name, e.record_hash) == (0, -1, "Unknown", "Unknown", None)
    s = unknown_member(spark, SHIPPER).first()
    assert (s.shipper_sk, s.shipper_id, s.company_name, s.phone) == (0, -1, "Unknown", None)


def test_calendar_range_and_unknown_row(spark):
    orders = spark.createDataFrame(
        [(dt.datetime(1996, 7, 4, 10, 0),), (dt.datetime(1996, 7, 6, 0, 0),)], "OrderDate timestamp"
    )
    days = {r.date_sk: r for r in build_dim_date(orders).collect()}
    assert len(days) == 1 + 3 + 365  # unknown row + 3 order days + a year of padding
    assert days[0].date == dt.date(1900, 1, 1) and days[0].month_name == "Unknown" and days[0].year is None
    d = days[19960704]
    assert (d.year, d.month, d.day, d.quarter, d.month_name, d.day_name, d.is_weekend) == (1996, 7, 4, 3, "July", "Thursday", False)
    assert days[19960706].is_weekend and max(days) == 19970706
    empty = spark.createDataFrame([], "OrderDate timestamp")
    assert build_dim_date(empty).count() == 1
