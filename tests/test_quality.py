import datetime as dt
import itertools
import random

from starloom.operators import quality as Q
from starloom.schemas import CUSTOMER, DIM_CUSTOMER

D0 = dt.date(2000, 1, 1)


def _dim(spark, rows):
    """rows: (sk, bk, from_offset, to_offset, current)"""
    full = []
    for sk, bk, f, t, cur in rows:
        vals = {f.name: None for f in DIM_CUSTOMER.fields}
        vals.update(customer_sk=sk, customer_id=bk, effective_from=D0 + dt.timedelta(f), effective_to=D0 + dt.timedelta(t), is_current=cur)
        full.append(tuple(vals[f.name] for f in DIM_CUSTOMER.fields))
    return spark.createDataFrame(full, DIM_CUSTOMER)


def _pairwise(rows):
    bad = set()
    for a, b in itertools.permutations(rows, 2):
        if a[1] == b[1] and a[0] != b[0] and a[0] != 0 and b[0] != 0 and a[2] <= b[3] and b[2] <= a[3]:
            bad.add(a[1])
    return bad


def test_overlap_matches_pairwise_definition_including_inverted(spark):
    rnd = random.Random(11)
    rows, sk = [], 1
    for k in range(60):
        for _ in range(rnd.randrange(1, 6)):
            f = rnd.randrange(0, 40)
            t = f + rnd.randrange(-6, 12)  # some inverted intervals
            rows.append((sk, f"b{k}", f, t, False))
            sk += 1
    got = {r[0] for r in Q.check_overlap(_dim(spark, rows), CUSTOMER).collect()}
    assert got == _pairwise(rows)
    assert got  # the random data does contain overlaps


def test_overlap_ignores_chain_with_same_day_reopen(spark):
    # closed at eff-1, reopened and closed on the same effective date (inverted), current from eff
    rows = [(1, "A", -100, 9, False), (2, "A", 10, 9, False), (3, "A", 10, 99999, True)]
    assert Q.check_overlap(_dim(spark, rows), CUSTOMER).count() == 0
    assert [r.customer_sk for r in Q.check_interval(_dim(spark, rows), CUSTOMER).collect()] == [2]


def test_one_current_and_pk_check(spark):
    rows = [(0, "UNKNOWN", -10, 10, True), (1, "A", 0, 5, True), (2, "A", 6, 9, True), (3, "B", 0, 9, False)]
    dim = _dim(spark, rows)
    assert {(r.customer_id, r.current_rows) for r in Q.check_one_current(dim, CUSTOMER).collect()} == {("A", 2)}
    dup = _dim(spark, rows + [(3, "C", 0, 1, True)])
    r = Q.primary_key_check(dup, ["customer_sk"], "d").first()
    assert (r.rows, r.duplicate_keys) == (5, 1)


def test_unknown_audit_empty_fact_gives_nulls(spark):
    from starloom.schemas import FACT_SALES_LINE

    r = Q.unknown_audit(spark.createDataFrame([], FACT_SALES_LINE)).first()
    assert r.unknown_customer_rows is None


def test_star_query_attributes_sale_to_version(spark):
    dim = _dim(spark, [(0, "UNKNOWN", -10, 10, True), (1, "A", 0, 5, False), (2, "A", 6, 99, True)])
    dim = dim.withColumn("contact_title", dim.customer_sk.cast("string"))
    fact = spark.createDataFrame([(1, 10.0), (1, 5.0), (2, 1.0), (0, 2.0)], "customer_sk long, net_amount double")
    got = {r.attribute_value: (r.lines, float(r.net_sales)) for r in Q.as_of_star_query(fact, dim, "customer_sk", "contact_title").collect()}
    assert got == {"1": (2, 15.0), "2": (1, 1.0), "Unknown": (1, 2.0)}


def test_star_query_over_several_dimensions_and_roles(spark):
    dates = spark.createDataFrame([(0, None), (20230101, "January"), (20230201, "February")], "date_sk int, month_name string")
    dim = _dim(spark, [(0, "UNKNOWN", -10, 10, True), (1, "A", 0, 5, False), (2, "A", 6, 99, True)])
    dim = dim.withColumn("contact_title", dim.customer_id)
    rows = [(1, 20230101, 20230201, 0.1), (2, 20230101, 20230201, 0.2), (2, 20230201, 0, 5.0), (0, 20230101, 20230101, 7.0)]
    fact = spark.createDataFrame(rows, "customer_sk long, order_date_sk int, shipped_date_sk int, net_amount double")
    axes = [
        Q.Axis("order_date_sk", dates, "date_sk", {"placed": "month_name"}),
        Q.Axis("shipped_date_sk", dates, "date_sk", {"sent": "month_name"}),
        Q.Axis("customer_sk", dim, "customer_sk", {"segment": "contact_title"}),
    ]
    got = {(r.placed, r.sent, r.segment): (r.lines, r.net_sales) for r in Q.star_query(fact, axes).collect()}
    assert got == {("January", "February", "A"): (2, 0.30000000000000004), ("February", "Unknown", "A"): (1, 5.0), ("January", "January", "Unknown"): (1, 7.0)}


def test_reconcile_sees_amounts_below_four_decimals(spark):
    lines = spark.range(200_000).selectExpr("1 AS Quantity", "0.00004D AS UnitPrice", "0D AS Discount", "0.00004D AS net_amount")
    r = Q.reconcile_net(lines.select("net_amount"), lines.limit(0)).first()
    assert abs(r.dw_net_sales - 8.0) < 1e-9 and r.oltp_net_sales is None
    both = Q.reconcile_net(lines.select("net_amount"), lines).first()
    assert both.diff == 0 and both.dw_net_sales == both.oltp_net_sales


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "b")], "a long, b string")
    got = {r.key: (r.duplicate_keys, r.example) for r in Q.duplicate_keys({"a": df.select("a"), "ab": df, "fine": df.select("b").where("b IS NOT NULL")}).collect()}
    assert got == {"a": (2, "1"), "ab": (1, "1|(null)")}
