"""SCD operators vs. a small pure-Python model, over random snapshot
sequences (new members, changed members, unchanged members, deletions)."""

import datetime as dt
import hashlib
import random

from starloom.operators import quality as Q
from starloom.operators.dimensions import unknown_member
from starloom.operators.scd import scd1_apply, scd1_initial, scd2_apply, scd2_initial
from starloom.operators.staging import stage_customer, stage_shipper
from starloom.schemas import CUSTOMER, OPEN_END, OPEN_START, SHIPPER

CUST_COLS = ["CustomerID", "CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region", "PostalCode", "Country", "Phone", "Fax"]
CUST_SCHEMA = ", ".join(f"{c} string" for c in CUST_COLS)


def _hash(values):
    return hashlib.md5("|".join("" if v is None else str(v) for v in values).encode()).hexdigest()


def _snapshot(rnd, keys, version):
    rows = []
    for k in keys:
        city = rnd.choice(["Oslo", "Lima", "Pune", None])
        rows.append((k, f"Co {k}", None, rnd.choice(["A", "B"]), None, city, None, None, "X", None, None))
    return rows


def _model_scd2(state, rows, eff, next_sk):
    """state: dict sk -> [bk, attrs(tuple), from, to, current, hash]"""
    current = {v[0]: v for v in state.values() if v[4] and v[0] != "UNKNOWN"}
    delta = [r for r in rows if r[0] not in current or current[r[0]][5] != _hash(r)]
    for r in delta:
        v = current.get(r[0])
        if v is not None and v[5] != _hash(r):
            v[3], v[4] = eff - dt.timedelta(days=1), False
    for r in sorted(delta, key=lambda r: r[0]):
        state[next_sk] = [r[0], tuple(r[1:]), eff, OPEN_END, True, _hash(r)]
        next_sk += 1
    return next_sk


def _spark_versions(df):
    return {
        r.customer_sk: [r.customer_id, (r.company_name, r.contact_name, r.contact_title, r.address, r.city, r.region,
                                        r.postal_code, r.country, r.phone, r.fax), r.effective_from, r.effective_to, r.is_current, r.record_hash]
        for r in df.collect()
    }


def test_scd2_matches_model_over_random_runs(spark):
    rnd = random.Random(3)
    keys = [f"K{i:03d}" for i in range(40)]
    first = _snapshot(rnd, keys[:30], 0)
    staged = stage_customer(spark.createDataFrame(first, CUST_SCHEMA))
    initial, n = scd2_initial(staged, CUSTOMER)
    dim = unknown_member(spark, CUSTOMER).unionByName(initial)
    model = {0: ["UNKNOWN", ("Unknown",) + (None,) * 9, OPEN_START, OPEN_END, True, None]}
    for i, r in enumerate(sorted(first), start=1):
        model[i] = [r[0], tuple(r[1:]), OPEN_START, OPEN_END, True, _hash(r)]
    next_sk = n + 1
    history = spark.createDataFrame([], dim.schema)
    for run, eff in enumerate([dt.date(2001, 1, 1), dt.date(2002, 6, 1), dt.date(2003, 3, 3)], start=1):
        present = [k for k in keys if rnd.random() < 0.85]  # some deleted (ignored), some new
        old = {r[0]: r for r in first}
        rows = []
        for k in present:
            if k in old and rnd.random() < 0.6:
                rows.append(old[k])  # unchanged
            else:
                rows.append(_snapshot(rnd, [k], run)[0])
        res = scd2_apply(dim.where("is_current"), stage_customer(spark.createDataFrame(rows, CUST_SCHEMA)), CUSTOMER, eff, next_sk)
        next_sk = _model_scd2(model, rows, eff, next_sk)
        assert res.next_sk == next_sk
        history = history.unionByName(res.closed)
        state = res.current.unionByName(history)
        dim = spark.createDataFrame(state.collect(), state.schema)  # small test state, kept as local rows
        first = rows
        assert _spark_versions(dim) == model
        assert Q.check_one_current(dim, CUSTOMER).count() == 0
        assert Q.check_overlap(dim, CUSTOMER).count() == 0
        sks = sorted(model)
        assert sks == list(range(len(sks)))  # dense and unique


def test_scd1_matches_model(spark):
    rnd = random.Random(5)
    rows0 = [(i, f"Ship {i}", f"555-{i}") for i in range(1, 20)]
    dim0 = spark.createDataFrame(rows0, "ShipperID long, CompanyName string, Phone string")
    initial, n = scd1_initial(stage_shipper(dim0), SHIPPER)
    dim = unknown_member(spark, SHIPPER).unionByName(initial)
    rows1 = [(i, f"Ship {i}" + ("!" if rnd.random() < 0.3 else ""), f"555-{i}") for i in range(1, 26) if i % 7]
    res = scd1_apply(dim, stage_shipper(spark.createDataFrame(rows1, dim0.schema)), SHIPPER, n + 1)
    got = {r.shipper_id: (r.shipper_sk, r.company_name) for r in res.dim.collect()}
    # existing members keep their SK and take the new name; deleted ones stay; new ones get SKs in key order
    for i in range(1, 20):
        name = next((r[1] for r in rows1 if r[0] == i), f"Ship {i}")
        assert got[i] == (i, name)
    new_ids = sorted(r[0] for r in rows1 if r[0] >= 20)
    assert [got[i][0] for i in new_ids] == list(range(20, 20 + len(new_ids)))
    assert got[-1] == (0, "Unknown") and res.next_sk == 20 + len(new_ids)
