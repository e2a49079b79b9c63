"""Distinct customers of zones: the exact count against plain Python, sketches within their error."""

import datetime as dt
import random

from cartwheel.operators import zone_customers as zones
from cartwheel.schemas import CUSTOMERS, TRANSACTIONS

MONDAY = dt.date(2021, 1, 4)


def tables(spark, customers, sales, seed=3):
    random.seed(seed)
    names = [f.name for f in CUSTOMERS.fields]
    place = {c: (random.choice([1.04, 1.06, None]), 2.0) for c in range(customers)}
    cust = [tuple({"customer_id": c, "X": x, "Y": y}.get(n) for n in names)
            for c, (x, y) in place.items()]
    names = [f.name for f in TRANSACTIONS.fields]
    tx = []
    for i in range(sales):
        row = {"customer_id": random.choice([None, customers + 5, *range(customers)]),
               "purchase_date": random.choice([None, *(MONDAY + dt.timedelta(d) for d in range(40))]),
               "product_id": 1, "order_id": i, "items": 1.0}
        tx.append(tuple(row.get(n) for n in names))
    where = {c: (round((x or 0) * 10) / 10, y) for c, (x, y) in place.items()}
    seen = {}
    i, j = names.index("customer_id"), names.index("purchase_date")
    for t in tx:
        if t[i] in where and t[j] is not None:
            week = t[j] - dt.timedelta(t[j].weekday())
            seen.setdefault((where[t[i]], week), set()).add(t[i])
    return (spark.createDataFrame(tx, TRANSACTIONS), spark.createDataFrame(cust, CUSTOMERS), seen)


def test_exact_counts(spark):
    tx, cust, seen = tables(spark, 40, 400)
    got = {((r.zone_X, r.zone_Y), r.week): (r.customers, r.customers_so_far)
           for r in zones.zone_customers(tx, cust).collect()}
    want = {(z, w): (len(s), len(set().union(*(o for (y, v), o in seen.items()
                                               if y == z and v <= w))))
            for (z, w), s in seen.items()}
    assert got == want
    assert zones.zone_customers(tx.limit(0), cust).count() == 0
    assert zones.zone_customers(tx, cust.limit(0)).count() == 0


def test_sketches_of_batches(spark, tmp_path):
    """Overlapping batches, one of them tried twice, count a customer once."""
    tx, cust, seen = tables(spark, 3000, 9000)
    root = str(tmp_path / "sketches")
    assert zones.read_sketches(spark, root).count() == 0
    for name, rule in (("a", "order_id < 5000"), ("b", "order_id > 3000"), ("a", "order_id < 5000")):
        zones.add_batch(spark, root, name, tx.filter(rule), cust)
    stored = zones.read_sketches(spark, root)
    assert {((r.zone_X, r.zone_Y), r.week) for r in stored.collect()} == set(seen)
    want = {}
    for (z, _), s in seen.items():
        want.setdefault(z, set()).update(s)
    error = 5 * 1.04 / 2 ** (zones.PRECISION / 2)
    got = {(r.zone_X, r.zone_Y): r.customers
           for r in zones.estimated_customers(stored, *zones.ZONE).collect()}
    assert got.keys() == want.keys()
    for z, n in got.items():
        assert abs(n - len(want[z])) <= error * len(want[z])
