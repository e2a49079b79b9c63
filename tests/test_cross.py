import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import cross
from cartwheel.operators.sales import CELL

SOLD = "customer_id long, product_id long, week date, items double"
WEEKS = [dt.date(2021, 1, 4) + dt.timedelta(days=7 * i) for i in range(5)]


@pytest.fixture(scope="module")
def sold(spark):
    rows = [(c, p, WEEKS[(c + p) % 5], float((c * p) % 4 - 1)) for c in range(6) for p in range(7)]
    return spark.createDataFrame(rows, SOLD)


def test_numbering_is_dense(spark, sold):
    got = sorted(r.product_id_no for r in cross.axis(sold, "product_id").collect())
    assert got == list(range(7))


def test_permutation_visits_every_cell_once(spark):
    sizes = cross.AxisSizes(6, 5, 7)
    start = spark.range(sizes.cells).selectExpr(
        "id AS _k", "id % 6 AS c", "(id div 6) % 5 AS w", "id div 30 AS p")
    out = cross._shuffle_numbers(start, sizes, 42)
    assert out.select("c", "w", "p").distinct().count() == sizes.cells
    assert out.filter("c < 0 OR c > 5 OR w < 0 OR w > 4 OR p < 0 OR p > 6").count() == 0
    assert out.filter("_k != c + 6 * w + 30 * p").count() > sizes.cells // 2


@pytest.mark.parametrize("n", [0, 50, None])
def test_draw_is_exact_distinct_and_unsold(spark, sold, n):
    known = {tuple(r) for r in sold.filter("items != 0").select(*CELL).collect()}
    n = 6 * 5 * 7 - len(known) if n is None else n  # None: every free cell
    got = [tuple(r) for r in cross.draw_unbought(spark, sold, n).select(*CELL).collect()]
    assert len(got) == len(set(got)) == n
    assert not known & set(got)


def test_asking_for_too_many_raises(spark, sold):
    with pytest.raises(ValueError):
        cross.draw_unbought(spark, sold, 6 * 5 * 7)


def test_summary_against_brute_force(spark, sold):
    full = (sold.select("customer_id").distinct().crossJoin(sold.select("product_id").distinct())
            .crossJoin(sold.select("week").distinct())
            .join(sold, CELL, "left").fillna(0.0))
    want = {r.week: (r.n, r.b) for r in full.filter("items >= 0").groupBy("week").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("items") > 0, 1)).alias("b")).collect()}
    got = {r.week: (r.bought + r.unbought, r.bought)
           for r in cross.cross_summary(sold).collect()}
    assert got == want


def test_balanced_cross(spark, sold):
    out = cross.balanced_cross(spark, sold)
    pos = sold.filter("items > 0").count()
    assert out.filter("items > 0").count() == out.filter("items = 0").count() == pos


def test_next_week_candidates_against_brute_force(spark, sold):
    from cartwheel.schemas import CUSTOMERS, PRODUCTS, REQUESTS
    cust = spark.createDataFrame([(c, 1, 1, "t", 0.0, 0.0, 1, 1) for c in range(3)], CUSTOMERS)
    shelf = [(p, "ab"[p % 2] if p < 8 else None, "c", "s", "g", "xyz"[p % 3], p)
             for p in range(10)]
    asks = [("0", None, None), ("1", ["a", "a", "q"], []), ("2", [], ["x", "z"]),
            ("99", None, None), ("1", ["a", "a", "q"], [])]
    got = cross.next_week_candidates(sold, spark.createDataFrame(asks, REQUESTS), cust,
                                     spark.createDataFrame(shelf, PRODUCTS), 3)
    week = max(WEEKS) + dt.timedelta(days=7)
    want = {(int(c), p[0], week) for c, brands, packs in asks if int(c) < 3 for p in shelf
            if (not brands or p[1] in brands) and (not packs or p[5] in packs)}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_next_week_offers_against_brute_force(spark, sold):
    from cartwheel.schemas import CUSTOMERS, PRODUCTS, REQUESTS
    cust = spark.createDataFrame([(c, 1, 1, "t", 0.0, 0.0, 1, 1) for c in range(3)], CUSTOMERS)
    shelf = [(p, "ab"[p % 2] if p < 8 else None, "c", "s", "g", "xyz"[p % 3], p) for p in range(10)]
    asks = [("0", None, None), ("1", ["a", "q"], []), ("2", [], ["x", "z"]), ("99", None, None)]
    pool = spark.createDataFrame([(3,), (4,), (77,)], "product_id long")
    got = cross.next_week_offers(sold, spark.createDataFrame(asks, REQUESTS), cust,
                                 spark.createDataFrame(shelf, PRODUCTS), pool)
    week = max(WEEKS) + dt.timedelta(days=7)
    own = {(r.customer_id, r.product_id) for r in sold.collect()}
    want = {(int(c), p[0], week) for c, brands, packs in asks if int(c) < 3 for p in shelf
            if ((int(c), p[0]) in own or p[0] in (3, 4))
            and (not brands or p[1] in brands) and (not packs or p[5] in packs)}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
