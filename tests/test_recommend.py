import datetime as dt
import json

from cartwheel.operators import recommend, sales
from cartwheel.schemas import REQUESTS, TRANSACTIONS

D = dt.date(2021, 1, 5)


def tx_of(spark, baskets):
    rows = [(c, p, 1, D, float(q)) for c, items in baskets.items() for p, q in items]
    return spark.createDataFrame(rows, TRANSACTIONS)


BASKETS = {
    1: [(10, 5), (11, 5)],                                    # two products, tied
    2: [(p, 20 - p) for p in range(10, 17)],                  # seven products
    3: [(p, 1) for p in range(10, 15)],                       # exactly five
    4: [(p, 100) for p in range(20, 30)],                     # owns the whole top ten
    5: [(None, 50), (30, 1)],
}


def brute(c, n=5, pool=10):
    totals = {}
    for items in BASKETS.values():
        for p, q in items:
            if p is not None:
                totals[p] = totals.get(p, 0) + q
    popular = sorted(totals, key=lambda p: (-totals[p], p))
    if c not in BASKETS:
        return popular[:n]
    mine = {p: q for p, q in BASKETS[c] if p is not None}
    own = sorted(mine, key=lambda p: (-mine[p], p))
    return (own + [p for p in popular[:pool] if p not in own])[:n]


def test_batch_recommendations_match_brute_force(spark):
    tx = tx_of(spark, BASKETS)
    ids = spark.createDataFrame([(c,) for c in [*BASKETS, 99, 99]], "customer_id long")
    for n, pool in ((5, 10), (3, 2), (12, 10), (20, 3)):
        got = {r.customer_id: r.recommendations
               for r in recommend.recommend_batch(tx, ids, n, pool).collect()}
        assert got == {c: brute(c, n, pool) for c in [*BASKETS, 99]}, (n, pool)
        assert all(len(set(v)) == len(v) <= n for v in got.values())


def test_lists_can_stay_short(spark):
    tx = tx_of(spark, {4: BASKETS[4]})
    ids = spark.createDataFrame([(4,)], "customer_id long")
    assert len(recommend.recommend_batch(tx, ids, 12, 10).first().recommendations) == 10


def test_known_customers_and_backfill(spark):
    tx = tx_of(spark, BASKETS)
    ids = spark.createDataFrame([(1,), (99,)], "customer_id long")
    assert {r.customer_id: r.known for r in recommend.known_customers(tx, ids).collect()} == {
        1: True, 99: False}
    offers = recommend.rec_backfill(sales.purchase_history(tx), sales.top_products(tx, 10))
    got = {(r.customer_id, r.product_id) for r in offers.collect()}
    assert not {c for c, _ in got} & {4}
    assert {p for c, p in got if c == 1} == set(range(20, 30))


CANDIDATES = ("customer_id long, product_id long, week date, brand string, package string, "
              "prediction int")


def candidates(spark):
    w = [dt.date(2021, 1, 4) + dt.timedelta(days=7 * i) for i in range(3)]
    return spark.createDataFrame(
        [(1, 7, w[1], "a", "x", 1), (1, 7, w[0], "a", "x", 1), (1, 5, w[0], "b", "x", 1),
         (1, 6, w[0], "b", "y", 0), (1, 8, w[2], "b", "y", 1), (2, 9, w[0], None, "y", 1)],
        CANDIDATES)


def test_request_filters(spark):
    asked = spark.createDataFrame([
        ("1", None, None), ("1", [], []), ("1", ["b"], None), ("1", ["zz"], None),
        ("77", None, None), ("1", ["a", "b"], ["y"]), ("2", ["a"], None), ("1", None, None)],
        REQUESTS)
    rows = recommend.recommend_requests(asked, candidates(spark)).collect()
    got = [((r.customer_id, str(r.brands), str(r.packages)), r.recommended_products)
           for r in rows]
    assert len(got) == 8
    assert dict(got) == {
        ("1", "None", "None"): [5, 7, 7, 8], ("1", "[]", "[]"): [5, 7, 7, 8],
        ("1", "['b']", "None"): [5, 8], ("1", "['zz']", "None"): [],
        ("77", "None", "None"): [], ("1", "['a', 'b']", "['y']"): [8],
        ("2", "['a']", "None"): []}
    once = recommend.recommend_requests(asked.limit(1), candidates(spark), distinct=True).first()
    assert once.recommended_products == [5, 7, 8]


def test_json_in_and_out_and_messages(spark):
    lines = spark.createDataFrame(
        [('{"customer_id": "1", "brands": ["a"]}',), ('{"customer_id": "77"}',)], "value string")
    answers = recommend.recommend_requests(recommend.requests_from_json(lines), candidates(spark))
    out = {json.loads(r.json)["customer_id"]: json.loads(r.json)["recommended_products"]
           for r in recommend.answers_json(answers).collect()}
    assert out == {"1": [7, 7], "77": []}
    said = {r.customer_id: r.message for r in
            recommend.format_recommendations(answers).collect()}
    assert said == {"1": recommend.FOUND_TEXT + "7, 7", "77": recommend.EMPTY_TEXT}


def test_filter_options(spark):
    row = recommend.filter_options(candidates(spark)).first()
    assert row.brands == ["a", "b", "nan"] and row.packages == ["x", "y"]
