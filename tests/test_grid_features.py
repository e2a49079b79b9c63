"""Grid and features against a plain pandas recomputation on small random data."""

import datetime as dt
import random
from functools import partial

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from cartwheel import session
from cartwheel.operators import grid, sampling
from cartwheel.operators.features import carried_labels, pair_summary
from cartwheel.plans import training
from cartwheel.plans.training import balanced_cells, features, grid_features, purchase_features
from cartwheel.schemas import CUSTOMERS, PRODUCTS

MONDAY = dt.date(2021, 1, 4)
SOLD = "customer_id long, product_id long, week date, items double"


def week(i):
    return MONDAY + dt.timedelta(days=7 * i)


def dims(spark, customers, products):
    cust = spark.createDataFrame(
        [(c, 1, 1, "t", -33.0 - c % 2, -70.0 - c % 3, 1, 1) for c in customers], CUSTOMERS)
    prod = spark.createDataFrame(
        [(p, f"b{p}", "c", "s", "g", "k", p) for p in products], PRODUCTS)
    return cust, prod


def random_sold(seed=0, hot=True):
    """Cells of 6 customers; customer 0 holds about a third of them, some sums are <= 0."""
    rng, out = random.Random(seed), {}
    for _ in range(150):
        c = 0 if hot and rng.random() < 0.33 else rng.randint(1, 5)
        out[(c, rng.randint(1, 7), week(rng.randint(0, 7)))] = float(rng.choice(
            [-2, 0, 1, 2, 3, 4, 5]))
    return [(*k, v) for k, v in out.items()]


def brute_grid(sold, customers):
    s = pd.DataFrame(sold, columns=["customer_id", "product_id", "week", "items"])
    cw = s[["customer_id", "week"]].drop_duplicates()
    cp = s[["customer_id", "product_id"]].drop_duplicates()
    g = cw.merge(cp, on="customer_id").merge(s, how="left",
                                             on=["customer_id", "product_id", "week"])
    g["items"] = g["items"].fillna(0.0)
    g = g[["customer_id", "product_id", "week", "items"]]
    return g[(g["items"] >= 0) & g.customer_id.isin(customers)]


def as_set(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("heavy_share", [1, 4, 2000])
def test_grid_matches_brute_force_for_any_heavy_share(spark, heavy_share):
    sold = random_sold()
    cust, _ = dims(spark, [0, 1, 2, 3, 4], [])  # customer 5 is not in the dimension
    df = spark.createDataFrame(sold, SOLD)
    rows = grid.unpack(grid.packed_grid(df, cust, heavy_share))
    want = brute_grid(sold, [0, 1, 2, 3, 4])
    cols = ["customer_id", "product_id", "week", "items"]
    assert as_set(rows, cols) == sorted(want[cols].itertuples(index=False, name=None))
    sizes = grid.grid_sizes(df, cust).first()
    assert sizes.bought == (want["items"] > 0).sum()
    assert sizes.unbought == (want["items"] == 0).sum()
    keys = grid.grid_per_customer(df, cust, heavy_share)
    full = {(c, p, w) for c in range(5) for p in {s[1] for s in sold if s[0] == c}
            for w in {s[2] for s in sold if s[0] == c}}
    assert set(as_set(keys, cols[:3])) == full and keys.count() == len(full)


def test_undated_and_unknown_customers_have_no_cells(spark):
    df = spark.createDataFrame([(1, 1, None, 1.0), (None, 1, MONDAY, 1.0), (1, 2, MONDAY, 1.0),
                                (1, None, MONDAY, 5.0)], SOLD)
    rows = grid.unpack(grid.packed_grid(df))
    assert {(r.customer_id, r.product_id, r["items"]) for r in rows.collect()} == {
        (1, 2, 1.0), (1, None, 5.0)}


def brute_features(g, cust):
    g = g.sort_values(["customer_id", "product_id", "week"]).copy()
    g["target"] = (g["items"] > 0).astype(int)
    xy = {r.customer_id: (round(r.X, 1), round(r.Y, 1)) for r in cust.collect()}
    g["zone"] = g.customer_id.map(xy)
    out = {}
    for i, r in g.iterrows():
        mine = g[g.customer_id == r.customer_id]
        spot = list(mine.index).index(i)
        last4 = mine.target.iloc[max(0, spot - 3): spot + 1]
        before = mine[(mine.product_id == r.product_id) & (mine.week < r.week)].week
        zone = g[g.zone == r.zone]
        out[(r.customer_id, r.product_id, r.week)] = (
            r.target, mine[mine.week == r.week]["items"].sum(), mine["items"].mean(),
            last4.mean(), g[g.product_id == r.product_id]["items"].mean(),
            before.max() if len(before) else None,
            (r.week - before.max()).days if len(before) else -1,
            zone.target.mean(), zone["items"].sum(), zone.customer_id.nunique())
    return out


FIGURES = ["target", "total_weekly_purchase", "customer_avg_purchase", "recent_purchase_trend",
           "product_avg_purchase", "last_purchase_week", "days_since_last_purchase",
           "zone_avg_purchase_freq", "zone_total_purchases", "zone_customer_density"]


def check_features(df, want):
    got = {(r.customer_id, r.product_id, r.week): tuple(r[f] for f in FIGURES)
           for r in df.collect()}
    assert got.keys() == want.keys()
    for k, figures in want.items():
        for name, a, b in zip(FIGURES, got[k], figures):
            if b is None or isinstance(b, dt.date):
                assert a == b, (k, name)
            else:
                assert a == pytest.approx(b), (k, name)


def test_features_of_the_full_grid(spark):
    sold = random_sold(1)
    cust, prod = dims(spark, range(6), range(1, 6))  # products 6 and 7 are unknown
    df = spark.createDataFrame(sold, SOLD)
    out = features(grid.packed_grid(df, cust), cust, prod)
    check_features(out, brute_features(brute_grid(sold, range(6)), cust))
    unknown = out.filter("product_id > 5").select("brand", "size").distinct().collect()
    assert [tuple(r) for r in unknown] == [("0", 0)]


def test_features_of_a_sample(spark):
    sold = random_sold(2)
    cust, prod = dims(spark, range(6), range(1, 8))
    full = brute_grid(sold, range(6))
    part = full.sample(frac=0.5, random_state=1)
    rows = spark.createDataFrame(list(part.itertuples(index=False, name=None)), SOLD)
    check_features(purchase_features(rows, cust, prod), brute_features(part, cust))


def test_trend_runs_across_products(spark):
    rows = [(1, p, week(w), float((p, w) in {(1, 0), (1, 2), (2, 1)}))
            for p in (1, 2) for w in range(3)]
    packed = grid.pack(spark.createDataFrame(rows, SOLD))
    carry = {r.product_id: r.carry for r in carried_labels(pair_summary(packed)).collect()}
    assert carry == {1: [], 2: [1, 0, 1]}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000))
def test_balanced_sample_is_exact_and_repeatable(spark, seed):
    sold = random_sold(seed)
    cust, _ = dims(spark, range(6), [])
    df = spark.createDataFrame(sold, SOLD)
    want = brute_grid(sold, range(6))
    n_pos = int((want["items"] > 0).sum())
    cols = ["customer_id", "product_id", "week", "items"]
    first = balanced_cells(df, cust, seed).select(*cols).collect()
    assert len(first) == len(set(first)) == 2 * n_pos
    assert sum(r["items"] > 0 for r in first) == n_pos
    again = balanced_cells(df.repartition(7), cust, seed).select(*cols).collect()
    assert set(first) == set(again)


def test_too_few_unbought_cells(spark):
    cust, _ = dims(spark, [1], [])
    df = spark.createDataFrame([(1, 1, MONDAY, 2.0)], SOLD)
    with pytest.raises(ValueError):
        balanced_cells(df, cust)
    assert balanced_cells(df, cust, on_short="take_all").count() == 1


def test_generic_sample_counts_for_itself(spark):
    rows = [(c, p, MONDAY, float(c == 1)) for c in range(1, 5) for p in range(30)]
    df = spark.createDataFrame(rows, SOLD)
    out = sampling.balanced_sample(df, 7)
    assert out.filter("items > 0").count() == 30 and out.filter("items = 0").count() == 30
    other = sampling.balanced_sample(df, 8)
    assert out.exceptAll(other).count() > 0


def test_no_positive_cells(spark):
    df = spark.createDataFrame([(1, 1, MONDAY, 0.0), (1, 2, MONDAY, 0.0)], SOLD)
    assert sampling.balanced_sample(df).count() == 0


def test_positive_and_negative_parts(spark):
    df = spark.createDataFrame([(1, 1, MONDAY, -3.0), (1, 2, MONDAY, 0.0), (1, 3, MONDAY, 5.0)],
                               SOLD)
    pos, neg = grid.split_pos_neg(df)
    assert [r.product_id for r in pos.collect()] == [3]
    assert [r.product_id for r in neg.collect()] == [2]
    assert {r.product_id: r.target for r in grid.label_target(df).collect()} == {1: 0, 2: 0, 3: 1}


def test_gaps_are_filled_before_zones_and_order(spark):
    """Customers without coordinates share zone 0; a missing product is product 0, the first."""
    import datetime as dt

    from cartwheel.plans.training import training_set_v2
    from cartwheel.schemas import CUSTOMERS, PRODUCTS, TRANSACTIONS
    w = [dt.date(2021, 1, 4), dt.date(2021, 1, 11)]
    tx = spark.createDataFrame([(1, 5, 1, w[0], 2.0), (1, None, 2, w[1], 4.0), (2, 5, 3, w[0], 6.0)],
                               TRANSACTIONS)
    cust = spark.createDataFrame([(1, 0, 0, "t", None, None, 1, 1), (2, 0, 0, "t", None, None, 1, 1)],
                                 CUSTOMERS)
    prod = spark.createDataFrame([(5, "b", "c", "s", "g", "k", 7)], PRODUCTS)
    got = sorted((r.customer_id, r.product_id, r.week, r.target, round(r.recent_purchase_trend, 6),
                  r.product_avg_purchase, r.zone_X, r.zone_total_purchases, r.zone_customer_density)
                 for r in training_set_v2(tx, cust, prod, balance=False).collect())
    assert got == [(1, 0, w[0], 0, 0.0, 2.0, 0.0, 12.0, 2), (1, 0, w[1], 1, 0.5, 2.0, 0.0, 12.0, 2),
                   (1, 5, w[0], 1, 0.666667, 8 / 3, 0.0, 12.0, 2),
                   (1, 5, w[1], 0, 0.5, 8 / 3, 0.0, 12.0, 2), (2, 5, w[0], 1, 1.0, 8 / 3, 0.0, 12.0, 2)]


def test_nothing_bought_gives_an_empty_sample(spark):
    from cartwheel.operators.sampling import balanced_sample
    grid = spark.range(1000).selectExpr("id AS customer_id", "1 AS product_id",
                                        "DATE'2021-01-04' AS week", "0D AS items")
    assert balanced_sample(grid).count() == 0


def test_cells_one_by_one_and_packed_give_the_same_features(spark):
    """Customers with more cells than a task orders are packed by pair; the others pass a window."""
    sold = [(*r[:1], r[1] if r[1] != 3 else None, *r[2:]) for r in random_sold(5) if r[3] >= 0]
    cust, prod = dims(spark, range(5), range(1, 6))  # customer 5 and product 6 are unknown
    rows = spark.createDataFrame(sold, SOLD)
    windowed, packed, mixed = (purchase_features(rows, cust, prod, most=n)
                               for n in (1000, 0, 30))
    names = windowed.columns
    want = as_set(windowed.fillna(-1).withColumn("last_purchase_week",
                                                 windowed.last_purchase_week.cast("string"))
                  .fillna(""), names)
    assert want
    for other in (packed, mixed):
        assert other.columns == names
        text = other.last_purchase_week.cast("string")
        assert as_set(other.fillna(-1).withColumn("last_purchase_week", text).fillna(""),
                      names) == want
    assert "Window" in windowed._jdf.queryExecution().toString()


@pytest.mark.parametrize("heavy_share", [1, 10 ** 9])
def test_cells_below_a_hash_are_those_of_the_unpacked_grid(spark, heavy_share):
    sold = [(*r[:1], r[1] if r[1] != 3 else None, *r[2:]) for r in random_sold(6)]
    cust, _ = dims(spark, [0, 1, 2, 3, 4], [])
    df = spark.createDataFrame(sold, SOLD)
    from pyspark.sql import functions as F

    from cartwheel.functions import hash_order
    limit, cols = "80", ["customer_id", "product_id", "week", "items", "total_weekly_purchase"]
    h = hash_order(["customer_id", "product_id", F.unix_date("week")], 42)
    cells = grid.unpack(grid.packed_grid(df, cust))

    def plain(rows):
        return sorted((tuple(str(v) for v in r) for r in rows.select(*cols).collect()))
    parts = grid.grid_parts(df, cust, heavy_share)
    got = plain(grid.cells_below(parts, 42, limit))
    assert got == plain(cells.filter((F.col("items") > 0) | (h < limit)))
    assert 0 < len(got) < cells.count()
    assert parts.sizes == tuple(grid.grid_sizes(df, cust).first())
    assert plain(grid.cells_below(parts, 42, None)) == plain(cells)
    # the packed rows choose the same cells
    packed = grid.each_cell(grid.packed_grid(df, cust), 42, limit)
    assert packed.count() == len(got)
    assert packed.filter("_h IS NULL").count() == cells.filter("items > 0").count()


def test_features_of_the_whole_grid_group_its_pairs_once(spark, monkeypatch):
    from cartwheel import session
    from cartwheel.operators import grid
    from cartwheel.plans import training
    week = dt.date(2021, 1, 4)
    rows = {(i % 23, i % 7 or None, week + dt.timedelta(7 * (i % 11))): float(i % 9 - 2)
            for i in range(900)}
    rows |= {(99, p, week + dt.timedelta(7 * w)): 1.0 for p in range(10, 40) for w in range(20)}
    sold = spark.createDataFrame([(*k, v) for k, v in rows.items()],
                                 "customer_id long, product_id long, week date, items double")
    cust = spark.createDataFrame([(i, float(i % 3), None) for i in [*range(2, 23), 99, 5]],
                                 "customer_id long, X double, Y double")
    prod = spark.createDataFrame([(i, i % 4) for i in range(20)], "product_id long, size int")

    def lines(df):
        return sorted(map(str, df.collect()))
    packed = grid.packed_grid(sold, cust)
    expected = lines(training.features(packed, cust, prod))
    pairs = lines(grid.unpack(packed))
    for task_rows in (500_000, 50):
        monkeypatch.setattr(session, "TASK_ROWS", task_rows)
        table = training.grid_features(sold, cust, prod)
        assert lines(table) == expected and len(expected) > 1000
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
        for share in (1, 3, 2000):  # customer 99 alone has more than a third of the cells
            weeks = grid.stored_weeks(sold, cust, share)
            assert (weeks.heavy is None) == (share == 1)
            assert lines(grid.unpack(grid.grid_pairs(sold, weeks))) == pairs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trend_alone_sends_no_statistics_through_the_driver(spark, monkeypatch):
    sold = random_sold(3)
    cust, prod = dims(spark, range(6), range(1, 8))
    cells = grid.grid_labeled(spark.createDataFrame(sold, SOLD), cust).localCheckpoint()
    got = []
    for task_rows in (10 ** 6, 20):
        monkeypatch.setattr(session, "TASK_ROWS", task_rows)
        trend = purchase_features(cells, cust, prod).select(
            "customer_id", "product_id", "week", "recent_purchase_trend")
        got.append(as_set(trend, trend.columns))
    # a few columns of a file look small enough to broadcast, whatever the number of rows
    assert "Broadcast" not in plan_of(trend) and "ShuffledHashJoin" in plan_of(trend)
    assert got[0] == got[1] and got[0]


@pytest.mark.parametrize("share", [1, 4, 10 ** 9])  # no customer is heavy, one, all
def test_whole_grid_features_sort_nothing_wide(spark, monkeypatch, share):
    sold = [*random_sold(5), (1, None, week(2), 3.0), (1, None, week(4), 1.0)]
    df = spark.createDataFrame(sold, SOLD)
    cust, prod = dims(spark, range(5), range(1, 6))  # customer 5, products 6 and 7 are unknown
    monkeypatch.setattr(training, "stored_weeks", partial(grid.stored_weeks, heavy_share=share))
    want = features(grid.packed_grid(df, cust), cust, prod)
    names, want, drawn = want.columns, as_set(want, want.columns), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for task_rows in (10 ** 6, 20):
            monkeypatch.setattr(session, "TASK_ROWS", task_rows)
            got = grid_features(df, cust, prod)
            assert got.columns == names and as_set(got, names) == want
            drawn.append(as_set(grid_features(df, cust, prod, chosen=True), names))
        assert "SortMergeJoin" not in plan_of(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert drawn[0] == drawn[1] and set(drawn[0]) <= set(want)
    at = names.index("target")
    assert sum(r[at] for r in drawn[0]) * 2 == len(drawn[0]) > 0
