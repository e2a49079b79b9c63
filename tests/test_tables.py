import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import (
    degradation_pct, iso_week, month_number, round_half_even, to_timestamp_strict, week_start,
    week_start_ts, yyyymmdd,
)
from cartwheel.operators import sales, tables
from cartwheel.schemas import CUSTOMERS, PRODUCTS, TRANSACTIONS

D = dt.date


def tx_of(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS)


def cells(df):
    return {(r.customer_id, r.product_id, r.week): r["items"] for r in df.collect()}


def test_weeks_at_iso_year_edges(spark):
    days = [D(2020, 12, 31), D(2021, 1, 3), D(2021, 1, 4), D(2024, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: (r.w, r.i, r.m, r.y) for r in df.select(
        "d", week_start("d").alias("w"), iso_week("d").alias("i"), month_number("d").alias("m"),
        yyyymmdd("d").alias("y")).collect()}
    for d in days:
        monday = d - dt.timedelta(days=d.weekday())
        assert got[d] == (monday, d.isocalendar()[1], d.month, d.strftime("%Y%m%d"))


def test_week_start_keeps_time_of_day(spark):
    df = spark.sql("SELECT timestamp_ntz'2021-01-07 13:45:10' AS t")
    assert df.select(week_start_ts("t")).first()[0] == dt.datetime(2021, 1, 4, 13, 45, 10)


def test_malformed_timestamp_is_null(spark):
    df = spark.createDataFrame([("2020-01-01",), ("nope",)], "t string")
    got = [r[0] for r in df.select(to_timestamp_strict("t")).collect()]
    assert got == [dt.datetime(2020, 1, 1), None]


def test_round_ties(spark):
    pairs = [(0.25, 0.2), (0.35, 0.4), (0.15, 0.2), (-0.04, 0.0), (1.25, 1.2), (2.675, 2.7),
             (-70.65, -70.6), (-33.45, -33.4), (0.05, 0.0)]
    df = spark.createDataFrame([p[:1] for p in pairs], "x double")
    got = {r.x: r.y for r in df.select("x", round_half_even("x").alias("y")).collect()}
    assert got == dict(pairs)
    assert str(got[-0.04]) == "0.0"


def test_weekly_sales_nulls_and_nan(spark):
    d = D(2021, 1, 5)
    tx = tx_of(spark, [(None, 1, 1, d, 2.0), (None, 1, 2, d, 3.0), (1, None, 1, d, 4.0),
                       (2, 2, 1, d, None), (3, 3, 1, d, float("nan")), (3, 3, 2, d, 1.0)])
    w = D(2021, 1, 4)
    assert cells(sales.weekly_sales(tx)) == {
        (None, 1, w): 5.0, (1, None, w): 4.0, (2, 2, w): 0.0, (3, 3, w): 1.0}


def test_dedupe_compares_all_columns(spark):
    d = D(2021, 1, 5)
    tx = tx_of(spark, [(1, 1, 1, d, 2.0), (1, 1, 1, d, 2.0), (1, 1, 2, d, 2.0),
                       (None, 1, 1, d, 1.0), (None, 1, 1, d, 1.0)])
    assert tables.dedupe(tx).count() == 3
    assert tables.ingest(tx, tx).count() == 3


def test_repeated_dimension_keys_repeat_rows_and_sales(spark):
    d = D(2021, 1, 5)
    tx = tx_of(spark, [(1, 1, 1, d, 2.0), (2, 1, 2, d, 1.0)])
    cust = spark.createDataFrame([(1, 1, 1, "a", 0.0, 0.0, 1, 1), (1, 2, 1, "b", 0.0, 0.0, 1, 1),
                                  (2, 1, 1, "a", 0.0, 0.0, 1, 1)], CUSTOMERS)
    prod = spark.createDataFrame([(1, "b", "c", "s", "g", "p", 1)], PRODUCTS)
    full = tables.enrich(tx, cust, prod)
    assert full.count() == 3
    direct = cells(sales.weekly_sales(full))
    assert direct == cells(sales.fan_out(sales.weekly_sales(tx), cust, prod))
    assert direct[(1, 1, D(2021, 1, 4))] == 4.0


def test_null_safe_enrichment(spark):
    tx = tx_of(spark, [(None, 1, 1, D(2021, 1, 5), 2.0)])
    cust = spark.createDataFrame([(None, 7, 1, "a", 0.0, 0.0, 1, 1)], CUSTOMERS)
    prod = spark.createDataFrame([(1, "b", "c", "s", "g", "p", 1)], PRODUCTS)
    assert tables.enrich(tx, cust, prod).first().region_id is None
    assert tables.enrich(tx, cust, prod, null_safe=True).first().region_id == 7


def test_fill_nulls_leaves_dates(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a int, b string, c double, d date")
    assert tuple(tables.fill_nulls(df, overrides={"a": -1}).first()) == (-1, "0", 0.0, None)


def test_union_by_name_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, k int")
    c = spark.createDataFrame([(3,)], "k int")
    assert {tuple(r) for r in tables.union_by_name(a, b, c).collect()} == {
        (1, "x"), (2, "y"), (3, None)}


def test_history_figures(spark):
    w1, w2 = D(2021, 1, 5), D(2021, 1, 12)
    tx = tx_of(spark, [(1, 1, 10, w1, 1.0), (1, 2, 10, w1, 1.0), (1, 1, 11, w2, 9.0),
                       (2, 1, 12, w2, 1.0), (None, 3, 13, w2, 1.0)])
    lines = {r.customer_id: r.avg_items for r in sales.avg_items(tx).collect()}
    assert lines == {1: 1.5, 2: 1.0}
    orders = {r.customer_id: (r.num_orders, r.distinct_orders)
              for r in sales.num_orders(tx).collect()}
    assert orders == {1: (3, 2), 2: (1, 1)}


def test_periodicity_same_day_and_single(spark):
    d = D(2021, 1, 1)
    tx = tx_of(spark, [(1, 1, 1, d, 1.0), (1, 1, 2, d, 1.0), (1, 1, 3, D(2021, 1, 11), 1.0),
                       (1, 2, 1, d, 1.0)])
    assert {r.product_id: r.periodicity for r in sales.periodicity(tx).collect()} == {
        1: 5.0, 2: 0.0}


def test_periodicity_of_timestamps_against_brute_force(spark):
    import random
    rng, rows = random.Random(3), []
    for p in range(4):
        for _ in range(40):
            rows.append((p, dt.datetime(2021, 1, 1) + dt.timedelta(
                hours=rng.randint(0, 24 * 12), minutes=rng.randint(0, 59))))
    rows.append((9, dt.datetime(2021, 1, 1)))
    df = spark.createDataFrame(rows, "product_id long, purchase_date timestamp_ntz")
    got = {r.product_id: r.periodicity for r in sales.periodicity(df, "timestamp").collect()}
    for p in {r[0] for r in rows}:
        at = sorted(t for q, t in rows if q == p)
        gaps = [(b - a).days for a, b in zip(at, at[1:])]
        assert got[p] == pytest.approx(sum(gaps) / len(gaps) if gaps else 0.0)


def test_latest_week_split(spark):
    df = spark.createDataFrame([(D(2021, 1, 4), 1), (D(2021, 1, 11), 2)], "week date, k int")
    ref, new = tables.latest_week_split(df)
    assert [r.k for r in ref.collect()] == [1] and [r.k for r in new.collect()] == [2]


def test_degradation_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "b double, c double")
    assert df.select(degradation_pct("b", "c").alias("d")).first().d is None
    assert df.select(degradation_pct(F.lit(0.55), F.lit(0.5)).alias("d")).first().d == \
        pytest.approx(10.0)


def test_tasks_of_a_large_input_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    from cartwheel import session
    from cartwheel.sources import star
    n = 20_000
    spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"),
        F.lit(2).cast("decimal(15,2)").alias("l_quantity")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 300).alias("o_custkey"),
        F.date_add(F.lit(D(2021, 1, 4)), (F.col("id") % 700).cast("int")).alias("o_orderdate")
    ).write.parquet(f"{tmp_path}/orders.parquet")

    def summed():
        rows = star.transaction_rows(spark, str(tmp_path))
        assert rows == n
        return sales.weekly_sales(tables.dedupe(star.transactions(spark, str(tmp_path))), rows)

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    before = cells(summed())
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    assert largest(star.transactions(spark, str(tmp_path))) < 1000
    assert largest(summed()) < 1000
    assert cells(summed()) == before


def test_distinct_rows_and_pairs_are_dealt_by_their_number(spark, monkeypatch):
    from cartwheel import session
    from cartwheel.operators import grid
    from cartwheel.plans.training import staged_sales
    day = D(2020, 1, 6)
    rows = [(i % 90 if i % 7 else None, i % 31, i // 2, day + dt.timedelta(i % 60), float(i % 5))
            for i in range(4000)]
    tx = spark.createDataFrame(
        rows + rows[:50], "customer_id long, product_id long, order_id long, purchase_date date, items double")
    cust = spark.createDataFrame([(i, i) for i in range(80)], "customer_id long, zone_id long")
    prod = spark.createDataFrame([(i,) for i in range(31)], "product_id long")

    def results(n):
        sold = staged_sales(tx, cust, prod, rows=n)
        return [sorted(map(str, df.collect())) for df in (
            tables.dedupe(tx, n), sold, grid.grid_per_customer(sold, cust, rows=n))]
    before = results(None)
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    assert results(4050) == before
    largest = tables.dedupe(tx, 4050).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 1000 and len(before[0]) == 4000


def test_large_joins_with_dimensions_sort_no_cells(spark, monkeypatch):
    from cartwheel import session
    week = D(2020, 1, 6)
    sold = spark.createDataFrame(
        [(i % 9 or None, i % 3000, week, float(i)) for i in range(6000)],
        "customer_id long, product_id long, week date, items double")
    cust = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "customer_id long")
    prod = spark.createDataFrame([(i, i % 5) for i in range(2900)], "product_id long, size int")

    def results(n):
        return [df.orderBy(*df.columns).collect() for df in (
            sales.fan_out(sold, cust, prod, n), session.join_dealt(sold, prod, n, "product_id"))]
    before = results(None)
    assert before[0] == results(6000)[0] and len(before[0]) == 6000 and len(before[1]) == 5800
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    assert results(6000) == before
    assert sum(r["items"] for r in before[0]) == sum(i * (1 + (i % 9 == 1)) for i in range(6000))
    for df in (sales.fan_out(sold, cust, prod, 6000),
               session.join_dealt(sold, prod, 6000, "product_id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ShuffledHashJoin") == 1 and "Sort" not in plan.replace("SortMerge", "")
