"""Committed models, cells kept up to date, archives, tolerant CSV: nothing is lost or half seen."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.sales import weekly_sales
from cartwheel.plans import train
from cartwheel.schemas import PRODUCTS, TRANSACTIONS
from cartwheel.sources import registry, tables
from cartwheel.sources.model_store import ModelStore
from cartwheel.streaming import ingest, weekly_cells
from tests.test_model import QUICK, planted  # noqa: F401 - a fixture

D = dt.date(2021, 1, 5)


def tx_of(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS)


def test_optimize_log_save_best(spark, planted, tmp_path):  # noqa: F811
    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    model, _, trials = train.optimize(planted, QUICK, n_trials=2, registry=runs, store=models)
    found = registry.search_runs(spark, runs)
    best = registry.best_run(found, train.EXPERIMENT).first()
    assert ModelStore(spark, models).newest().first().run_id == best.run_id
    again = train.best_model(spark, found, models, train.EXPERIMENT)
    a, b = (train.score(m, planted).select("customer_id", "week", "probability").collect()
            for m in (model, again))
    assert a == b and trials.filter(F.col("run_id") == best.run_id).count() == 1


def test_a_save_that_broke_off_is_not_seen(spark, planted, tmp_path, monkeypatch):  # noqa: F811
    store = ModelStore(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.load_newest()
    old, new = (train.fit_model(planted, {"n_estimators": n, "max_depth": 2}) for n in (1, 2))
    store.save(old, "r1", "e", 0.5)
    with monkeypatch.context() as m:
        m.setattr(ModelStore, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.save(new, "r2", "e", 0.9)
    def trees(model):
        return model.stages[-1].getNumTrees
    assert trees(store.load_newest("e")) == 1
    assert store.save(new, "r2", "e", 0.9).endswith("r2")  # tried again
    assert trees(store.load_newest("e")) == 2 and store.commits("other").isEmpty()
    first = store.save(old, "r2", "e", 0.9)  # the same run once more: its first folder stays
    assert not first.endswith("r2") and trees(store.load_newest("e")) == 1
    runs = spark.createDataFrame([("e", "r1", 0.5), ("e", "r3", 0.99), ("e", "r2", 0.9)],
                                 "experiment string, run_id string, valid_f1 double")
    assert trees(store.load_best(runs, "e")) == 1  # r3 was never committed; r2's last commit


def test_trials_side_by_side(spark, planted):  # noqa: F811
    parts = [planted.filter(F.col("customer_id") % 2 == k) for k in (0, 1)]
    one, many = (train.search(*parts, QUICK, n_trials=3, fit_rows=200, side_by_side=n)
                 for n in (1, 3))
    assert one[0] == many[0]
    assert one[1].drop("run_id").collect() == many[1].drop("run_id").collect()


def test_rows_to_fit(spark, planted):  # noqa: F811
    some = train.rows_to_fit(planted, 100)
    assert some.count() == 100 and some.exceptAll(planted).count() == 0
    assert train.rows_to_fit(planted.repartition(7), 100).exceptAll(some).count() == 0
    assert train.rows_to_fit(planted, 10 ** 6).count() == planted.count()


def sales(n, seed):
    rng = random.Random(seed)
    return [(rng.choice([1, 2, None]), rng.randint(1, 4), i * 10 + seed, rng.choice(
        [None, *[D + dt.timedelta(days=d) for d in range(0, 60, 3)]]),
        rng.choice([None, 1.0, 2.0, -1.0])) for i in range(n)]


def cells_of(df):
    return sorted(map(str, df.select("customer_id", "product_id", "week", "items").collect()))


def test_cells_follow_batches(spark, tmp_path):
    new, hist, chk, cells = (str(tmp_path / d) for d in ("new", "hist", "chk", "cells"))
    assert weekly_cells.read_cells(spark, cells).isEmpty()
    rows = sales(60, 1)
    for part in (rows[:30], rows[20:50], rows[10:] + sales(20, 2)):
        tx_of(spark, part).write.mode("append").parquet(new)
        ingest.ingest_distinct(spark, new, hist, chk, cells=cells)
        want = weekly_sales(tables.read_transactions(spark, hist))
        assert cells_of(weekly_cells.read_cells(spark, cells)) == cells_of(want)


@pytest.mark.parametrize("broken", ["after sums", "after cells", "before sums"])
def test_a_batch_counts_once(spark, tmp_path, monkeypatch, broken):
    cells = str(tmp_path / "cells")
    weekly_cells.apply_sales(spark, cells, "b0", tx_of(spark, sales(30, 3)))
    log = weekly_cells._log

    def lost(session, root, batch, step):
        if (broken, step) in (("before sums", weekly_cells.SUMMED),
                              ("after cells", weekly_cells.APPLIED)):
            raise RuntimeError
        log(session, root, batch, step)
        if broken == "after sums" and step == weekly_cells.SUMMED:
            raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(weekly_cells, "_log", lost)
        with pytest.raises(RuntimeError):
            weekly_cells.apply_sales(spark, cells, "b1", tx_of(spark, sales(30, 4)))
    assert weekly_cells.apply_sales(spark, cells, "b1", tx_of(spark, sales(30, 4)))
    assert not weekly_cells.apply_sales(spark, cells, "b1", tx_of(spark, sales(30, 4)))
    want = weekly_sales(tx_of(spark, sales(30, 3) + sales(30, 4)))
    assert cells_of(weekly_cells.read_cells(spark, cells)) == cells_of(want)


def test_only_touched_weeks_are_read(spark, tmp_path):
    cells = str(tmp_path / "cells")
    weekly_cells.apply_sales(spark, cells, "b0", tx_of(spark, sales(80, 5)))
    fresh = weekly_sales(tx_of(spark, [(1, 1, 1, D, 1.0)]))
    touched = weekly_cells.touched_cells(spark, cells, fresh)
    assert {r.week for r in touched.collect()} == {dt.date(2021, 1, 4)}
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert filters.count("week") >= 1 and "= 2021-01-04" in filters


def test_writers_share_a_history(spark, tmp_path):
    hist = str(tmp_path / "hist")
    for k, take in enumerate((ingest.ingest_files, ingest.ingest_distinct, ingest.ingest_files)):
        tx_of(spark, [(k, p, k, D, 1.0) for p in range(3)]).write.parquet(str(tmp_path / f"n{k}"))
        assert take(spark, str(tmp_path / f"n{k}"), hist, str(tmp_path / f"c{k}")) == 3
    tables.archive_batch(tx_of(spark, [(9, 9, 9, D, 1.0)]), hist)
    assert tables.read_transactions(spark, hist).count() == 10
    tx_of(spark, [(0, 0, 0, D, 1.0), (8, 8, 8, D, 1.0)]).write.parquet(str(tmp_path / "n9"))
    ingest.ingest_distinct(spark, str(tmp_path / "n9"), hist, str(tmp_path / "c9"))
    assert tables.read_transactions(spark, hist).count() == 11


def test_archives_of_the_same_dates(spark, tmp_path):
    root = str(tmp_path / "archive")
    paths = {tables.archive_batch(tx_of(spark, [(k, p, 1, D, 1.0) for p in range(5)]), root)
             for k in (1, 2)}
    assert len(paths) == 1 and tables.read_transactions(spark, root).count() == 10
    for _ in (1, 2):  # the same batch again replaces itself
        tables.archive_batch(tx_of(spark, [(3, 3, 3, D, 1.0)]), root, "third")
    assert tables.read_transactions(spark, root).count() == 11


def test_missing_texts_and_rejects(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "product_id,brand,category,sub_category,segment,package,size\n"
        "1,NA,nan,,x,N/A,5\n" "2,b,c,d,e,f,NaN\n" "3,b,c,d,e,f,big\n" "4,b,c\n"
        "null, NA ,c,d,e,f,7\n" "5,b,c,d,e,f,8,9,10\n" "six,b,c,d,e,f,1.5\n")
    rows = {r[0]: r for r in tables.read_csv_checked(spark, str(tmp_path / "p.csv"), PRODUCTS)
            .orderBy(F.monotonically_increasing_id()).collect()}
    assert tuple(rows[1])[:7] == (1, None, None, None, "x", None, 5)
    assert rows[2]["size"] is None and rows[2]["_rejected"] == []
    assert rows[3]["_rejected"] == ["size"] and rows[4]["_line"] and rows[5]["_line"]
    bad = str(tmp_path / "bad")
    good = tables.read_features_csv(spark, str(tmp_path / "p.csv"), PRODUCTS, rejects=bad)
    assert sorted(str(r.product_id) for r in good.collect()) == ["1", "2", "None"]
    assert spark.read.parquet(bad).count() == 4


def test_requests_are_answered_once(spark, tmp_path):
    from cartwheel.streaming.requests import answer_requests, read_answers
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    offers = spark.createDataFrame(
        [(1, p, D, f"b{p % 2}", "k", p % 3 != 0) for p in range(1, 7)],
        "customer_id long, product_id long, week date, brand string, package string, bought boolean"
    ).withColumn("prediction", F.col("bought").cast("int"))
    assert read_answers(spark, out).isEmpty()

    def send(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
            "append").text(folder)
        return answer_requests(spark, folder, offers, out, state)

    assert send('{"customer_id": "1", "brands": ["b1"]}', "not json", '{"brands": []}') == 3
    assert answer_requests(spark, folder, offers, out, state) == 0
    assert send('{"customer_id": "7"}', '{"customer_id": "1", "brands": []}') == 2
    got = sorted(r.json for r in read_answers(spark, out).collect())
    assert got == ['{"customer_id":"1","recommended_products":[1,2,4,5]}',
                   '{"customer_id":"1","recommended_products":[1,5]}',
                   '{"customer_id":"7","recommended_products":[]}']
    bad = spark.read.option("recursiveFileLookup", "true").schema("value string").parquet(
        out + "-rejected")
    assert sorted(r.value for r in bad.collect()) == ["not json", '{"brands": []}']


def test_dropped_rows_are_counted(spark, tmp_path):
    from cartwheel.plans.training import staged_sales
    from cartwheel.schemas import CUSTOMERS
    rows = [(1, 1, 1, D, 2.0), (1, 1, 1, D, 2.0), (1, 2, 2, None, 1.0), (None, 1, 3, D, 1.0),
            (1, 3, 4, D, -5.0), (1, 3, 5, D, 1.0), (2, 1, 6, D, None), (2, 2, 7, D, float("nan"))]
    found: dict = {}
    sold = staged_sales(tx_of(spark, rows), spark.createDataFrame([], CUSTOMERS),
                        spark.createDataFrame([], PRODUCTS), found)
    assert found == {"transactions": 7, "undated": 1, "without_customer": 1, "without_items": 2,
                     "cells": 6, "negative_cells": 1, "undated_cells": 1}
    assert sold.count() == 6


def test_the_first_of_equal_trials_is_best(spark):
    runs = spark.createDataFrame([("e", "b", 0, 0.5), ("e", "a", 1, 0.5), ("e", "c", 2, 0.4)],
                                 "experiment string, run_id string, trial int, valid_f1 double")
    assert registry.best_run(runs).first().run_id == "b"
    assert registry.best_run(runs, "e").first().run_id == "b"
