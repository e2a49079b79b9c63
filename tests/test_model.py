"""Splits, metrics, preprocessing, training and drift."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwheel.operators import drift, metrics, splits
from cartwheel.plans import prep, train
from cartwheel.schemas import TRAINING_V2
from cartwheel.sources import registry

W0 = dt.date(2021, 1, 4)


def weeks(n):
    return [W0 + dt.timedelta(days=7 * i) for i in range(n)]


@pytest.mark.parametrize("n, sizes", [(10, (7, 1, 2)), (20, (14, 3, 3)), (1, (0, 0, 1))])
def test_temporal_split_sizes(spark, n, sizes):
    df = spark.createDataFrame([(w, i) for w in weeks(n) for i in range(2)], "week date, i int")
    got = {r.split: r.n for r in splits.temporal_split(df).groupBy("split").agg(
        F.count_distinct("week").alias("n")).collect()}
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == sizes


def test_random_split_is_stable_and_covers(spark):
    df = spark.range(20000)
    a = splits.random_split(df, ["id"])
    b = splits.random_split(df.repartition(13), ["id"])
    assert a.exceptAll(b).count() == 0 and a.count() == 20000
    n = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert abs(n["train"] - 14000) < 400 and abs(n["val"] - 3000) < 300


PREDS = {"all0": [(1, 0), (0, 0)], "all1": [(1, 1), (0, 1)], "no positives": [(0, 0), (0, 0)],
         "mixed": [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)]}


@pytest.mark.parametrize("name", PREDS)
def test_f1_and_report(spark, name):
    rows = PREDS[name]
    df = spark.createDataFrame(rows, "target int, prediction int")
    tp = sum(a == b == 1 for a, b in rows)
    some = sum(a for a, _ in rows) + sum(b for _, b in rows)
    assert metrics.f1_score(df).first().f1 == pytest.approx(2 * tp / some if some else 0.0)
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert rep["accuracy"].f1 == pytest.approx(sum(a == b for a, b in rows) / len(rows))
    for c in (0, 1):
        if str(c) in rep:
            hit = sum(a == b == c for a, b in rows)
            real, said = sum(a == c for a, _ in rows), sum(b == c for _, b in rows)
            assert rep[str(c)].recall == pytest.approx(hit / real if real else 0.0)
            assert rep[str(c)].precision == pytest.approx(hit / said if said else 0.0)
            assert rep[str(c)].support == real
    per = [rep[k] for k in rep if k in "01"]
    assert rep["macro avg"].f1 == pytest.approx(sum(r.f1 for r in per) / len(per))
    assert rep["weighted avg"].f1 == pytest.approx(
        sum(r.f1 * r.support for r in per) / len(rows))


def test_degradation_decision(spark):
    df = spark.createDataFrame([(0.55, 0.5), (0.51, 0.5), (0.5, 0.0)],
                               "best_f1 double, current_f1 double")
    normal = [r.decision for r in metrics.degradation_decision(df).collect()]
    flipped = [r.decision for r in metrics.degradation_decision(df, inverted=True).collect()]
    assert normal == ["optimize_model", "predictions", "optimize_model"]
    assert flipped == ["predictions", "optimize_model", "optimize_model"]


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (None, 7.0), (4.0, 7.0)],
                               "a double, k double")
    x = np.array([1, 2, 7 / 3, 4])
    got = prep.numeric_scaler(df, ["a", "k"]).transform(df).collect()
    assert [r.a_scaled for r in got] == pytest.approx(list((x - x.mean()) / x.std()))
    assert all(r.k_scaled == 0.0 for r in got)
    got = prep.numeric_scaler(df, ["a", "k"], "minmax").transform(df).collect()
    assert [r.a_scaled for r in got] == pytest.approx(list((x - 1) / 3))
    assert all(r.k_scaled == 0.0 for r in got)
    assert prep.numeric_fills(df, ["a"], "median") == {"a": 2.0}


@pytest.fixture(scope="module")
def categories(spark):
    fit = spark.createDataFrame([("a", 10.0), ("b", 2.0), ("b", 2.0), ("it's", -1.5), (None, None)],
                                "s string, z double")
    new = spark.createDataFrame([("a", 10.0), ("zz", 3.0), (None, None), ("it's", -1.5)],
                                "s string, z double")
    return fit, new


def test_unseen_categories_onehot(spark, categories):
    fit, new = categories
    model = PipelineModel(prep.category_encoder(fit, ["s", "z"], "onehot"))
    got = [(list(r.s), list(r.z)) for r in model.transform(new).select(
        vector_to_array("s_code").alias("s"), vector_to_array("z_code").alias("z")).collect()]
    assert got == [([1, 0, 0], [0, 0, 1]), ([0, 0, 0], [0, 0, 0]), ([0, 1, 0], [0, 1, 0]),
                   ([0, 0, 1], [1, 0, 0])]


def test_ordinal_orders_numbers_by_value(spark, categories):
    fit, new = categories
    model = PipelineModel(prep.category_encoder(fit, ["s", "z"], "ordinal"))
    got = [(r.s_code, r.z_code) for r in model.transform(new).collect()]
    assert got == [(0, 2), (-1, -1), (1, 1), (2, 0)]


def test_mode_ties_take_the_smaller(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert sorted(r.s_text for r in prep.mode_imputer(df, ["s"]).transform(df).collect()) == [
        "a", "a", "b"]


@pytest.fixture(scope="module")
def planted(spark):
    """Training rows whose label follows the product size, with some noise."""
    rng, rows = random.Random(5), []
    for w in weeks(20):
        for c in range(30):
            size = rng.randint(1, 50)
            label = int(size > 25) if rng.random() < 0.95 else rng.randint(0, 1)
            rows.append((c, w, size, 1, 1, "t", -33.0, -70.0, 1, 1, f"b{size % 3}", "c", "s", "g",
                         "p", size, label, 1.0 * rng.random(), 2.0, 0.5, 3.0, None, -1, -70.0,
                         -33.0, 0.5, 10.0, 3))
    return spark.createDataFrame(rows, TRAINING_V2)


QUICK = {"imputer_strategy": ["mean", "median"], "scaler": ["standard", "minmax"],
         "encoder": ["onehot", "ordinal"], "n_estimators": (2, 4), "max_depth": (2, 3),
         "learning_rate": (0.1, 0.3), "subsample": (0.8, 1.0), "colsample_bytree": (0.8, 1.0),
         "gamma": (0.0, 1.0)}


def test_search_refit_report_save_load(spark, planted, tmp_path):
    runs = str(tmp_path / "runs")
    model, report, trials = train.optimize(planted, QUICK, n_trials=2, registry=runs)
    rows = {r["class"]: r for r in report.collect()}
    assert rows["1"].f1 > 0.85
    assert trials.count() == 2 and registry.search_runs(spark, runs, train.EXPERIMENT).count() == 2
    best = registry.best_run(registry.search_runs(spark, runs), train.EXPERIMENT).first()
    assert best.valid_f1 == max(r.valid_f1 for r in trials.collect())
    path = train.save_model(model, str(tmp_path / "m" / best.run_id))
    again = train.best_model(spark, registry.search_runs(spark, runs), str(tmp_path / "m"),
                             train.EXPERIMENT)
    a, b = (train.score(m, planted).select("customer_id", "week", "probability").collect()
            for m in (model, again))
    assert a == b and path.endswith(best.run_id)
    assert all(0.0 <= r.probability <= 1.0 for r in a)
    kept = train.score_positive(model, planted)
    assert kept.columns == planted.columns and 0 < kept.count() < planted.count()
    ranked = train.feature_importance(model, planted).orderBy(F.desc("importance")).first()
    assert ranked.feature.startswith("size")


def test_v1_inputs_and_seeded_draws(spark, planted):
    model = train.fit_model(planted, {"n_estimators": 2, "max_depth": 2}, "v1")
    assert metrics.f1_score(train.score(model, planted)).first().f1 > 0.5
    a, b = (train.draw_params(train.SPACE_V2, random.Random(1)) for _ in range(2))
    assert a == b and 50 <= a["n_estimators"] <= 300 and set(a) == set(train.SPACE_V2)


def test_optimization_history(spark):
    runs = spark.createDataFrame([("e", "r1", 0, 0.2), ("e", "r2", 1, 0.5), ("e", "r3", 2, 0.4),
                                  ("f", "r4", 0, None)],
                                 "experiment string, run_id string, trial int, valid_f1 double")
    got = {(r.experiment, r.trial): r.best_f1
           for r in registry.optimization_history(runs).collect()}
    assert got == {("e", 0): 0.2, ("e", 1): 0.5, ("e", 2): 0.5, ("f", 0): None}
    assert {r.experiment: r.run_id for r in registry.best_run(runs).collect()} == {
        "e": "r2", "f": "r4"}


def normal(spark, n, shift=0.0, seed=0, start=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 3)) + shift
    return spark.createDataFrame([(start + i, *map(float, r)) for i, r in enumerate(x)],
                                 "id long, a double, b double, c double")


def test_drift_on_shift_but_not_on_same_distribution(spark):
    ref, cols = normal(spark, 600), ["a", "b", "c"]
    same = [drift.mmd_drift(ref, normal(spark, 150, seed=s, start=1000 * s), cols).first()
            for s in (1, 2, 3)]
    assert sum(r.is_drift for r in same) <= 1  # one false alarm in twenty is the level
    moved = drift.mmd_drift(ref, normal(spark, 150, 0.7, 2, 2000), cols)
    row = drift.drift_decision(moved).first()
    assert row.is_drift and row.p_value < 0.05 and row.decision == "optimize_model"
    assert (row.n_ref, row.n_new) == (600, 150)


def test_false_alarm_rate_is_near_the_level():
    alarms, runs = 0, 150
    for seed in range(runs):
        rng = np.random.default_rng(seed)
        batch = pd.DataFrame({"x": list(rng.standard_normal((400, 3))),
                              "is_new": np.arange(400) < 80,
                              "key": rng.integers(-2 ** 63, 2 ** 63 - 1, 400)})
        sums = next(drift._partial_sums(3, 3 ** 0.5, 0.2, 100, 64, 42)(iter([batch])))
        s = dict(zip(sums.perm, sums.s))
        d = [drift._distance(s[k], s[-1] - s[k]) for k in range(101)]
        alarms += (1 + sum(v >= d[0] for v in d[1:])) / 101 < 0.05
    assert 0.005 < alarms / runs < 0.12


def test_median_width(spark):
    """Near the median over all pairs, hot copies and outliers included; drift is found with it."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 3))
    x[:60] *= 300  # outliers move the mean, not the median
    rows = spark.createDataFrame([(list(map(float, v)), i) for i, v in enumerate(x)],
                                 "x array<double>, key long")
    every = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)[np.triu_indices(len(x), 1)]
    got = drift.median_squared_distance(rows, 3000)
    assert abs(got / np.median(every) - 1) < 0.12 and got < 0.1 * every.mean()
    copies = rows.unionByName(spark.range(2000).selectExpr("array(1D, 1D, 1D) x", "-1L key"))
    assert abs(drift.median_squared_distance(copies, 3000) / np.median(every) - 1) < 0.12
    assert drift.median_squared_distance(rows.limit(1), 1) is None
    ref, cols = normal(spark, 600), ["a", "b", "c"]
    for shift, moved in ((0.0, False), (0.7, True)):
        row = drift.mmd_drift(ref, normal(spark, 150, shift, 2, 2000), cols, width="median").first()
        assert row.is_drift == moved and row.n_new == 150
    with pytest.raises(ValueError):
        drift.mmd_drift(ref, ref, cols, width="other")


def test_few_rows_skip_the_test(spark):
    row = drift.drift_decision(drift.mmd_drift(normal(spark, 50), normal(spark, 9, 5.0),
                                               ["a", "b", "c"])).first()
    assert row.p_value is None and not row.is_drift and row.decision == "predictions"


def test_distance_is_near_the_exact_pairwise_value(spark):
    ref, new = normal(spark, 200), normal(spark, 100, 0.8, 3, 500)
    got = drift.mmd_drift(ref, new, ["a", "b", "c"], n_features=2048, n_perm=5).first()
    x, y = (np.array([(r.a, r.b, r.c) for r in d.collect()]) for d in (ref, new))
    both = np.vstack([x, y])
    mean, std = both.mean(0), both.std(0, ddof=1)
    x, y = (x - mean) / std, (y - mean) / std

    def k(p, q):
        d = ((p[:, None] - q[None]) ** 2).sum(-1)
        return np.exp(-d / (2 * 3.0))
    n, m = len(x), len(y)
    exact = ((k(x, x).sum() - n) / (n * (n - 1)) + (k(y, y).sum() - m) / (m * (m - 1))
             - 2 * k(x, y).mean())
    assert got.mmd2 == pytest.approx(exact, abs=0.02)


def test_bounded_rows_are_fitted_in_few_partitions_and_fixed_order(spark, monkeypatch):
    rows = [(i % 40, W0 + dt.timedelta(days=7 * (i % 9)), i, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "customer_id long, week date, product_id long, target int")
    df = df.withColumns({c: F.col("product_id").cast("double") for c in train.NUMERIC_V2}
                        | {c: (F.col("product_id") % 3).cast("string") for c in train.CATEGORICAL_V2})
    seen = []

    class Fit:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), [tuple(r.features) for r in rows.collect()]))
            return seen
    monkeypatch.setattr(train, "classifier", lambda *_: Fit())
    monkeypatch.setattr(train, "PipelineModel", lambda stages: stages)
    monkeypatch.setattr(train.Statistics, "preprocessor", lambda self, params: prep.PipelineModel([
        prep.VectorAssembler(inputCols=["product_id"], outputCol="features")]))
    for parts in (3, 11):
        train.fit_model(df.repartition(parts), {}, fit_rows=200)
    (few, first), (also, second) = seen
    assert few == also == 1 and len(first) == 200 and first == second


def test_queries_fit_their_trees_on_all_rows(spark, monkeypatch):
    from cartwheel.plans import queries
    n = 10_050  # more than the 10,000 that fits were once cut to
    table = spark.range(n + 10).select(
        (F.col("id") % 400).alias("customer_id"), F.col("id").alias("product_id"),
        F.lit(W0).alias("week"), (F.col("id") % 2).cast("int").alias("target"),
        F.when(F.col("id") < n, "train").otherwise("val").alias("split"))
    table = table.withColumns({c: F.col("product_id").cast("double") for c in train.NUMERIC_V2}
                              | {c: (F.col("product_id") % 3).cast("string") for c in train.CATEGORICAL_V2})
    monkeypatch.setattr(train, "FIT_TASK_ROWS", 6_000)
    monkeypatch.setattr(queries, "_split_table", lambda *_: table)
    monkeypatch.setattr(train, "PipelineModel", lambda stages: stages)
    monkeypatch.setattr(train, "score", lambda model, df: df.withColumn("prediction", F.lit(1)))
    monkeypatch.setattr(train.Statistics, "preprocessor", lambda self, params: prep.PipelineModel([
        prep.VectorAssembler(inputCols=["product_id"], outputCol="features")]))
    seen = []

    class Fit:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), [r.features[0] for r in rows.collect()]))
            return seen
    monkeypatch.setattr(train, "classifier", lambda *_: Fit())
    queries._default_model(table)
    queries._default_model(table.repartition(7))
    queries.hyperparameter_search(spark, "")
    assert len(seen) == 2 + train.N_TRIALS
    assert all(parts == 2 and sorted(rows) == list(range(n)) for parts, rows in seen)
    assert all(rows == seen[0][1] for _, rows in seen)  # in an order that layout doesn't change
