"""Sources, streaming ingest and the weekly pipeline."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.plans.pipeline import Config, run_pipeline
from cartwheel.schemas import CUSTOMERS, PRODUCTS, TRAINING_V2, TRANSACTIONS
from cartwheel.sources import files, tables
from cartwheel.streaming import ingest, windows

D = dt.date(2021, 1, 5)


def tx_of(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS).coalesce(1)


def test_folder_scan_matches_columns_by_name(spark, tmp_path):
    a = tx_of(spark, [(1, 1, 1, D, float("nan"))])
    a.write.parquet(str(tmp_path / "in" / "a"))
    a.select("items", "purchase_date", "product_id", "customer_id").withColumn(
        "items", F.lit(2.0)).write.parquet(str(tmp_path / "in" / "b"))
    got = {(r.order_id, r["items"]) for r in
           tables.read_transactions(spark, str(tmp_path / "in")).collect()}
    assert got == {(1, None), (None, 2.0)}


def test_archive_name_and_csv(spark, tmp_path):
    df = tx_of(spark, [(1, 1, 1, D, 1.0), (1, 1, 2, dt.date(2021, 3, 1), 2.5)])
    path = tables.archive_batch(df, str(tmp_path))
    assert path.endswith("transactions_20210105_20210301.parquet")
    csv = tables.write_features(df, str(tmp_path / "c"), "csv")
    back = tables.read_features_csv(spark, csv, TRANSACTIONS)
    assert back.exceptAll(df).count() == 0 and back.count() == 2


def test_new_file_checks(spark, tmp_path):
    for d, names in (("new", "abc"), ("old", "ab"), ("none", "")):
        (tmp_path / d).mkdir()
        for n in names:
            (tmp_path / d / n).write_text("x")
    new, old, none = (files.file_manifest(spark, str(tmp_path / d)) for d in ("new", "old", "none"))
    assert [r.file_name for r in files.detect_new_files(new, old).collect()] == ["c"]
    def decide(a, b):
        return files.detect_new_data_count(spark, str(tmp_path / a), str(tmp_path / b)).first()
    assert decide("new", "old").decision == files.READ_NEW
    assert decide("none", "none").decision == files.READ_NEW
    assert decide("old", "new").decision == files.SKIP
    assert none.count() == 0


def test_each_file_is_ingested_once(spark, tmp_path):
    new, hist, chk = (str(tmp_path / d) for d in ("new", "hist", "chk"))
    tx_of(spark, [(1, 1, 1, D, 1.0)]).write.mode("append").parquet(new)
    assert ingest.ingest_files(spark, new, hist, chk) == 1
    assert ingest.ingest_files(spark, new, hist, chk) == 0
    tx_of(spark, [(2, 1, 1, D, 1.0), (3, 1, 1, D, 1.0)]).write.mode("append").parquet(new)
    assert ingest.ingest_files(spark, new, hist, chk) == 2
    assert spark.read.parquet(hist).count() == 3


def test_distinct_ingest_against_history(spark, tmp_path):
    new, hist, chk = (str(tmp_path / d) for d in ("new", "hist", "chk"))
    row, other = (1, 1, 1, D, 1.0), (1, 1, None, D, None)
    tx_of(spark, [row, row, other]).write.mode("append").parquet(new)
    assert ingest.ingest_distinct(spark, new, hist, chk) == 3
    assert ingest.ingest_distinct(spark, new, hist, chk) == 0
    tx_of(spark, [row, other, (2, 1, 1, D, 1.0)]).write.mode("append").parquet(new)
    assert ingest.ingest_distinct(spark, new, hist, chk) == 3
    assert tables.read_transactions(spark, hist).count() == 3


def run_stream(spark, df, name, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def test_stream_dedupe_and_weekly_windows(spark, tmp_path):
    days = [dt.datetime(2021, 1, d, 12) for d in (3, 4, 10, 11)]
    rows = [(i, 1, 1, t, 2.0) for i, t in enumerate(days)] * 2
    schema = ("event_id long, customer_id long, product_id long, purchase_ts timestamp, "
              "items double")
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "s"))
    once = run_stream(spark, ingest.dedupe_stream(stream, "purchase_ts", ["event_id"]), "once")
    assert once.count() == 4
    weekly = run_stream(spark, windows.weekly_sales_stream(stream), "weekly", "complete")
    got = {r.week: r["items"] for r in weekly.collect()}
    want = {r.week: r["items"] for r in windows.weekly_sales_stream(df).collect()}
    assert got == want == {dt.date(2020, 12, 28): 4.0, dt.date(2021, 1, 4): 8.0,
                           dt.date(2021, 1, 11): 4.0}


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    spark.createDataFrame([(c, c % 2, c % 3, "t", -33.0 - c % 2, -70.0, 1, 1) for c in range(12)],
                          CUSTOMERS).write.parquet(str(root / "customers"))
    spark.createDataFrame([(p, f"b{p % 3}", "c", "s", "g", "k", p) for p in range(8)],
                          PRODUCTS).write.parquet(str(root / "products"))
    return root


def sales_of(spark, seed, first):
    rng = random.Random(seed)
    return tx_of(spark, [(rng.randint(0, 11), rng.randint(0, 7), i,
                          D + dt.timedelta(days=7 * first + rng.randint(0, 69)),
                          float(rng.randint(1, 5))) for i in range(150)])


def test_weekly_run(spark, shop):
    cfg = Config(str(shop / "new"), str(shop / "hist"), str(shop / "customers"),
                 str(shop / "products"), str(shop / "work"), n_trials=1,
                 space={"n_estimators": [2], "max_depth": [2], "encoder": ["onehot"]})
    sales_of(spark, 1, 0).write.mode("append").parquet(cfg.new_dir)
    first = run_pipeline(spark, cfg)
    assert first["decision"] == "optimize_model"
    assert spark.read.parquet(first["report"]).count() >= 4
    scored = spark.read.schema(TRAINING_V2).parquet(first["scored"])
    assert scored.columns == TRAINING_V2.names and scored.count() > 0
    assert run_pipeline(spark, cfg) == {"decision": files.SKIP}
    sales_of(spark, 2, 3).write.mode("append").parquet(cfg.new_dir)
    second = run_pipeline(spark, cfg)
    assert "reason" not in second
    assert second["decision"] in ("optimize_model", "predictions")


def test_ingest_compares_with_a_foreign_history(spark, tmp_path):
    """Rows that another writer laid out differently count as known."""
    new, hist, chk = (str(tmp_path / d) for d in ("new", "hist", "chk"))
    row, other = (1, 1, 1, D, 1.0), (2, 1, 1, D, 1.0)
    tables.archive_batch(tx_of(spark, [row, other]), hist)
    tx_of(spark, [row]).write.parquet(new)
    assert ingest.ingest_distinct(spark, new, hist, chk) == 1
    assert tables.read_transactions(spark, hist).count() == 2


def test_a_new_checkpoint_keeps_the_history(spark, tmp_path):
    hist = str(tmp_path / "hist")
    for turn, rows in enumerate([[(1, 1, 1, D, 1.0), (2, 1, 1, None, 1.0)],
                                 [(1, 1, 1, D, 1.0), (3, 1, 1, D, 1.0), (2, 1, 1, None, 1.0)]]):
        tx_of(spark, rows).write.parquet(str(tmp_path / f"new{turn}"))
        ingest.ingest_distinct(spark, str(tmp_path / f"new{turn}"), hist, str(tmp_path / f"c{turn}"))
    assert tables.read_transactions(spark, hist).count() == 3


def test_a_failed_run_is_taken_up_again(spark, shop, tmp_path, monkeypatch):
    from cartwheel.plans import pipeline
    rows = [(c, p, c * 100 + w, D + dt.timedelta(7 * w), float(1 + (c + p + w) % 3))
            for c in range(12) for w in range(8) for p in range(8) if (c * 7 + p * 3 + w) % 4 == 0]
    tx_of(spark, rows).write.parquet(str(tmp_path / "new"))
    cfg = Config(str(tmp_path / "new"), str(tmp_path / "hist"), str(shop / "customers"),
                 str(shop / "products"), str(tmp_path / "work"), n_trials=1)

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "training_set_v2", broken)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, cfg)
    with monkeypatch.context() as m:  # it goes on although there is no new file
        m.setattr(pipeline, "training_set_v2", broken)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, cfg)
    pipeline._mark(spark, cfg, pipeline.DONE)
    assert run_pipeline(spark, cfg) == {"decision": files.SKIP}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from cartwheel.session import shared_folder
    conf = {}
    fake = SimpleNamespace(conf=SimpleNamespace(get=conf.get, set=conf.__setitem__),
                           sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_folder(fake)
    conf["spark.checkpoint.dir"] = "file:///shared/"
    assert shared_folder(fake) == "file:///shared"


def test_exact_median(spark):
    from cartwheel.plans.prep import exact_median
    random.seed(8)
    for n in (1, 2, 7, 1000):
        values = [random.choice([0.0, 1e9, -3.5, random.random()]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
        s = sorted(values)
        assert exact_median(df, "v") == (s[n // 2] + s[(n - 1) // 2]) / 2
    assert exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None


def test_degradation_against_the_registry(spark, tmp_path):
    """A model far below the registry's best is trained again, one close to it is used."""
    from types import SimpleNamespace

    from cartwheel.operators.metrics import PREDICT, RETRAIN
    from cartwheel.plans.pipeline import degradation_step
    from cartwheel.sources import registry
    table = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, 0.0), (0, 0.0)],
                                  "target int, prediction double")  # F1 = 0.8
    model = SimpleNamespace(transform=lambda df: df)
    for best, want in ((0.95, RETRAIN), (0.82, PREDICT)):
        path = str(tmp_path / str(best))
        registry.log_run(spark, path, "purchase_propensity", 1, 0.1, {})
        registry.log_run(spark, path, "purchase_propensity", 2, best, {})
        registry.log_run(spark, path, "another", 1, 1.0, {})
        got = degradation_step(model, table, registry.search_runs(spark, path)).first()
        assert got.decision == want and got.current_f1 == pytest.approx(0.8)
