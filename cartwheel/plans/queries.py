"""Every registered query: (spark, folder) -> DataFrame over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.functions import (
    days_between, iso_week, month_number, next_week, round_half_even, week_start, yyyymmdd,
)
from cartwheel.operators import cross, drift, grid, metrics, recommend, sales, splits, tables
from cartwheel.operators.features import pair_summary, zone_features as zones_of
from cartwheel.plans import prep, train
from cartwheel.plans.training import balanced_cells, staged_sales, training_set_v2
from cartwheel.plans.training_v1 import scoring_set_v1, training_set_v1
from cartwheel.schemas import CUSTOMERS, NUMERIC_V2
from cartwheel.session import join_dealt, scratch_path, stage
from cartwheel.sources import files, registry, star
from cartwheel.sources.tables import date_range, read_features_csv, write_features

CELL = sales.CELL


def _inputs(spark, folder):
    return (star.transactions(spark, folder), star.customers(spark, folder),
            star.products(spark, folder))


def _sold(spark, folder) -> DataFrame:
    rows = star.transaction_rows(spark, folder)
    return sales.weekly_sales(tables.dedupe(star.transactions(spark, folder), rows), rows)


def _staged(spark, folder) -> tuple[DataFrame, DataFrame]:
    """(weekly cells as a written table, customers): the grid reads its cells more than once."""
    tx, c, p = _inputs(spark, folder)
    return staged_sales(tx, c, p, rows=star.transaction_rows(spark, folder)), c


def _judged(spark, folder) -> DataFrame:
    """Weekly cells with a label (more than 25 items) and a rule's prediction (size above 25)."""
    cells = join_dealt(_sold(spark, folder), star.products(spark, folder),
                       star.transaction_rows(spark, folder), "product_id")
    return cells.select(*CELL, "brand", "package", "items", "size",
                        (F.col("items") > 25).cast("int").alias("target"),
                        (F.col("size") > 25).cast("int").alias("prediction"))


# --- sources -------------------------------------------------------------------------------

def scan_transactions(spark, folder):
    return star.transactions(spark, folder)


def scan_dimensions(spark, folder):
    _, c, p = _inputs(spark, folder)
    return tables.union_by_name(c, p)


def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "customers-csv")
    write_features(star.customers(spark, folder), path, "csv")
    return read_features_csv(spark, path, CUSTOMERS)


def archive_range(spark, folder):
    return date_range(star.transactions(spark, folder))


def _manifests(spark, folder):
    """File names of monthly batches: all months as the drop folder, those before the last
    quarter of the covered months as the history."""
    tx = star.transactions(spark, folder)
    months = tx.select(F.date_format("purchase_date", "yyyyMM").alias("m")).distinct()
    named = months.select("m", F.concat(F.lit("drop/batch_"), "m", F.lit(".parquet"))
                          .alias("path"))
    edge = tx.agg(F.date_format(F.date_sub(F.max("purchase_date"), 90), "yyyyMM")).scalar()
    return named.select("path"), named.filter(F.col("m") < edge).select("path")


def detect_new_files(spark, folder):
    return files.detect_new_files(*_manifests(spark, folder))


def detect_new_count(spark, folder):
    return files.detect_new_count(*_manifests(spark, folder))


def ingest_merge(spark, folder):
    tx = star.transactions(spark, folder)
    return tables.ingest(tx.filter(F.col("purchase_date") >= F.lit("1998-01-01").cast("date")),
                         tx.filter(F.col("purchase_date") < F.lit("1999-01-01").cast("date")))


def ingest_incremental(spark, folder):
    """A history written as an archive, then files that overlap it by a year taken in."""
    from cartwheel.sources.tables import archive_batch, read_transactions
    from cartwheel.streaming.ingest import ingest_distinct
    tx, day = star.transactions(spark, folder), F.col("purchase_date")
    drop, history, state = (scratch_path(spark, n) for n in ("drop", "history", "ingest"))
    archive_batch(tx.filter(day < F.lit("1999-01-01").cast("date")), history)
    tx.filter(day >= F.lit("1998-01-01").cast("date")).write.parquet(drop)
    ingest_distinct(spark, drop, history, state, tx.schema)
    return read_transactions(spark, history, tx.schema)


def weekly_sales_incremental(spark, folder):
    """Three batches that overlap by a year each, the last with late rows, taken in one by one; the
    cells are kept up to date week by week."""
    from cartwheel.streaming.ingest import ingest_distinct
    from cartwheel.streaming.weekly_cells import read_cells
    tx, day = star.transactions(spark, folder), F.year("purchase_date")
    history, state, cells = (scratch_path(spark, n) for n in ("history", "ingest", "cells"))
    drop = scratch_path(spark, "drop")
    late = F.col("order_id") % 50 == 0
    for part in ((day <= 1995) & ~late, day.between(1995, 1997), (day >= 1997) | late):
        tx.filter(part).write.mode("append").parquet(drop)
        ingest_distinct(spark, drop, history, state, tx.schema, cells=cells)
    return read_cells(spark, cells)


def archive_same_range(spark, folder):
    """Two batches with the same first and last date, both kept."""
    from cartwheel.sources.tables import archive_batch, read_transactions
    tx, root = star.transactions(spark, folder), scratch_path(spark, "archive")
    span = tx.agg(F.min("purchase_date").alias("a"), F.max("purchase_date").alias("b"))
    edge = tx.join(F.broadcast(span), F.col("purchase_date").isin(F.col("a"), F.col("b")),
                   "left_semi")
    for k in (0, 1):
        part = tx.filter(F.col("order_id") % 2 == k).unionByName(edge).distinct()
        archive_batch(part, root)
    return read_transactions(spark, root, tx.schema).distinct()


def csv_missing_texts(spark, folder):
    """Customers written with texts that mean a missing value, and some that are no number."""
    from cartwheel.sources.tables import read_csv_checked
    key, c = F.col("customer_id"), star.customers(spark, folder)
    path = scratch_path(spark, "customers-gaps")
    texts = c.select("customer_id", *[F.when(key % n == 0, F.lit(t)).otherwise(
        F.col(x).cast("string")).alias(x) for x, n, t in (
            ("region_id", 13, "north"), ("zone_id", 11, ""), ("customer_type", 7, "nan"),
            ("Y", 5, "NA"), ("X", 3, "NaN"), ("num_deliver_per_week", 17, "null"),
            ("num_visit_per_week", 19, "n/a"))])
    write_features(texts, path, "csv")
    return read_csv_checked(spark, path, CUSTOMERS).select(
        *CUSTOMERS.names, F.concat_ws(",", "_rejected").alias("rejected"))


# --- projections, joins and aggregates --------------------------------------------------------

def dedupe_transactions(spark, folder):
    return tables.dedupe(star.transactions(spark, folder))


def enrich_transactions(spark, folder):
    return tables.enrich(*_inputs(spark, folder))


def weekly_sales(spark, folder):
    return _sold(spark, folder)


def grid_per_customer(spark, folder):
    sold, c = _staged(spark, folder)
    return grid.grid_per_customer(sold, c, rows=sold.count())


def grid_labeled(spark, folder):
    return grid.grid_labeled(*_staged(spark, folder))


def label_target(spark, folder):
    cells = _sold(spark, folder).withColumn("items", F.col("items") - 25.0)
    return grid.label_target(cells)


def split_pos_neg(spark, folder):
    pos, neg = grid.split_pos_neg(grid_labeled(spark, folder))
    pos = pos.groupBy("customer_id").agg(F.count("*").alias("cells"), F.sum("items").alias("items"))
    neg = neg.groupBy("customer_id").agg(F.count("*").alias("cells"), F.sum("items").alias("items"))
    return (pos.withColumn("side", F.lit("pos"))
            .unionByName(neg.withColumn("side", F.lit("neg"))))


def fill_nulls(spark, folder):
    tx, c, p = _inputs(spark, folder)
    big = c.filter(F.col("num_visit_per_week") > 1)
    wide = p.filter(F.col("size") > 10)
    return tables.fill_nulls(tables.enrich(tx, big, wide), overrides={"size": -1})


def top_products(spark, folder):
    return sales.top_products(star.transactions(spark, folder), 10)


def rec_history(spark, folder):
    return sales.purchase_history(star.transactions(spark, folder))


def avg_items(spark, folder):
    return sales.avg_items(tables.dedupe(star.transactions(spark, folder)))


def num_orders(spark, folder):
    return sales.num_orders(tables.dedupe(star.transactions(spark, folder)))


def periodicity(spark, folder):
    return sales.periodicity(tables.dedupe(star.transactions(spark, folder)))


def periodicity_timestamp(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return sales.periodicity(lines.select(
        F.col("l_partkey").alias("product_id"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 3))
        .alias("purchase_date")), grain="timestamp")


def calendar_features(spark, folder):
    d = F.col("purchase_date")
    return (star.transactions(spark, folder).select("purchase_date").distinct().select(
        "purchase_date", week_start(d).alias("week"), next_week(week_start(d)).alias("next_week"),
        month_number(d).alias("month"), iso_week(d).alias("iso_week"), yyyymmdd(d).alias("ymd"),
        days_between(d, week_start(d)).alias("days_into_week")))


def zone_round(spark, folder):
    return star.customers(spark, folder).select(
        "customer_id", round_half_even("X").alias("zone_X"), round_half_even("Y").alias("zone_Y"))


def zone_customers(spark, folder):
    from cartwheel.operators.zone_customers import zone_customers
    return zone_customers(star.transactions(spark, folder), star.customers(spark, folder))


def zone_customers_sketch(spark, folder):
    """Sketches of three batches that overlap, next to the exact count: is each zone's estimate
    within five standard errors, as the precision states them?"""
    from cartwheel.operators import zone_customers as zones
    tx, cust = star.transactions(spark, folder), star.customers(spark, folder)
    root, year = scratch_path(spark, "zone-sketches"), F.year("purchase_date")
    for name, part in (("a", year <= 1995), ("b", year.between(1995, 1997)), ("c", year >= 1997)):
        zones.add_batch(spark, root, name, tx.filter(part), cust)
    guess = zones.estimated_customers(zones.read_sketches(spark, root), *zones.ZONE)
    exact = zones.zone_customers(tx, cust).groupBy(*zones.ZONE).agg(
        F.max("customers_so_far").alias("exact"))
    error = 5 * 1.04 / 2 ** (zones.PRECISION / 2)
    return exact.join(guess, zones.ZONE, "full").select(
        *zones.ZONE, F.col("exact").alias("customers"),
        (F.abs(F.col("customers") - F.col("exact")) <= error * F.col("exact")).alias("within"))


# --- samples and splits -------------------------------------------------------------------------

def balanced_sample(spark, folder):
    return balanced_cells(*_staged(spark, folder))


def temporal_split(spark, folder):
    return splits.temporal_split(_sold(spark, folder))


def random_split(spark, folder):
    return splits.random_split(_sold(spark, folder), CELL)


def latest_week_split(spark, folder):
    ref, new = tables.latest_week_split(_sold(spark, folder))
    return (ref.withColumn("side", F.lit("ref")).unionByName(new.withColumn("side", F.lit("new"))))


# --- features -------------------------------------------------------------------------------------

def _training(spark, folder, **how) -> DataFrame:
    return training_set_v2(*_inputs(spark, folder), rows=star.transaction_rows(spark, folder), **how)


def training_v2(spark, folder):
    return _training(spark, folder)


def scoring_v2(spark, folder):
    return _training(spark, folder, balance=False)


def training_unskewed(spark, folder):
    return _training(spark, folder, features_before_sampling=True)


def features_point_in_time(spark, folder):
    return _training(spark, folder, mode="point_in_time")


def _feature(*names) -> Callable:
    def query(spark, folder):
        return training_v2(spark, folder).select(*CELL, *names)
    return query


def features_with_gaps(spark, folder):
    """Features of the whole grid when every seventh product id and some coordinates are missing."""
    tx, c, p = _inputs(spark, folder)
    key = F.col("customer_id")
    gap = F.lit(None).cast("double")
    tx = tx.withColumn("product_id", F.when(F.col("product_id") % 7 != 0, F.col("product_id")))
    c = c.withColumns({"X": F.when(key % 5 == 0, gap).otherwise(F.col("X")),
                       "Y": F.when(key % 11 == 0, gap).otherwise(F.col("Y"))})
    return training_set_v2(tx, c, p, balance=False, rows=star.transaction_rows(spark, folder))


def zone_features(spark, folder):
    sold, c = _staged(spark, folder)
    return zones_of(pair_summary(grid.packed_grid(sold, c)), c)


def training_v1(spark, folder):
    return training_set_v1(*_inputs(spark, folder))


def grid_full_cross(spark, folder):
    return cross.cross_summary(_sold(spark, folder))


def grid_next_week_size(spark, folder):
    _, c, p = _inputs(spark, folder)
    return cross.next_week_summary(_sold(spark, folder), c, p)


def _brand_requests(spark, folder) -> DataFrame:
    """Requests of all customers: of three, one names two packages, one brands, one nothing."""
    key = F.col("customer_id")
    brands = F.array(F.concat(F.lit("Brand#"), (1 + key % 25).cast("string")), F.lit("Brand#3"))
    return star.customers(spark, folder).select(
        key.cast("string").alias("customer_id"), F.when(key % 3 == 1, brands).alias("brands"),
        F.when(key % 3 == 0, F.array(F.lit("hot"), F.lit("small"))).alias("packages"))


def grid_next_week(spark, folder):
    _, c, p = _inputs(spark, folder)
    return cross.next_week_offers(_sold(spark, folder), _brand_requests(spark, folder), c, p,
                                  sales.top_products(star.transactions(spark, folder), 10))


def scoring_v1(spark, folder):
    tx, c, p = _inputs(spark, folder)
    return scoring_set_v1(tx, _brand_requests(spark, folder), c, p)


# --- recommendations -----------------------------------------------------------------------------

def _requests(spark, folder) -> DataFrame:
    """All customers, and for every tenth an id nobody has."""
    ids = star.table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    return ids.unionByName(ids.filter(F.col("customer_id") % 10 == 0)
                           .select((F.col("customer_id") + 1_000_000_000).alias("customer_id")))


def recommend_batch(spark, folder):
    recs = recommend.recommend_batch(star.transactions(spark, folder), _requests(spark, folder))
    return recs.select("customer_id", F.posexplode("recommendations")
                       .alias("position", "product_id"))


def rec_known_customers(spark, folder):
    return recommend.known_customers(star.transactions(spark, folder), _requests(spark, folder))


def rec_backfill(spark, folder):
    tx = star.transactions(spark, folder)
    return recommend.rec_backfill(sales.purchase_history(tx), sales.top_products(tx, 10))


def _request_lines(spark, folder) -> DataFrame:
    """A JSON request per customer: no lists, empty lists, a brand list or a package list."""
    key = F.col("customer_id")
    none = F.lit(None).cast("array<string>")
    brand = F.array(F.concat(F.lit("Brand#"), (1 + key % 25).cast("string")), F.lit("Brand#3"))
    asked = _requests(spark, folder).select(
        key.cast("string").alias("customer_id"),
        F.when(key % 4 == 0, none).when(key % 4 == 1, F.array().cast("array<string>"))
        .when(key % 4 == 2, brand).otherwise(none).alias("brands"),
        F.when(key % 4 == 3, F.array(F.lit("hot"), F.lit("small"))).otherwise(none)
        .alias("packages"))
    return asked.select(F.to_json(F.struct("*")).alias("value"))


def _filtered(spark, folder, distinct=False) -> DataFrame:
    # requests come in and answers go out as JSON
    lines = _request_lines(spark, folder)
    return recommend.recommend_requests(recommend.requests_from_json(lines),
                                        _judged(spark, folder), distinct=distinct)


def predict_filter(spark, folder):
    return _filtered(spark, folder).select(
        "customer_id", F.size("recommended_products").alias("n"),
        F.array_join(F.transform("recommended_products", lambda x: x.cast("string")), ",")
        .alias("products"))


def predict_json(spark, folder):
    return recommend.answers_json(_filtered(spark, folder))


def predict_stream(spark, folder):
    """The requests in two files, taken in one after the other, and once more without news."""
    from cartwheel.streaming.requests import answer_requests, read_answers
    lines = _request_lines(spark, folder)
    drop, answers, state = (scratch_path(spark, n) for n in ("requests", "answers", "state"))
    candidates = stage(_judged(spark, folder), "candidates")
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for k in (0, 1):
        lines.filter(half == k).write.mode("append").text(drop)
        answer_requests(spark, drop, candidates, answers, state)
    answer_requests(spark, drop, candidates, answers, state)
    return read_answers(spark, answers)


def dropped_rows(spark, folder):
    """What the training table leaves out, counted while its sales are written: every 97th order
    undated, every 31st without items, returns of more than was bought."""
    tx, c, p = _inputs(spark, folder)
    key, gap = F.col("order_id"), F.lit(None)
    tx = tx.withColumns({
        "purchase_date": F.when(key % 97 != 0, F.col("purchase_date")),
        "items": F.when(key % 31 != 0, F.col("items") - 20), "customer_id":
        F.when(key % 13 != 0, F.col("customer_id")).otherwise(gap)})
    found: dict = {}
    staged_sales(tx, c, p, found, star.transaction_rows(spark, folder))
    return spark.createDataFrame(sorted(found.items()), "what string, n long")


def recommendation_message(spark, folder):
    return recommend.format_recommendations(_filtered(spark, folder)).select(
        "customer_id", "message")


def filter_options(spark, folder):
    opts = recommend.filter_options(_judged(spark, folder))
    return opts.select(F.explode(F.array(
        F.struct(F.lit("brand").alias("kind"), F.col("brands").alias("v")),
        F.struct(F.lit("package").alias("kind"), F.col("packages").alias("v")))).alias("o")).select(
        "o.kind", F.posexplode("o.v").alias("position", "value"))


def score_positive(spark, folder):
    return _judged(spark, folder).filter(F.col("prediction") == 1).drop("prediction")


# --- metrics, registry and decisions ---------------------------------------------------------------

def class_weight(spark, folder):
    return metrics.class_weight(_judged(spark, folder))


def f1_score(spark, folder):
    return metrics.f1_score(_judged(spark, folder))


def classification_report(spark, folder):
    return metrics.classification_report(_judged(spark, folder))


def _runs(spark, folder) -> DataFrame:
    """Runs written to a registry and read back: one experiment per brand; its five trials are size
    limits 10 to 50 used as a rule."""
    trials = _judged(spark, folder).select(
        "brand", "target", "size", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("trial"))
    trials = trials.withColumn("prediction", (F.col("size") <= F.col("trial") * 10).cast("int"))
    runs = (trials.groupBy(F.col("brand").alias("experiment"), "trial")
            .agg(metrics.f1_expr().alias("valid_f1"))
            .withColumn("run_id", F.concat_ws("-", "experiment", "trial")))
    path = scratch_path(spark, "runs")
    registry.log_runs(runs, path)
    return registry.search_runs(spark, path)


def runs_search(spark, folder):
    return _runs(spark, folder).select("experiment", "run_id", "trial", "valid_f1")


def best_run(spark, folder):
    return registry.best_run(_runs(spark, folder)).select("experiment", "run_id", "valid_f1")


def optimization_history(spark, folder):
    return registry.optimization_history(_runs(spark, folder))


def degradation_decision(spark, folder):
    runs = _runs(spark, folder)
    scores = runs.groupBy("experiment").agg(
        F.max("valid_f1").alias("best_f1"),
        F.max_by("valid_f1", "trial").alias("current_f1"))
    return metrics.degradation_decision(scores)


def weekly_window_events(spark, folder):
    from cartwheel.streaming.windows import weekly_by_key
    events = star.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return weekly_by_key(events, "ts", ["event_type"], "value").select(
        F.col("week"), "event_type", "rows", F.round("total", 6).alias("total"))


# --- preprocessing, model and drift ------------------------------------------------------------


def _gappy(spark, folder) -> DataFrame:
    """Transactions enriched with larger products only, so that attributes have gaps."""
    tx, _, p = _inputs(spark, folder)
    return tx.join(p.filter(F.col("size") > 10), "product_id", "left").select(
        "customer_id", "product_id", "order_id", "items", "size", "brand", "segment", "package")


def _rounded(spark, folder, kind):
    df = _gappy(spark, folder)
    scaled = prep.numeric_scaler(df, ["items", "size"], kind).transform(df)
    return scaled.select("customer_id", "product_id", "order_id",
                         F.round("items_scaled", 6).alias("items_scaled"),
                         F.round("size_scaled", 6).alias("size_scaled"))


def standard_scale(spark, folder):
    return _rounded(spark, folder, "standard")


def minmax_scale(spark, folder):
    return _rounded(spark, folder, "minmax")


def impute_numeric(spark, folder):
    df = _gappy(spark, folder)
    filled = prep.numeric_imputer(df, ["size"], "mean").transform(df)
    return filled.select("customer_id", "product_id", "order_id", "items",
                         F.round("size_filled", 6).alias("size_filled"))


def impute_median(spark, folder):
    df = _gappy(spark, folder)
    filled = prep.numeric_imputer(df, ["size", "items"], "median").transform(df)
    return filled.select("customer_id", "product_id", "order_id", "items", "size_filled",
                         "items_filled")


def impute_mode(spark, folder):
    df = _gappy(spark, folder)
    return prep.mode_imputer(df, ["brand", "segment"]).transform(df).select(
        "customer_id", "product_id", "order_id", "items", "brand_text", "segment_text")


def _encoded(spark, folder, kind):
    """Codes fitted on products of size 26 and more, applied to all products: the LOW segment
    and some sizes are unknown to the encoder."""
    p = star.products(spark, folder)
    stages = prep.category_encoder(p.filter(F.col("size") > 25), ["brand", "segment", "size"], kind)
    return PipelineModel(stages).transform(p)


def encode_onehot(spark, folder):
    slots = {c: vector_to_array(f"{c}_code") for c in ("brand", "segment", "size")}
    return _encoded(spark, folder, "onehot").select("product_id", *[
        F.array_position(v, 1.0).cast("int").alias(f"{c}_slot") for c, v in slots.items()],
        *[F.size(v).alias(f"{c}_slots") for c, v in slots.items()])


def encode_ordinal(spark, folder):
    return _encoded(spark, folder, "ordinal").select("product_id", *[
        F.col(f"{c}_code").cast("int").alias(f"{c}_code") for c in ("brand", "segment", "size")])


def date_features(spark, folder):
    return prep.date_extractor("week").transform(_sold(spark, folder)).select(
        *CELL, "month", "week1")


def _split_table(spark, folder) -> DataFrame:
    return stage(splits.temporal_split(training_v2(spark, folder)), "split")


def _default_model(table):
    part = table.filter(F.col("split") == "train").drop("split")
    return train.fit_model(part, {})


def train_and_score(spark, folder):
    table = _split_table(spark, folder)
    model = _default_model(table)
    return train.score_positive(model, table.filter(F.col("split") == "test")).select(
        *CELL, "target", "split")


def feature_importance(spark, folder):
    table = _split_table(spark, folder)
    return train.feature_importance(_default_model(table), table)


def hyperparameter_search(spark, folder):
    table = _split_table(spark, folder)
    parts = [table.filter(F.col("split") == s).drop("split") for s in ("train", "val")]
    return train.search(*parts, side_by_side=train.N_TRIALS)[1].drop("run_id")


def _newest_drift(spark, folder) -> DataFrame:
    ref, new = tables.latest_week_split(stage(training_v2(spark, folder), "drift"))
    return drift.mmd_drift(ref, new, NUMERIC_V2)


def mmd_rff(spark, folder):
    return _newest_drift(spark, folder)


def drift_distance(spark, folder):
    """The statistic of the drift test and the rows it compares, without the permutations."""
    return _newest_drift(spark, folder).select("n_ref", "n_new", F.round("mmd2", 6).alias("mmd2"))


def drift_decision(spark, folder):
    return drift.drift_decision(_newest_drift(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        scan_transactions, scan_dimensions, csv_roundtrip, archive_range, detect_new_files,
        detect_new_count, ingest_merge, ingest_incremental, weekly_sales_incremental,
        archive_same_range, csv_missing_texts, features_with_gaps, dedupe_transactions,
        enrich_transactions, weekly_sales,
        grid_per_customer, grid_labeled, label_target, split_pos_neg, fill_nulls, top_products,
        rec_history, avg_items, num_orders, periodicity, periodicity_timestamp,
        calendar_features, zone_round, balanced_sample, temporal_split, random_split,
        latest_week_split, zone_features, zone_customers, zone_customers_sketch, grid_full_cross,
        grid_next_week, grid_next_week_size, recommend_batch,
        rec_known_customers, rec_backfill, predict_filter, predict_json,
        predict_stream, dropped_rows,
        recommendation_message, filter_options, score_positive, class_weight, f1_score,
        classification_report, runs_search, best_run, optimization_history,
        degradation_decision, weekly_window_events, standard_scale, minmax_scale,
        impute_numeric, impute_median, impute_mode, encode_onehot, encode_ordinal, date_features,
        train_and_score, feature_importance, hyperparameter_search, mmd_rff, drift_distance,
        drift_decision)
}
QUERIES.update({
    "training_set_v2": training_v2,
    "scoring_set_v2": scoring_v2,
    "training_set_unskewed": training_unskewed,
    "features_point_in_time": features_point_in_time,
    "training_set_v1": training_v1,
    "scoring_set_v1": scoring_v1,
    "total_weekly_purchase": _feature("total_weekly_purchase"),
    "customer_avg_purchase": _feature("customer_avg_purchase"),
    "recent_purchase_trend": _feature("recent_purchase_trend"),
    "product_avg_purchase": _feature("product_avg_purchase"),
    "days_since_last": _feature("last_purchase_week", "days_since_last_purchase"),
})
