"""Registered queries against their SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connect

FOLDER = "/root/testdata/sf0.001"
# the remaining keys are compared by running check_queries.py, which takes some minutes
KEYS = ["weekly_sales", "grid_labeled", "balanced_sample", "training_set_v2", "scoring_set_v2",
        "zone_features", "recommend_batch", "predict_filter", "predict_json", "encode_onehot",
        "standard_scale", "temporal_split", "random_split", "grid_full_cross",
        "classification_report", "degradation_decision", "weekly_window_events",
        "ingest_incremental", "features_with_gaps", "impute_median", "impute_mode",
        "grid_next_week", "scoring_set_v1", "training_set_unskewed", "features_point_in_time",
        "weekly_sales_incremental", "archive_same_range", "csv_missing_texts", "predict_stream",
        "dropped_rows", "drift_distance", "zone_customers", "zone_customers_sketch"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", KEYS)
def test_same_as_sql(spark, con, key):
    same, rows, detail = compare(spark, con, FOLDER, key)
    assert same and rows > 0, detail


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 11880
