"""Explicit schemas of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _fields(spec: str) -> T.StructType:
    """Schema from "name type, ..." without needing a running session."""
    pairs = (part.split() for part in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TRANSACTIONS = _fields(
    "customer_id long, product_id long, order_id long, purchase_date date, items double"
)

CUSTOMERS = _fields(
    "customer_id long, region_id int, zone_id int, customer_type string, "
    "Y double, X double, num_deliver_per_week int, num_visit_per_week int"
)

PRODUCTS = _fields(
    "product_id long, brand string, category string, sub_category string, "
    "segment string, package string, size int"
)

REQUESTS = _fields("customer_id string, brands array<string>, packages array<string>")

RUNS = _fields(
    "experiment string, run_id string, run_name string, trial int, valid_f1 double, "
    "params map<string,string>, ts timestamp"
)

COMMITS = _fields(
    "version long, experiment string, run_id string, valid_f1 double, folder string, ts timestamp"
)

CELLS = _fields("customer_id long, product_id long, items double, week date")

CELL_LOG = _fields("batch string, step string")

TRAINING_V2 = _fields(
    "customer_id long, week date, product_id long, region_id int, zone_id int, "
    "customer_type string, Y double, X double, num_deliver_per_week int, "
    "num_visit_per_week int, brand string, category string, sub_category string, "
    "segment string, package string, size int, target int, "
    "total_weekly_purchase double, customer_avg_purchase double, "
    "recent_purchase_trend double, product_avg_purchase double, last_purchase_week date, "
    "days_since_last_purchase int, zone_X double, zone_Y double, "
    "zone_avg_purchase_freq double, zone_total_purchases double, zone_customer_density long"
)

# The model inputs, by branch of the preprocessing.
CATEGORICAL_V2 = [
    "brand", "category", "sub_category", "segment", "package", "customer_type",
    "zone_X", "zone_Y",
]
NUMERIC_V2 = [
    "size", "num_deliver_per_week", "total_weekly_purchase", "customer_avg_purchase",
    "recent_purchase_trend", "product_avg_purchase", "days_since_last_purchase",
    "zone_avg_purchase_freq", "zone_total_purchases", "zone_customer_density",
]
CATEGORICAL_V1 = [
    "region_id", "zone_id", "num_deliver_per_week", "num_visit_per_week", "brand",
    "category", "sub_category", "segment", "package", "size", "customer_type",
]
