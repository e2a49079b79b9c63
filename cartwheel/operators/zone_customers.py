"""Distinct customers of zones: exact, and by sketches that batches add to without reading sales again.

A sketch (HyperLogLog) per zone and week is a few hundred bytes to a few KB whatever the number of
customers, and the sketch of several weeks, batches or zones is the union of theirs. A customer who
buys in many batches or weeks counts once, so batches may overlap. The relative standard error of
an estimate is about 1.04 / sqrt(2 ** precision); small counts are exact.

Undated sales and sales without a customer are left out, as are customers that no row of the
dimension places; missing coordinates are 0, as in the zone features.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartwheel.functions import round_half_even
from cartwheel.operators.sales import with_week

ZONE = ["zone_X", "zone_Y"]
PRECISION = 12
SKETCHES = "zone_X double, zone_Y double, week date, customers binary"


def _buyers(tx: DataFrame, cust: DataFrame) -> DataFrame:
    """Distinct (zone, week, customer). Narrow rows; sales are made distinct before the join."""
    placed = (cust.fillna(0, ["X", "Y"]).filter("customer_id is not null")
              .select("customer_id", round_half_even("X").alias("zone_X"),
                      round_half_even("Y").alias("zone_Y")).distinct())
    return (with_week(tx).filter("week is not null and customer_id is not null")
            .select("customer_id", "week").distinct().join(placed, "customer_id"))


def zone_customers(tx: DataFrame, cust: DataFrame) -> DataFrame:
    """zone_X, zone_Y, week, customers (distinct in the week), customers_so_far (up to the week).

    A customer is new to a zone once, so the distinct count so far is a running sum of new ones: the
    window runs over one row per week of a zone, never over its customers.
    """
    buyers = _buyers(tx, cust)
    first = buyers.groupBy(*ZONE, "customer_id").agg(F.min("week").alias("week"))
    new = first.groupBy(*ZONE, "week").agg(F.count("*").alias("new"))
    weekly = buyers.groupBy(*ZONE, "week").agg(F.count("*").alias("customers"))
    so_far = Window.partitionBy(*ZONE).orderBy("week")
    return (weekly.join(new, [*ZONE, "week"], "left")
            .select(*ZONE, "week", "customers",
                    F.sum(F.coalesce("new", F.lit(0))).over(so_far).alias("customers_so_far")))


def zone_sketches(tx: DataFrame, cust: DataFrame, precision: int = PRECISION) -> DataFrame:
    """zone_X, zone_Y, week, customers (a sketch). Partial sketches are merged before the shuffle."""
    return (_buyers(tx, cust).groupBy(*ZONE, "week")
            .agg(F.hll_sketch_agg("customer_id", F.lit(precision)).alias("customers")))


def add_batch(spark: SparkSession, root: str, batch: str, tx: DataFrame, cust: DataFrame,
              precision: int = PRECISION) -> None:
    """Write the sketches of a batch of sales below ``root``. Nothing that was stored is read or
    changed, and a batch that is tried again replaces its own folder only."""
    zone_sketches(tx, cust, precision).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/batch={batch}")


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    """One sketch per zone and week: the union over the batches; empty before the first one."""
    try:
        stored = spark.read.schema(SKETCHES).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], SKETCHES)
    return stored.groupBy(*ZONE, "week").agg(F.hll_union_agg("customers").alias("customers"))


def estimated_customers(sketches: DataFrame, *by: str) -> DataFrame:
    """``by`` (such as the zone, or zone and week) and the estimated distinct customers."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))
