"""Aggregates over transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.functions import nan_to_null, week_start
from cartwheel.session import join_dealt, spread

CELL = ["customer_id", "product_id", "week"]


def with_week(tx: DataFrame) -> DataFrame:
    return tx.withColumn("week", week_start("purchase_date"))


def _items(tx: DataFrame):
    # sums run in double, so a NaN can be told from a missing value whatever the input type
    return F.sum(nan_to_null(F.col("items").cast("double")))


def weekly_sales(tx: DataFrame, rows: int | None = None) -> DataFrame:
    """Items per (customer, product, week). Null keys form their own cells, null items are
    skipped and a cell of only null items is 0. ``rows``: about how many ``tx`` has, if known."""
    return (spread(with_week(tx), rows, *CELL).groupBy(*CELL)
            .agg(F.coalesce(_items(tx), F.lit(0.0)).alias("items")))


def fan_out(sold: DataFrame, cust: DataFrame, prod: DataFrame,
            rows: int | None = None) -> DataFrame:
    """Multiply cell sums by how often their keys occur in the dimensions: what summing the
    enriched transactions would give, without carrying the transactions through the joins.

    A dimension without repeated keys, found before by counting them, takes no join. ``rows``: about
    how many ``sold`` has, if known.
    """
    times = F.col("items")
    for dim, key, n in ((cust, "customer_id", "_nc"), (prod, "product_id", "_np")):
        repeated = (dim.dropna(subset=[key]).groupBy(key).agg(F.count("*").alias(n))
                    .filter(F.col(n) > 1))
        if not repeated.isEmpty():
            sold = join_dealt(sold, repeated, rows, key, "left")
            times = times * F.coalesce(n, F.lit(1))
    return sold.select(*CELL, times.alias("items"))


def purchase_history(tx: DataFrame) -> DataFrame:
    """Items per (customer, product) for all customers at once."""
    return (tx.dropna(subset=["customer_id", "product_id"])
            .groupBy("customer_id", "product_id")
            .agg(F.coalesce(_items(tx), F.lit(0.0)).alias("items")))


def product_totals(tx: DataFrame) -> DataFrame:
    return (tx.dropna(subset=["product_id"]).groupBy("product_id")
            .agg(F.coalesce(_items(tx), F.lit(0.0)).alias("items")))


def top_products(tx: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most sold products; ties go to the smaller id."""
    return product_totals(tx).orderBy(F.desc("items"), F.asc("product_id")).limit(n)


def avg_items(tx: DataFrame) -> DataFrame:
    """Mean number of transaction lines per active week of a customer."""
    weekly = (with_week(tx).dropna(subset=["customer_id", "week"])
              .groupBy("customer_id", "week").agg(F.count("*").alias("lines")))
    return weekly.groupBy("customer_id").agg(F.avg("lines").alias("avg_items"))


def num_orders(tx: DataFrame) -> DataFrame:
    """Transaction lines per customer; the distinct order count is given next to it."""
    per_order = (tx.dropna(subset=["customer_id"]).groupBy("customer_id", "order_id")
                 .agg(F.count("*").alias("lines")))
    return per_order.groupBy("customer_id").agg(
        F.sum("lines").alias("num_orders"), F.count("order_id").alias("distinct_orders"))


def periodicity(tx: DataFrame, grain: str = "date") -> DataFrame:
    """Mean whole days between consecutive purchases of a product; one purchase gives 0.

    Date grain: consecutive gaps add up to last minus first, so no window is needed.
    Timestamp grain: a gap inside one day is below 24 h and counts 0 days, so only the gaps
    between the last purchase of one day and the first of the next active day matter. The
    window then runs over days of a product, never over its transactions.
    """
    tx = tx.dropna(subset=["product_id"])
    at = F.col("purchase_date")
    if grain == "date":
        spans = tx.groupBy("product_id").agg(
            F.datediff(F.max(at), F.min(at)).alias("days"),
            F.count(at).alias("dated"), F.count("*").alias("rows"))
    else:
        daily = tx.groupBy("product_id", at.cast("date").alias("day")).agg(
            F.min(at).alias("first_at"), F.max(at).alias("last_at"),
            F.count(at).alias("dated"), F.count("*").alias("rows"))
        prev = F.lag("last_at").over(Window.partitionBy("product_id").orderBy("day"))
        gap = F.floor(F.timestamp_diff("MICROSECOND", prev, F.col("first_at"))
                      / F.lit(86_400_000_000))
        spans = (daily.withColumn("gap", F.coalesce(gap, F.lit(0)))
                 .groupBy("product_id").agg(F.sum("gap").alias("days"),
                                            F.sum("dated").alias("dated"),
                                            F.sum("rows").alias("rows")))
    mean = F.try_divide(F.col("days").cast("double"), F.col("dated") - 1)
    return spans.select("product_id", F.when(F.col("rows") > 1, mean)
                        .otherwise(F.lit(0.0)).alias("periodicity"))
