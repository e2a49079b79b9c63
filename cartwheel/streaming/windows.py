"""Weekly tumbling windows; the same code serves batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Windows of one week whose edge falls on Monday (the epoch was a Thursday).
WEEK = "7 days"
MONDAY_OFFSET = "4 days"


def weekly_by_key(events: DataFrame, ts: str, keys: list[str], value: str,
                  late: str | None = None) -> DataFrame:
    """Row count and sum of ``value`` per Monday week and key. ``late`` sets the watermark a
    stream needs to close its weeks."""
    if late is not None:
        events = events.withWatermark(ts, late)
    out = (events.groupBy(F.window(ts, WEEK, WEEK, MONDAY_OFFSET).alias("w"), *keys)
           .agg(F.count("*").alias("rows"), F.sum(value).alias("total")))
    return out.select(F.col("w.start").cast("date").alias("week"), *keys, "rows", "total")


def weekly_sales_stream(tx: DataFrame, ts: str = "purchase_ts", late: str = "7 days") -> DataFrame:
    """Weekly items per (customer, product) of a transaction stream."""
    return weekly_by_key(tx, ts, ["customer_id", "product_id"], "items", late).select(
        "customer_id", "product_id", "week", F.coalesce("total", F.lit(0.0)).alias("items"))
