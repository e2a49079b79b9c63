"""Features of a cell from what was sold before its week.

Cumulative tables hold what was known at the end of each week: per product, per zone (prefix sums
over one row per key and week) and per customer (in the grid's packed weeks). A cell reads the last
state before its week. States are spread over the weeks they hold for, so that the lookup is
a plain equality join on key and week: a hot product or zone is as many keys as there are weeks.

Only sales of earlier weeks take part, so later sales change no row of an earlier week:

* total_weekly_purchase: what the customer bought in their last active week before;
* customer_avg_purchase: items per cell of the grid known by then (weeks x products so far);
* recent_purchase_trend: share of the customer's last four active weeks with this product;
* product_avg_purchase: items per bought cell of the product so far;
* last_purchase_week: the customer's last active week before, as in the other mode;
* zone figures: bought share of the cells known, items and customers so far.

A figure without any earlier sale is 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.functions import days_between, round_half_even
from cartwheel.operators.grid import each_cell
from cartwheel.operators.tables import fill_nulls
from cartwheel.session import stage

TREND_WEEKS = 4


def cumulative(weekly: DataFrame, keys: list[str], figures: list[str]) -> DataFrame:
    """``figures`` of (keys, week) summed up to and including the week."""
    so_far = (Window.partitionBy(*keys).orderBy("week")
              .rowsBetween(Window.unboundedPreceding, 0))
    return weekly.select(*keys, "week", *[F.sum(c).over(so_far).alias(c) for c in figures])


def before_each_week(states: DataFrame, keys: list[str], last: Column) -> DataFrame:
    """States as of the beginning of each later week up to ``last``: a state holds from the week
    after its own until the next one's week. At most one row per key and calendar week."""
    following = F.lead("week").over(Window.partitionBy(*keys).orderBy("week"))
    spans = (states.withColumn("_from", F.date_add("week", 7))
             .withColumn("_to", F.coalesce(following, last))
             .filter(F.col("_from") <= F.col("_to")))
    return spans.withColumn("week", F.explode(F.sequence(
        "_from", "_to", F.expr("interval 7 days")))).drop("_from", "_to")


def with_zones(cust: DataFrame) -> DataFrame:
    return (cust.fillna(0, ["X", "Y"]).withColumn("zone_X", round_half_even("X"))
            .withColumn("zone_Y", round_half_even("Y")))


def product_states(sold: DataFrame) -> DataFrame:
    weekly = (sold.filter(F.col("items") > 0)
              .groupBy(F.coalesce("product_id", F.lit(0)).alias("product_id"), "week")
              .agg(F.sum("items").alias("items"), F.count("*").alias("cells")))
    return cumulative(weekly, ["product_id"], ["items", "cells"])


def zone_states(sold: DataFrame, cust: DataFrame) -> DataFrame:
    """Per zone and week, over its customers' active weeks: bought cells, items, customers seen for
    the first time, and by how much the cells known of each customer grew."""
    product = F.coalesce("product_id", F.lit(0)), F.isnull("product_id")
    first = sold.groupBy("customer_id", *product).agg(F.min("week").alias("week"))
    first = first.groupBy("customer_id", "week").agg(F.count("*").alias("products"))
    bought = F.col("items") > 0
    weekly = (sold.groupBy("customer_id", "week").agg(
        F.count(F.when(bought, 1)).alias("bought"),
        F.coalesce(F.sum(F.when(bought, F.col("items"))), F.lit(0.0)).alias("items"))
        .join(first, ["customer_id", "week"], "left").fillna(0, ["products"]))
    order = Window.partitionBy("customer_id").orderBy("week")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    weekly = (weekly.withColumn("cells", F.count("*").over(so_far) * F.sum("products").over(so_far))
              .withColumn("_before", F.lag("cells", 1, 0).over(order)))
    zones = with_zones(cust).select("customer_id", "zone_X", "zone_Y")
    per_zone = weekly.join(zones, "customer_id").groupBy("zone_X", "zone_Y", "week").agg(
        F.sum("bought").alias("bought"), F.sum("items").alias("items"),
        F.sum(F.col("cells") - F.col("_before")).alias("cells"),
        F.count(F.when(F.col("_before") == 0, 1)).alias("customers"))
    return cumulative(per_zone, ["zone_X", "zone_Y"], ["bought", "items", "cells", "customers"])


def _share(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))


def point_in_time_features(packed: DataFrame, sold: DataFrame, cust: DataFrame, prod: DataFrame,
                           seed: int | None = None,
                           draw: Callable[..., DataFrame] | None = None) -> DataFrame:
    """The columns of the training table for the cells of a packed grid, or for those that ``draw``
    chooses by their hashes (``draw_balanced``).

    Cells are narrow when they meet the states; attributes are attached after that.
    """
    dated = sold.dropna(subset=["customer_id", "week"]).join(
        cust.select("customer_id").distinct(), "customer_id", "left_semi")
    last = dated.agg(F.max("week").alias("w")).scalar()
    by_product = stage(before_each_week(product_states(dated), ["product_id"], last), "product-weeks")
    by_zone = stage(before_each_week(zone_states(dated, cust), ["zone_X", "zone_Y"], last),
                    "zone-weeks")

    def features(limit: str | None) -> DataFrame:
        return _features(each_cell(packed, seed, limit), by_product, by_zone, cust, prod)

    return draw(features) if draw else features(None)


def _features(rows: DataFrame, by_product: DataFrame, by_zone: DataFrame, cust: DataFrame,
              prod: DataFrame) -> DataFrame:
    """The columns for rows of ``each_cell``, with their ``_h`` if they have one."""
    more = [c for c in rows.columns if c == "_h"]
    week, previous = F.col("cell.week"), F.get("weeks", F.col("pos") - 1)

    def label(k: int) -> Column:
        earlier = F.get("weeks", F.col("pos") - k)["week"]
        return F.when(F.col("pos") >= k, F.map_contains_key("bought", earlier).cast("int"))

    labels = [label(k) for k in range(1, TREND_WEEKS + 1)]
    hits = sum((F.coalesce(x, F.lit(0)) for x in labels), F.lit(0))
    cells = rows.select(
        "customer_id", F.coalesce("product_id", F.lit(0)).alias("product_id"), week.alias("week"),
        F.map_contains_key("bought", week).cast("int").alias("target"),
        F.coalesce(previous["week_total"], F.lit(0.0)).alias("total_weekly_purchase"),
        F.coalesce(F.try_divide(F.col("cell.items_before"), F.col("cell.cells_before")),
                   F.lit(0.0)).alias("customer_avg_purchase"),
        F.coalesce(F.try_divide(hits.cast("double"), F.least(F.col("pos"), F.lit(TREND_WEEKS))),
                   F.lit(0.0)).alias("recent_purchase_trend"),
        previous["week"].alias("last_purchase_week"),
        F.coalesce(days_between(week, previous["week"]), F.lit(-1))
        .alias("days_since_last_purchase"), *more)
    known = cells.join(by_product, ["product_id", "week"], "left").select(
        *cells.columns, _share("items", "cells").alias("product_avg_purchase"))
    placed = known.join(with_zones(cust), "customer_id")
    placed = placed.join(by_zone, ["zone_X", "zone_Y", "week"], "left").select(
        *placed.columns, _share("bought", "cells").alias("zone_avg_purchase_freq"),
        F.coalesce("items", F.lit(0.0)).alias("zone_total_purchases"),
        F.coalesce("customers", F.lit(0)).alias("zone_customer_density"))
    attributes = [c for df in (cust, prod) for c in df.columns if c not in ("customer_id", "product_id")]
    return fill_nulls(placed.join(prod, "product_id", "left").select(
        "customer_id", "week", "product_id", *attributes, "target", "total_weekly_purchase",
        "customer_avg_purchase", "recent_purchase_trend", "product_avg_purchase",
        "last_purchase_week", "days_since_last_purchase", "zone_X", "zone_Y",
        "zone_avg_purchase_freq", "zone_total_purchases", "zone_customer_density", *more), keep=more)
