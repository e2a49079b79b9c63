"""Purchase, recency and zone features over a packed grid.

Statistics come from a narrow pair table (one row per customer and product), never from unpacked
cells. What a row needs from other rows of its pair is read from the pair's own arrays, and what it
needs from earlier products of its customer is carried over as at most three labels. No window or
join therefore gathers all cells of one customer, product or zone. Statistics are joined to narrow
pairs before these get their weeks, so arrays do not go through those joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.functions import days_between, round_half_even
from cartwheel.operators.grid import each_cell
from cartwheel.operators.tables import fill_nulls
from cartwheel.session import spread

TREND_ROWS = 4
PAIR = ["customer_id", "product_id"]


def _label(week):
    # a week is in the map exactly when something was bought in it
    return F.when(F.col("bought")[week["week"]] > 0, 1).otherwise(0)


def _last(items: str, n: int):
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)


def pair_summary(packed: DataFrame, *more: str) -> DataFrame:
    """Row count, bought cells, items and the labels of the last rows of each pair, and the columns
    ``more``."""
    return packed.select(*PAIR, "n_rows", "n_pos", "s_items",
                         F.transform(_last("weeks", TREND_ROWS - 1), _label).alias("tail"), *more)


def cell_totals(cells: DataFrame, key: str) -> DataFrame:
    """Row count, bought cells and items of labelled cells, summed by ``key``."""
    items = F.col("items")
    return cells.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.count(F.when(items > 0, 1)).alias("n_pos"),
        F.coalesce(F.sum(items), F.lit(0.0)).alias("s_items"))


def customer_stats(pairs: DataFrame, cust: DataFrame) -> DataFrame:
    """Customer attributes with mean items per row, zone, and the zone's purchase frequency,
    volume and number of customers. Zones are aggregated over customers, not over cells."""
    totals = pairs.groupBy("customer_id").agg(
        F.sum("n_rows").alias("_rows"), F.sum("n_pos").alias("_pos"),
        F.sum("s_items").alias("_items"))
    # gaps are filled before zones are made, so customers without coordinates share zone 0
    known = (totals.join(cust, "customer_id").fillna(0, ["X", "Y"])
             .withColumn("zone_X", round_half_even("X"))
             .withColumn("zone_Y", round_half_even("Y")))
    zones = (known.groupBy("zone_X", "zone_Y").agg(
        (F.sum("_pos") / F.sum("_rows")).alias("zone_avg_purchase_freq"),
        F.sum("_items").alias("zone_total_purchases"),
        F.count_distinct("customer_id").alias("zone_customer_density")))
    return (known.join(zones, ["zone_X", "zone_Y"], "left")
            .withColumn("customer_avg_purchase", F.col("_items") / F.col("_rows"))
            .drop("_rows", "_pos", "_items"))


def product_stats(pairs: DataFrame, prod: DataFrame) -> DataFrame:
    """Product attributes with mean items per row; unknown products keep null attributes.

    A missing product id is product 0, here and in the order of products.
    """
    means = (pairs.groupBy(F.coalesce("product_id", F.lit(0)).alias("product_id"))
             .agg((F.sum("s_items") / F.sum("n_rows")).alias("product_avg_purchase")))
    return means.join(prod, "product_id", "left")


def carried_labels(pairs: DataFrame, *more: str) -> DataFrame:
    """Per pair, the labels of the customer's last rows before this product (oldest first), and the
    columns ``more``.

    The window runs over one small row per product of a customer, so the catalogue bounds it.
    """
    n = TREND_ROWS - 1
    before = (Window.partitionBy("customer_id").orderBy(F.coalesce("product_id", F.lit(0)))
              .rowsBetween(-n, -1))
    return (pairs.select(*PAIR, F.flatten(F.collect_list("tail").over(before)).alias("_labels"),
                         *more)
            .select(*PAIR, _last("_labels", n).alias("carry"), *more))


def pair_attributes(pairs: DataFrame, by_customer: DataFrame, by_product: DataFrame,
                    *more: str) -> DataFrame:
    """Carried labels, both statistics and the columns ``more`` per pair: narrow rows without weeks.

    ``by_customer`` is matched inner and ``by_product`` left. Both are usually small enough for
    Spark to broadcast them on their own size; when they are not, the adaptive skew join splits a
    hot customer or product.
    """
    known = carried_labels(pairs, *more).join(by_customer, "customer_id")
    stats = by_product.withColumnRenamed("product_id", "_p")
    return known.join(stats, F.coalesce("product_id", F.lit(0)) == F.col("_p"), "left").drop("_p")


def _columns(rows: DataFrame, attributes: list[str], more: list[str]) -> DataFrame:
    """The columns of a training table in order, gaps filled, and ``more`` that are left as they are."""
    out = rows.select(
        "customer_id", "week", "product_id", *attributes, "target", "total_weekly_purchase",
        "customer_avg_purchase", "recent_purchase_trend", "product_avg_purchase",
        "last_purchase_week",
        F.coalesce(days_between("week", "last_purchase_week"), F.lit(-1))
        .alias("days_since_last_purchase"),
        "zone_X", "zone_Y", "zone_avg_purchase_freq", "zone_total_purchases",
        "zone_customer_density", *more)
    return fill_nulls(out, keep=more)


def packed_features(packed: DataFrame, attributes: list[str], seed: int | None = None,
                    limit: str | None = None) -> DataFrame:
    """Training columns for the cells of a packed table that holds ``pair_attributes`` (of which
    ``attributes`` are passed on); ``seed`` and ``limit`` choose them as in ``each_cell``."""
    rows = each_cell(packed, seed, limit).withColumn(
        "product_id", F.coalesce("product_id", F.lit(0)))

    def label_back(k):
        # k rows up: inside this product, or in the labels carried over from earlier products
        i = F.col("pos") - k
        return F.when(i >= 0, _label(F.get("weeks", i))).otherwise(
            F.get("carry", F.size("carry") + i))

    total, seen = _label(F.col("cell")), F.lit(1)
    for k in range(1, TREND_ROWS):
        total = total + F.coalesce(label_back(k), F.lit(0))
        seen = seen + F.when(label_back(k).isNotNull(), 1).otherwise(0)
    return _columns(rows.withColumns({
        "week": F.col("cell.week"), "target": _label(F.col("cell")),
        "total_weekly_purchase": F.col("cell.week_total"),
        "recent_purchase_trend": total / seen,
        "last_purchase_week": F.get("weeks", F.col("pos") - 1)["week"]}),
        attributes, [] if seed is None else ["_h"])


def cell_features(cells: DataFrame, by_customer: DataFrame, by_product: DataFrame,
                  attributes: list[str], rows: int | None = None) -> DataFrame:
    """The same for labelled cells (about ``rows``, if known) as they are, one row each.

    A customer's rows pass through one window in order of products and weeks, so none may have so
    many that a task can't hold them.
    """
    order = Window.partitionBy("customer_id").orderBy("product_id", "_no_product", "week")
    cells = cells.select(
        "customer_id", F.coalesce("product_id", F.lit(0)).alias("product_id"),
        F.isnull("product_id").alias("_no_product"), "week", "total_weekly_purchase",
        F.when(F.col("items") > 0, 1).otherwise(0).alias("target"))
    dealt = spread(cells, rows, "customer_id")
    if dealt is not cells:
        # where cells are dealt, so are both statistics: of a file that few columns are read from
        # Spark expects too little, and would send millions of its rows through the driver
        by_customer = spread(by_customer, rows, "customer_id").hint("shuffle_hash")
        by_product = spread(by_product, rows, "product_id").hint("shuffle_hash")

    def before(c, k=1):
        return F.lag(c, k).over(order)

    same = (before("product_id") == F.col("product_id")) & (
        before("_no_product") == F.col("_no_product"))
    labels = [F.col("target"), *[before("target", k) for k in range(1, TREND_ROWS)]]
    total = sum((F.coalesce(x, F.lit(0)) for x in labels), F.lit(0))
    seen = sum((x.isNotNull().cast("int") for x in labels), F.lit(0))
    known = dealt.select("*", (total / seen).alias("recent_purchase_trend"),
                         F.when(same, before("week")).alias("last_purchase_week"))
    known = known.drop("_no_product").join(by_customer, "customer_id")
    return _columns(spread(known, rows, "product_id").join(by_product, "product_id", "left"),
                    attributes, [])


FIGURES = {"zone_X", "zone_Y", "zone_avg_purchase_freq", "zone_total_purchases",
           "zone_customer_density", "customer_avg_purchase", "product_avg_purchase", *PAIR}


def passed_on(*stats: DataFrame) -> list[str]:
    """Columns of the dimensions in statistics tables, in order."""
    return [c for df in stats for c in df.columns if c not in FIGURES]


def zone_features(pairs: DataFrame, cust: DataFrame) -> DataFrame:
    """Zone and its statistics per customer, from a pair table."""
    return customer_stats(pairs, cust.select("customer_id", "X", "Y")).select(
        "customer_id", "zone_X", "zone_Y", "zone_avg_purchase_freq", "zone_total_purchases",
        "zone_customer_density")
