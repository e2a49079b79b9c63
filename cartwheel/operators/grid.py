"""The customer x product x week grid.

The grid is kept *packed*: one row per (customer, product) with the weeks of that pair. A pair has
at most one cell per calendar week, so a packed row is bounded, the join that makes the grid moves
pairs instead of cells, and cells are only unpacked where they are used.

Packed columns: customer_id, product_id, weeks array<struct<week, week_total, ...>> in order,
bought map<week, items> with the cells above 0, n_rows, n_pos, s_items. ``week_total`` is what the
customer bought in that week over all products; a grid's weeks also say what was known before.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.functions import hash_after, hash_lead
from cartwheel.operators.sales import CELL
from cartwheel.operators.tables import dedupe
from cartwheel.session import join_dealt, spread, stage

# A customer owning more than 1/HEAVY_SHARE of all sold cells is expanded by broadcast. At most
# HEAVY_SHARE customers can be that large, whatever the data, so the broadcast is bounded.
HEAVY_SHARE = 2000


def _join_weeks(pairs: DataFrame, weeks: DataFrame, sold: DataFrame,
                heavy_share: int, rows: int | None = None) -> DataFrame:
    """Pairs (at most ``rows``, if known) with their customer's weeks. Pairs of a heavy customer stay
    spread over the partitions of the pair table; the others meet their customer in a shuffle."""
    limit = sold.agg(F.count("*").alias("n")).scalar() / F.lit(heavy_share)
    heavy = weeks.filter(F.col("sold_cells") > limit)
    light = weeks.filter(F.col("sold_cells") <= limit)
    return (pairs.join(F.broadcast(heavy), "customer_id")
            .unionByName(spread(pairs, rows, "customer_id").join(light, "customer_id"))
            .drop("sold_cells"))


def _pair_key() -> list:
    """The pair as plain values (a missing product is 0 and marked), so that grouping by it and
    joining on it need one and the same shuffle."""
    return ["customer_id", F.coalesce("product_id", F.lit(0)).alias("_product"),
            F.isnull("product_id").alias("_no_product")]


def attach_to_pairs(pairs: DataFrame, attributes: DataFrame | None) -> DataFrame:
    """Pairs grouped by ``_pair_key`` with the attributes of the same pair; pairs without any
    leave. Only the attributes are shuffled."""
    key = ["customer_id", "_product", "_no_product"]
    if attributes is not None:
        rest = [c for c in attributes.columns if c not in ("customer_id", "product_id")]
        pairs = pairs.join(attributes.select(*_pair_key(), *rest), key)
    product = F.when(~F.col("_no_product"), F.col("_product"))
    return pairs.select("customer_id", product.alias("product_id"),
                        *[c for c in pairs.columns if c not in key])


def _sold_pairs(sold: DataFrame) -> DataFrame:
    """Pairs by ``_pair_key``: what was bought in which week, and the weeks of negative sums."""
    positive = F.col("items") > 0
    return sold.groupBy(*_pair_key()).agg(
        F.map_from_entries(F.collect_list(F.when(positive, F.struct("week", "items"))))
        .alias("bought"),
        F.collect_list(F.when(F.col("items") < 0, F.col("week"))).alias("_negative"),
        F.count(F.when(positive, 1)).alias("n_pos"),
        F.coalesce(F.sum(F.when(positive, F.col("items"))), F.lit(0.0)).alias("s_items"))


def _without_negative(packed: DataFrame) -> DataFrame:
    kept = F.filter("weeks", lambda w: ~F.array_contains("_negative", w["week"]))
    return packed.withColumn(
        "weeks", F.when(F.size("_negative") > 0, kept).otherwise(F.col("weeks")))


def packed_grid(sold: DataFrame, cust: DataFrame | None = None,
                heavy_share: int = HEAVY_SHARE, attributes: DataFrame | None = None) -> DataFrame:
    """Every product a customer ever bought, in every week the customer bought anything.

    Cells without sales count 0 items; cells whose sum is negative are left out, undated sales
    have no week and no cell. With ``cust`` only customers present there stay. ``attributes`` (by
    customer_id and product_id) are attached before the weeks are, while pairs are still narrow.
    """
    sold = sold.dropna(subset=["customer_id", "week"])
    pairs = attach_to_pairs(_sold_pairs(sold), attributes)
    weeks = customer_weeks(sold)
    if cust is not None:
        weeks = weeks.join(cust.select("customer_id"), "customer_id", "left_semi")
    return (_without_negative(_join_weeks(pairs, weeks, sold, heavy_share))
            .withColumn("n_rows", F.size("weeks"))
            .select("customer_id", "product_id", "weeks", "bought", "n_rows", "n_pos", "s_items",
                    *[c for c in pairs.columns if attributes is not None and c in attributes.columns
                      and c not in ("customer_id", "product_id")]))


class Weeks(NamedTuple):
    """The weeks (week, week_total) of known customers as a written table, apart for ``heavy`` ones (null:
    there are none); ``rows``: about how many cells were sold."""

    light: DataFrame
    heavy: DataFrame | None
    rows: int

    def open(self, pairs: DataFrame, stats: DataFrame | None = None) -> DataFrame:
        """``pairs`` (with ``_negative``) with their weeks: a packed grid. ``stats`` of customers are
        joined to the weeks, a row per customer, and come with them."""
        light = self.light if stats is None else join_dealt(
            self.light, stats, self.rows, "customer_id")
        dealt = spread(light, self.rows, "customer_id")
        if dealt is light:
            packed = pairs.join(light, "customer_id")
        else:  # few customers are in a partition; pairs stream past them
            packed = spread(pairs, self.rows, "customer_id").join(
                (dealt if stats is None else light).hint("shuffle_hash"), "customer_id")
        if self.heavy is not None:
            heavy = F.broadcast(self.heavy)
            heavy = heavy if stats is None else F.broadcast(stats.join(heavy, "customer_id"))
            packed = packed.unionByName(pairs.join(heavy, "customer_id"))
        return _without_negative(packed)


def stored_weeks(sold: DataFrame, cust: DataFrame, heavy_share: int = HEAVY_SHARE) -> Weeks:
    sold = sold.dropna(subset=["customer_id", "week"])
    rows = sold.count()
    weeks = stage(spread(_weekly(sold, cust, rows), rows, "customer_id").groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("week", "week_total"))).alias("weeks"),
        F.sum("cells").alias("sold_cells")), "customer-weeks")
    many = F.col("sold_cells") > rows / heavy_share
    heavy = weeks.filter(many).drop("sold_cells")
    return Weeks(weeks.filter(~many).drop("sold_cells"), None if heavy.isEmpty() else heavy, rows)


def grid_pairs(sold: DataFrame, weeks: Weeks) -> DataFrame:
    """The packed grid of the customers in ``weeks``, with the weeks of negative sums."""
    sold = sold.dropna(subset=["customer_id", "week"])
    if weeks.heavy is None:  # no customer is too large for one task: one shuffle of narrow cells
        sold = spread(sold, weeks.rows, "customer_id")
    return weeks.open(attach_to_pairs(_sold_pairs(sold), None)).withColumn(
        "n_rows", F.size("weeks"))


def customer_weeks(sold: DataFrame) -> DataFrame:
    """customer_id, weeks, sold_cells: what each customer bought per week, in order of weeks.

    ``items_before`` and ``cells_before`` of a week are what was known before it: the items bought,
    and the cells of the grid that these weeks and the products sold in them make. The window
    runs over one row per week of a customer.
    """
    first = sold.groupBy(*_pair_key()).agg(F.min("week").alias("week"))
    first = first.groupBy("customer_id", "week").agg(F.count("*").alias("new_products"))
    weekly = sold.groupBy("customer_id", "week").agg(
        F.coalesce(F.sum(F.when(F.col("items") > 0, F.col("items"))), F.lit(0.0))
        .alias("week_total"), F.count("*").alias("cells"))
    before = (Window.partitionBy("customer_id").orderBy("week")
              .rowsBetween(Window.unboundedPreceding, -1))
    known = weekly.join(first, ["customer_id", "week"], "left").select(
        "customer_id", "week", "week_total", "cells",
        F.coalesce(F.sum("week_total").over(before), F.lit(0.0)).alias("items_before"),
        (F.count("*").over(before) * F.coalesce(F.sum("new_products").over(before), F.lit(0)))
        .alias("cells_before"))
    return known.groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("week", "week_total", "items_before", "cells_before")))
        .alias("weeks"), F.sum("cells").alias("sold_cells"))


def each_cell(packed: DataFrame, seed: int | None = None, limit: str | None = None) -> DataFrame:
    """A row per cell of a packed grid: its place ``pos`` in ``weeks`` and the ``cell`` there.

    With ``seed`` also ``_h``, null where something was bought and else the cell's hash; unbought
    cells from ``limit`` on are left out.
    """
    if seed is None:
        return packed.select("*", F.posexplode("weeks").alias("pos", "cell"))
    rows = packed.select("*", hash_lead(["customer_id", "product_id"]).alias("_lead"),
                         F.posexplode("weeks").alias("pos", "cell"))
    bought = F.map_contains_key("bought", F.col("cell.week"))
    hashed = hash_after("_lead", F.unix_date("cell.week"), seed)
    if limit is not None:
        rows = rows.filter(bought | (hashed < limit))
    return rows.withColumn("_h", F.when(~bought, hashed)).drop("_lead")


class Parts(NamedTuple):
    """What the labelled grid is made of, as written tables: ``sold`` cells, their pairs, what known
    customers bought per week (rows of ``heavy`` ones, if there are any, go by broadcast); about how
    many cells are sold, and the grid's (bought, unbought) cells."""

    sold: DataFrame
    pairs: DataFrame
    weekly: DataFrame
    heavy: DataFrame | None
    rows: int
    sizes: tuple[int, int]


def grid_parts(sold: DataFrame, cust: DataFrame, heavy_share: int = HEAVY_SHARE) -> Parts:
    rows = sold.count()
    sold = sold.dropna(subset=["customer_id", "week"])
    pairs = stage(dedupe(sold.select("customer_id", "product_id"), rows), "pairs")
    weekly = stage(_weekly(sold, cust, rows), "customer-weeks")
    customers = stage(_per_customer(weekly), "customers")
    heavy = customers.filter(F.col("sold_cells") > rows / heavy_share).select("customer_id")
    return Parts(sold, pairs, weekly, None if heavy.isEmpty() else heavy, rows,
                 tuple(_sizes(pairs, customers).first()))


def cells_below(parts: Parts, seed: int, limit: str | None) -> DataFrame:
    """Bought cells of the labelled grid, and unbought ones whose hash ``_h`` is below ``limit``.

    Bought cells are sold ones. Others are hashed as narrow rows, and only those below the limit are
    compared with the sold cells.
    """
    key = ["customer_id", "_product", "_no_product", "week"]
    item, total = F.col("items"), F.col("week_total").alias("total_weekly_purchase")
    weekly = parts.weekly.select("customer_id", "week", "week_total")
    bought = parts.sold.filter(item > 0).join(weekly, ["customer_id", "week"])
    bought = bought.select(*CELL, "items", total, F.lit(None).cast("string").alias("_h"))
    pairs = parts.pairs.withColumn("_lead", hash_lead(["customer_id", "product_id"]))
    if parts.heavy is None:
        cells = spread(pairs, parts.rows, "customer_id").join(weekly, "customer_id")
    else:
        hot = F.broadcast(parts.heavy)
        cells = (spread(pairs, parts.rows, "customer_id")
                 .join(weekly.join(hot, "customer_id", "left_anti"), "customer_id")
                 .unionByName(pairs.join(F.broadcast(
                     weekly.join(hot, "customer_id", "left_semi")), "customer_id")))
    hashed = hash_after("_lead", F.unix_date("week"), seed)
    cells = (cells if limit is None else cells.filter(hashed < limit)).select(
        *_pair_key(), "product_id", "week", "week_total", hashed.alias("_h"))
    sold = spread(parts.sold.filter(item != 0).select(*_pair_key(), "week"), parts.rows, *key)
    if limit is not None:  # about as many as sold cells; a partition's can be kept in a hash table
        cells, sold = spread(cells, parts.rows, *key), sold.hint("shuffle_hash")
    unbought = cells.join(sold, key, "left_anti").select(
        *CELL, F.lit(0.0).alias("items"), total, "_h")
    return label_target(bought.unionByName(unbought))


def with_totals(rows: DataFrame) -> DataFrame:
    """Labelled cells with what their customer bought in their week, if they have no such column."""
    if "total_weekly_purchase" in rows.columns:
        return rows
    totals = rows.groupBy("customer_id", "week").agg(F.sum("items").alias("total_weekly_purchase"))
    return rows.join(totals, ["customer_id", "week"], "left")


def pack(rows: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """Packed form of any set of labelled cells (for instance a balanced sample)."""
    rows = with_totals(rows)
    week = F.struct("week", F.col("total_weekly_purchase").alias("week_total"))
    positive = F.col("items") > 0
    return attach_to_pairs(rows.groupBy(*_pair_key()).agg(
        F.sort_array(F.collect_list(week)).alias("weeks"),
        F.map_from_entries(F.collect_list(F.when(positive, F.struct("week", "items"))))
        .alias("bought"),
        F.count("*").cast("int").alias("n_rows"),
        F.count(F.when(positive, 1)).alias("n_pos"), F.sum("items").alias("s_items")), attributes)


def unpack(packed: DataFrame) -> DataFrame:
    """One row per cell, with the binary label."""
    flat = packed.select("customer_id", "product_id", "bought", F.explode("weeks").alias("w"))
    return label_target(flat.select(
        "customer_id", "product_id", F.col("w.week").alias("week"),
        F.coalesce(F.col("bought")[F.col("w.week")], F.lit(0.0)).alias("items"),
        F.col("w.week_total").alias("total_weekly_purchase")))


def label_target(grid: DataFrame) -> DataFrame:
    return grid.withColumn("target", F.when(F.col("items") > 0, 1).otherwise(0))


def split_pos_neg(grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bought and not-bought cells. Negative and null quantities fall in neither."""
    return grid.filter(F.col("items") > 0), grid.filter(F.col("items") == 0)


def grid_per_customer(sold: DataFrame, cust: DataFrame,
                      heavy_share: int = HEAVY_SHARE, rows: int | None = None) -> DataFrame:
    """Grid keys with the customer's attributes; customers missing from ``cust`` leave, and one
    that is repeated there repeats its cells. ``rows``: about how many ``sold`` has, if known."""
    sold = sold.dropna(subset=["customer_id", "week"])
    pairs = dedupe(sold.select("customer_id", "product_id"), rows)
    weekly = spread(sold.select("customer_id", "week"), rows, "customer_id", "week").groupBy(
        "customer_id", "week").agg(F.count("*").alias("cells"))
    weeks = spread(weekly, rows, "customer_id").groupBy("customer_id").agg(
        F.collect_list("week").alias("weeks"), F.sum("cells").alias("sold_cells"))
    joined = _join_weeks(pairs, weeks.join(cust, "customer_id"), sold, heavy_share, rows)
    return (joined.withColumn("week", F.explode("weeks"))
            .select(*CELL, *[c for c in cust.columns if c != "customer_id"]))


def grid_labeled(sold: DataFrame, cust: DataFrame) -> DataFrame:
    """Every grid cell with its items and label (items >= 0)."""
    return unpack(packed_grid(sold, cust)).drop("total_weekly_purchase")


def _weekly(sold: DataFrame, cust: DataFrame, rows: int | None) -> DataFrame:
    """What customers of ``cust`` bought per week, and how many cells they have there."""
    item = F.col("items")
    weekly = spread(sold.select("customer_id", "week", "items"), rows, "customer_id", "week")
    return weekly.groupBy("customer_id", "week").agg(
        F.coalesce(F.sum(F.when(item > 0, item)), F.lit(0.0)).alias("week_total"),
        F.count("*").alias("cells"), F.count(F.when(item > 0, 1)).alias("bought"),
        F.count(F.when(item < 0, 1)).alias("negative")
    ).join(cust.select("customer_id"), "customer_id", "left_semi")


def _per_customer(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("customer_id").agg(
        F.count("*").alias("n_weeks"), F.sum("cells").alias("sold_cells"),
        F.sum("bought").alias("bought"), F.sum("negative").alias("negative"))


def _sizes(pairs: DataFrame, customers: DataFrame) -> DataFrame:
    """A customer has products x weeks cells, so nothing has to be expanded to count them."""
    products = pairs.groupBy("customer_id").agg(F.count("*").alias("products"))
    cells = F.col("products") * F.col("n_weeks")
    return products.join(customers, "customer_id").agg(
        F.coalesce(F.sum("bought"), F.lit(0)).alias("bought"),
        F.coalesce(F.sum(cells - F.col("bought") - F.col("negative")), F.lit(0))
        .alias("unbought"))


def grid_sizes(sold: DataFrame, cust: DataFrame, rows: int | None = None) -> DataFrame:
    """One row: bought and unbought cells of the labelled grid, from the sold cells alone.
    ``rows``: about how many ``sold`` has, if known."""
    sold = sold.dropna(subset=["customer_id", "week"])
    return _sizes(dedupe(sold.select("customer_id", "product_id"), rows),
                  _per_customer(_weekly(sold, cust, rows)))
