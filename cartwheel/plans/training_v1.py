"""The earlier feature set: order counts, basket lines and purchase periodicity."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwheel.operators.cross import balanced_cross, next_week_offers
from cartwheel.operators.grid import label_target
from cartwheel.operators.sales import (
    avg_items, num_orders, periodicity, top_products, with_week,
)
from cartwheel.operators.tables import fill_nulls
from cartwheel.plans.training import staged_sales
from cartwheel.session import stage


def attach_history(cells: DataFrame, tx: DataFrame, cust: DataFrame, prod: DataFrame) -> DataFrame:
    """Left-join product and customer history and both dimensions to any cells.

    Everything known per product is joined into one table first, likewise per customer, so the
    cells take part in two joins and not in five.
    """
    by_product = (periodicity(tx).withColumnRenamed("periodicity", "Periodicity")
                  .join(prod, "product_id", "full_outer"))
    by_customer = (num_orders(tx).drop("distinct_orders")
                   .join(avg_items(tx), "customer_id", "full_outer")
                   .join(cust, "customer_id", "full_outer"))
    return fill_nulls(cells.join(by_product, "product_id", "left")
                      .join(by_customer, "customer_id", "left"))


def training_set_v1(tx: DataFrame, cust: DataFrame, prod: DataFrame, seed: int = 42) -> DataFrame:
    """Bought cells and equally many unbought cells of the full grid, with history columns."""
    tx = stage(tx.distinct(), "distinct-sales")  # read by the sales and three histories
    sold = staged_sales(tx, cust, prod)
    cells = balanced_cross(tx.sparkSession, sold, seed)
    return label_target(attach_history(cells, tx, cust, prod)).drop("items")


def scoring_set_v1(tx: DataFrame, requests: DataFrame, cust: DataFrame,
                   prod: DataFrame, pool_size: int = 10) -> DataFrame:
    """Next week's candidates of the requested customers with the history columns."""
    pool = top_products(tx, pool_size)
    tx = stage(tx.distinct(), "distinct-sales")
    cells = next_week_offers(with_week(tx), requests, cust, prod, pool)
    return attach_history(cells, tx, cust, prod)
