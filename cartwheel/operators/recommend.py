"""Recommendations for every requested customer in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.functions import backfill, joined, take_first
from cartwheel.operators.sales import purchase_history, top_products

# List length, size of the popularity pool, and the texts shown to a user.
LIST_SIZE = 5
POOL_SIZE = 10
FOUND_TEXT = "Productos recomendados: "
EMPTY_TEXT = "No hay productos recomendados para este cliente."


def known_customers(tx: DataFrame, requests: DataFrame) -> DataFrame:
    """Requested customers with ``known``: do they have any transaction?"""
    seen = tx.select("customer_id").dropna().distinct().withColumn("known", F.lit(True))
    return (requests.select("customer_id").distinct().join(seen, "customer_id", "left")
            .select("customer_id", F.coalesce("known", F.lit(False)).alias("known")))


def rank_own(history: DataFrame, n: int) -> DataFrame:
    """The ``n`` products a customer bought most. The rank filter is applied before the shuffle
    as well, so a customer with very many products does not move them all."""
    order = Window.partitionBy("customer_id").orderBy(F.desc("items"), F.asc("product_id"))
    return (history.withColumn("position", F.row_number().over(order))
            .filter(F.col("position") <= n))


def popular(tx: DataFrame, n: int) -> Column:
    """The ``n`` most sold products as an array, computed once as a scalar subquery."""
    top = top_products(tx, n).agg(F.sort_array(F.collect_list(
        F.struct((-F.col("items")).alias("o"), "product_id"))).alias("top"))
    return top.select(F.transform("top", lambda t: t["product_id"]).alias("top")).scalar()


def rec_backfill(history: DataFrame, top: DataFrame) -> DataFrame:
    """Popular products each customer of ``history`` has not bought. ``top`` is a short list."""
    listed = top.agg(F.collect_list("product_id").alias("ids")).scalar()
    offers = (history.select("customer_id").distinct()
              .select("customer_id", F.explode(listed).alias("product_id")))
    return offers.join(history.select("customer_id", "product_id"),
                       ["customer_id", "product_id"], "left_anti")


def recommend_batch(tx: DataFrame, requests: DataFrame, n: int = LIST_SIZE,
                    pool: int = POOL_SIZE) -> DataFrame:
    """``recommendations`` per requested customer: own products by quantity, filled up from the
    popularity pool; customers never seen get the most popular products."""
    wanted = requests.select("customer_id").distinct()
    history = purchase_history(tx).join(wanted, "customer_id", "left_semi")
    own = (rank_own(history, n).groupBy("customer_id")
           .agg(F.sort_array(F.collect_list(F.struct("position", "product_id"))).alias("own"))
           .select("customer_id", F.transform("own", lambda r: r["product_id"]).alias("own")))
    best = popular(tx, max(n, pool))
    rec = F.when(F.col("own").isNull(), take_first(best, n)).otherwise(
        backfill("own", take_first(best, pool), n))
    return (wanted.join(own, "customer_id", "left")
            .select("customer_id", rec.alias("recommendations")))


def recommend_requests(requests: DataFrame, candidates: DataFrame, model=None,
                       distinct: bool = False) -> DataFrame:
    """``recommended_products`` per request (customer id as text, optional brand and package
    lists; a null or empty list filters nothing).

    ``candidates`` holds scored cells with ``prediction``, or features when ``model`` is given.
    A product listed for several weeks is counted before the lists are formed, so the list step
    moves one row per product; the lists follow (product, week) order.
    """
    # only what the requests ask for is scored
    who = requests.select(F.col("customer_id").alias("_who")).distinct()
    candidates = candidates.join(
        who, F.col("customer_id").cast("string") == F.col("_who"), "left_semi")
    if model is not None:
        candidates = model.transform(candidates)
    offers = (candidates.filter(F.col("prediction") == 1)
              .groupBy(F.col("customer_id").cast("string").alias("_customer"), "product_id",
                       "brand", "package").agg(F.count("*").alias("_times")))

    def allowed(wanted, value):
        return (F.col(wanted).isNull() | (F.size(wanted) == 0)
                | F.array_contains(wanted, F.col(value)))

    asked = requests.select("customer_id", "brands", "packages").distinct()
    hits = (asked.join(offers, (F.col("customer_id") == F.col("_customer"))
                       & allowed("brands", "brand") & allowed("packages", "package"), "left")
            .groupBy("customer_id", "brands", "packages", "product_id")
            .agg(F.sum("_times").cast("int").alias("_times")))
    lists = hits.groupBy("customer_id", "brands", "packages").agg(F.sort_array(F.collect_list(
        F.when(F.col("product_id").isNotNull(), F.struct("product_id", "_times")))).alias("_l"))
    if distinct:
        products = F.transform("_l", lambda r: r["product_id"])
    else:
        products = F.flatten(F.transform(
            "_l", lambda r: F.array_repeat(r["product_id"], r["_times"])))
    answers = lists.select(F.col("customer_id").alias("_c"), F.col("brands").alias("_b"),
                           F.col("packages").alias("_p"),
                           products.alias("recommended_products"))
    return (requests.join(answers, (F.col("customer_id") == F.col("_c"))
                          & F.col("brands").eqNullSafe(F.col("_b"))
                          & F.col("packages").eqNullSafe(F.col("_p")))
            .drop("_c", "_b", "_p"))


def answers_json(answers: DataFrame, column: str = "recommended_products") -> DataFrame:
    return answers.select("customer_id", F.to_json(F.struct("customer_id", column)).alias("json"))


def requests_from_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse one JSON request per row."""
    from cartwheel.schemas import REQUESTS
    return lines.select(F.from_json(column, REQUESTS).alias("r")).select("r.*")


def format_recommendations(answers: DataFrame,
                           column: str = "recommended_products") -> DataFrame:
    """A readable ``message`` per answer."""
    text = F.concat(F.lit(FOUND_TEXT), joined(column))
    return answers.withColumn("message", F.when(F.size(column) > 0, text)
                              .otherwise(F.lit(EMPTY_TEXT)))


def filter_options(candidates: DataFrame) -> DataFrame:
    """One row with the sorted brand and package choices; a missing value reads ``nan``."""
    def choices(c):
        value = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
        return F.array_sort(F.collect_set(value)).alias(f"{c}s")
    return candidates.agg(choices("brand"), choices("package"))
