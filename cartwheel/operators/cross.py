"""The full customers x weeks x products grid, used without ever building it.

Its cells are numbered through three small axes. Sizes and label counts follow from the axes and
the sold cells, and a sample of not-bought cells is drawn by walking a keyed permutation of the
cell numbers, so the cost is that of the sample and not of the product of the axes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartwheel.functions import hash_bucket, hash_long, hash_order, next_week
from cartwheel.operators.sales import CELL
from cartwheel.operators.sampling import take_in_order
from cartwheel.session import stage

PERMUTATION_PASSES = 2
BUCKETS = 4096


def axis(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null values of ``key`` numbered from 0 (column ``<key>_no``).

    Values are ordered inside hash buckets and offset by the sizes of earlier buckets: no task
    sorts more than one bucket, and only the 65,536 bucket sizes meet in one place.
    """
    values = (df.select(key).dropna().distinct()
              .withColumn("_b", hash_bucket(hash_order([key], 0))))
    sizes = values.groupBy("_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_b", F.coalesce(before, F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(key)) - 1
    return (values.withColumn("_r", rank).join(F.broadcast(offsets), "_b")
            .select(key, (F.col("_off") + F.col("_r")).alias(f"{key}_no")))


def cross_summary(sold: DataFrame) -> DataFrame:
    """Per week of the full grid: cells, bought cells, negative cells, and unbought cells."""
    known = sold.dropna(subset=CELL)
    size = sold.agg((F.count_distinct("customer_id") * F.count_distinct("product_id"))
                    .alias("n")).scalar()
    per_week = (sold.dropna(subset=["week"]).groupBy("week").agg(F.lit(1).alias("one"))
                .join(known.groupBy("week").agg(
                    F.count(F.when(F.col("items") > 0, 1)).alias("bought"),
                    F.count(F.when(F.col("items") < 0, 1)).alias("negative")), "week", "left"))
    bought, negative = F.coalesce("bought", F.lit(0)), F.coalesce("negative", F.lit(0))
    return per_week.select("week", size.alias("cells"), bought.alias("bought"),
                           negative.alias("negative"),
                           (size - bought - negative).alias("unbought"))


def next_week_summary(tx_week: DataFrame, cust: DataFrame, prod: DataFrame) -> DataFrame:
    """One row: the week after the newest one and the number of candidates it has."""
    return tx_week.agg(next_week(F.max("week")).alias("week")).select(
        "week", cust.agg(F.count("*")).scalar().alias("customers"),
        prod.agg(F.count("*")).scalar().alias("products")).withColumn(
        "candidates", F.col("customers") * F.col("products"))


def next_week_candidates(tx_week: DataFrame, requests: DataFrame, cust: DataFrame,
                         prod: DataFrame, products_per_bucket: int = 10_000) -> DataFrame:
    """Next week's (customer, product, week) candidates of the requested customers.

    A request names a customer and optionally brands and packages; a null or empty list admits
    every product. Requests are expanded to the brands they admit and meet the products in an
    equi-join on brand, so the work follows the size of the answer. Large brands are spread over
    hash buckets, which split the products of a brand evenly.
    """
    buckets = -(-prod.count() // products_per_bucket) or 1
    brands = prod.select("brand").distinct().agg(
        F.collect_set(F.struct("brand")).alias("all")).scalar()  # one entry per brand
    asked = (requests.join(cust.select(F.col("customer_id").cast("string").alias("_c"),
                                       F.col("customer_id").alias("_id")).distinct(),
                           F.col("customer_id") == F.col("_c"))
             .select(F.col("_id").alias("customer_id"), "brands", "packages").distinct())
    named = F.transform(F.array_distinct("brands"), lambda b: F.struct(b.alias("brand")))
    open_brands = F.col("brands").isNull() | (F.size("brands") == 0)
    asked = (asked.withColumn("_b", F.explode(F.when(open_brands, brands).otherwise(named)))
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
             .select("customer_id", F.col("_b.brand").alias("_brand"), "_part", "packages"))
    shelf = prod.select("product_id", "brand", "package").withColumn(
        "_shelf", F.pmod(F.xxhash64("product_id"), F.lit(buckets)))
    fits = (F.col("packages").isNull() | (F.size("packages") == 0)
            | F.array_contains("packages", F.col("package")))
    week = tx_week.agg(next_week(F.max("week"))).scalar()
    return (asked.join(shelf, F.col("_brand").eqNullSafe(F.col("brand"))
                       & (F.col("_part") == F.col("_shelf")) & fits)
            .select("customer_id", "product_id").distinct().withColumn("week", week))


def next_week_offers(tx_week: DataFrame, requests: DataFrame, cust: DataFrame, prod: DataFrame,
                     pool: DataFrame) -> DataFrame:
    """Next week's (customer, product, week) candidates by the rule that serves recommendations:
    each requested customer's own products and those of ``pool`` (a fixed few rows).

    The result is linear in bought pairs and requests. A request's brands and packages narrow it;
    null or empty lists admit everything, and so does any of several requests of a customer.
    """
    asked = (requests.join(cust.select(F.col("customer_id").cast("string").alias("_c"),
                                       F.col("customer_id").alias("_id")).distinct(),
                           F.col("customer_id") == F.col("_c"))
             .select(F.col("_id").alias("customer_id"), "brands", "packages").distinct())
    own = tx_week.select("customer_id", "product_id").dropna().distinct()
    popular = pool.agg(F.collect_list("product_id")).scalar()
    pairs = asked.join(own, "customer_id").unionByName(
        asked.withColumn("product_id", F.explode(popular)))

    def open_to(wanted, value):
        return (F.col(wanted).isNull() | (F.size(wanted) == 0)
                | F.array_contains(wanted, F.col(value)))

    fits = pairs.join(prod.select("product_id", "brand", "package"), "product_id").filter(
        open_to("brands", "brand") & open_to("packages", "package"))
    week = tx_week.agg(next_week(F.max("week"))).scalar()
    return fits.select("customer_id", "product_id").distinct().withColumn("week", week)


@dataclass(frozen=True)
class AxisSizes:
    customers: int
    weeks: int
    products: int

    @property
    def cells(self) -> int:
        return self.customers * self.weeks * self.products


def _shuffle_numbers(df: DataFrame, sizes: AxisSizes, seed: int) -> DataFrame:
    """Replace the (c, w, p) digits of each row by those of another cell, one to one.

    Each step shifts one digit by a hash of the other two, which can be undone, so the whole is
    a permutation of the grid: distinct inputs give distinct cells.
    """
    for turn in range(PERMUTATION_PASSES):
        for digit, others, size in (("c", ("w", "p"), sizes.customers),
                                    ("w", ("c", "p"), sizes.weeks),
                                    ("p", ("c", "w"), sizes.products)):
            shift = hash_long(F.lit(f"{turn}{digit}"), F.lit(seed), *others)
            # never null, and declared so: a null filter pushed down through all steps would
            # evaluate the whole chain once more per step
            df = df.withColumn(digit, F.coalesce((F.col(digit) + shift) % F.lit(size), F.lit(0)))
    return df


def draw_unbought(spark: SparkSession, sold: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` cells of the full grid without sales, uniformly and without replacement.

    n + (sold cells) draws always contain n unsold ones, because the draws are distinct; the
    first n in draw order are kept. Raises when the grid has fewer unsold cells.
    """
    known = sold.dropna(subset=CELL).filter(F.col("items") != 0)
    customers, weeks, products = (stage(axis(sold, k), k)
                                  for k in ("customer_id", "week", "product_id"))
    counts = known.agg(F.count("*").alias("sold")).select(
        "sold", *[a.agg(F.count("*")).scalar().alias(k) for k, a in
                  (("c", customers), ("w", weeks), ("p", products))]).first()
    sizes = AxisSizes(counts.c, counts.w, counts.p)
    if sizes.cells - counts.sold < n:
        raise ValueError("fewer unsold cells than cells wanted")
    draws = min(sizes.cells, n + counts.sold)
    numbers = spark.range(draws).select(
        F.col("id").alias("_k"), F.expr(f"id % {sizes.customers}").alias("c"),
        F.expr(f"(id div {sizes.customers}) % {sizes.weeks}").alias("w"),
        F.expr(f"id div {sizes.customers * sizes.weeks}").alias("p"))
    cells = (_shuffle_numbers(numbers, sizes, seed)
             .join(weeks, F.col("w") == F.col("week_no"))
             .join(products, F.col("p") == F.col("product_id_no"))
             .join(customers, F.col("c") == F.col("customer_id_no"))
             .select("_k", *CELL))
    free = stage(cells.join(known.select(*CELL), CELL, "left_anti"), "unsold")
    width = max(1, -(-draws // BUCKETS))
    first = take_in_order(free, n, F.expr(f"_k div {width}"), [F.col("_k")])
    return first.select(*CELL, F.lit(0.0).alias("items"))


def balanced_cross(spark: SparkSession, sold: DataFrame, seed: int = 42) -> DataFrame:
    """All bought cells of the full grid and as many unbought ones."""
    bought = sold.dropna(subset=CELL).filter(F.col("items") > 0)
    return bought.select(*CELL, "items").unionByName(
        draw_unbought(spark, sold, bought.count(), seed))
