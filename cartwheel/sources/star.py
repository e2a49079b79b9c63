"""The three input tables expressed over a TPC-H-like star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def transaction_rows(spark: SparkSession, folder: str) -> int:
    """Lines, counted from the footers of the files: about as many as transactions."""
    return table(spark, folder, "lineitem").count()


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # the join's partitions are also those of distinct transactions and of their sums' first step
    rows = transaction_rows(spark, folder)
    lines, orders = spread(lines, rows, "l_orderkey"), spread(orders, rows, "o_orderkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("purchase_date"),
        F.col("l_quantity").alias("items"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    c, n = table(spark, folder, "customer"), table(spark, folder, "nation")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("customer_id"), F.col("n_regionkey").alias("region_id"),
        F.col("c_nationkey").alias("zone_id"), F.col("c_mktsegment").alias("customer_type"),
        (F.lit(-34.0) + (key * 53 % 100) / F.lit(100.0) + F.lit(3e-3)).alias("Y"),
        (F.lit(-71.0) + (key * 37 % 200) / F.lit(100.0) + F.lit(3e-3)).alias("X"),
        (1 + key % 6).cast("int").alias("num_deliver_per_week"),
        (1 + key % 3).cast("int").alias("num_visit_per_week"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"), F.get(words, F.lit(1)).alias("sub_category"),
        F.when(F.col("p_size") <= 16, "LOW").when(F.col("p_size") <= 33, "MID")
        .otherwise("PREMIUM").alias("segment"),
        F.get(words, F.lit(0)).alias("package"), F.col("p_size").alias("size"))


# The same three tables as SQL text, valid in Spark and in other engines.
TRANSACTIONS_SQL = """
SELECT o_custkey AS customer_id, l_partkey AS product_id, o_orderkey AS order_id,
       CAST(o_orderdate AS DATE) AS purchase_date, l_quantity AS items
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CUSTOMERS_SQL = """
SELECT c_custkey AS customer_id, n_regionkey AS region_id, c_nationkey AS zone_id,
       c_mktsegment AS customer_type,
       -34e0 + ((c_custkey * 53) % 100) / 1e2 + 3e-3 AS Y,
       -71e0 + ((c_custkey * 37) % 200) / 1e2 + 3e-3 AS X,
       CAST(1 + c_custkey % 6 AS INT) AS num_deliver_per_week,
       CAST(1 + c_custkey % 3 AS INT) AS num_visit_per_week
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PRODUCTS_SQL = """
SELECT p_partkey AS product_id, p_brand AS brand, p_type AS category,
       split_part(p_name, ' ', 2) AS sub_category,
       CASE WHEN p_size <= 16 THEN 'LOW' WHEN p_size <= 33 THEN 'MID' ELSE 'PREMIUM' END
           AS segment,
       split_part(p_name, ' ', 1) AS package, p_size AS size
FROM part"""
