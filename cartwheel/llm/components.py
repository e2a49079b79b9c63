"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import stage


def _contract(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its larger (``large``) or its smaller neighbours to the least of them."""
    if large:
        pairs = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"),
                                                             F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select(
        "u", F.least("u", "least").alias("least"))
    joined = pairs.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"),
                                             F.col("least").alias("v")).distinct()
    return (joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionAll(least.select("u", F.col("least").alias("v")))
            .filter("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, label): each node of ``edges`` (u, v) with the least node it can reach.

    Each round is written to the shared folder, so the plan stays short and a lost executor costs
    only its tasks; the number of rounds grows with the logarithm of the graph's size.
    """
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                              F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    while True:
        now = stage(_contract(_contract(now, True), False), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == sign:
            break
        sign = tuple(found)
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return labels.unionAll(roots)
