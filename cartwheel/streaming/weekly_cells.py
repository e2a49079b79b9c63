"""Weekly cells kept up to date: a batch of new sales rewrites only the weeks it touches.

The table is partitioned by week. A batch is summed, the touched weeks' partitions are read (and no
other), and both are added up into a written table, which then replaces those partitions. Two
steps are logged per batch, so a batch that is tried again neither counts twice nor starts from
partitions that are half replaced: once the sums are logged they are only written again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.operators.sales import CELL, weekly_sales
from cartwheel.schemas import CELLS, CELL_LOG

SUMMED, APPLIED = "summed", "applied"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_cells(spark: SparkSession, root: str) -> DataFrame:
    """The weekly cells: customer_id, product_id, week, items."""
    return _read(spark, f"{root.rstrip('/')}/cells", CELLS).select(*CELL, "items")


def touched_cells(spark: SparkSession, root: str, fresh: DataFrame) -> DataFrame:
    """Stored cells of the weeks in which ``fresh`` has sales. The weeks are at most the
    calendar's, so they reach the scan as partition filters."""
    weeks = [r.week for r in fresh.select("week").distinct().collect()]
    dated = [w for w in weeks if w is not None]
    wanted = F.col("week").isin(dated)
    return read_cells(spark, root).filter(wanted | F.col("week").isNull() if None in weeks
                                          else wanted)


def apply_sales(spark: SparkSession, root: str, batch: str, tx: DataFrame) -> bool:
    """Add a batch of new transactions (none of which was in an earlier batch) to the cells of
    ``root``. Returns whether anything was written: a batch that was applied before is not."""
    root = root.rstrip("/")
    steps = {r.step for r in _read(spark, f"{root}/log", CELL_LOG).filter(
        F.col("batch") == batch).collect()}
    if APPLIED in steps:
        return False
    sums = f"{root}/sums/{batch}"
    if SUMMED not in steps:
        fresh = weekly_sales(tx)
        merged = (touched_cells(spark, root, fresh).unionByName(fresh).groupBy(*CELL)
                  .agg(F.sum("items").alias("items")))
        merged.write.mode("overwrite").parquet(sums)
        _log(spark, root, batch, SUMMED)
    cells = spark.read.schema(CELLS).parquet(sums)
    (cells.repartition("week").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("week").parquet(f"{root}/cells"))
    _log(spark, root, batch, APPLIED)
    return True


def _log(spark: SparkSession, root: str, batch: str, step: str) -> None:
    spark.createDataFrame([(batch, step)], CELL_LOG).coalesce(1).write.mode("append").parquet(
        f"{root}/log")
