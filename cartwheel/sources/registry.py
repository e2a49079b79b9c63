"""Training runs kept as a parquet table (schema ``RUNS``)."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartwheel.schemas import RUNS


def log_run(spark: SparkSession, path: str, experiment: str, trial: int, valid_f1: float,
            params: dict, run_name: str | None = None) -> str:
    """Append one run; returns its id."""
    run_id = uuid.uuid4().hex
    row = (experiment, run_id, run_name or f"trial_f1_{valid_f1:.4f}", trial, float(valid_f1),
           {k: str(v) for k, v in params.items()}, datetime.now(timezone.utc))
    spark.createDataFrame([row], RUNS).write.mode("append").parquet(path)
    return run_id


def log_runs(runs: DataFrame, path: str) -> None:
    """Append many runs (experiment, run_id, trial, valid_f1; other columns of RUNS if there)."""
    known = {c: F.col(c) for c in runs.columns}
    known.setdefault("run_name", F.format_string("trial_f1_%.4f", "valid_f1"))
    known.setdefault("params", F.lit(None))
    known.setdefault("ts", F.current_timestamp())
    runs.select(*[known[f.name].cast(f.dataType).alias(f.name) for f in RUNS]).write.mode(
        "append").parquet(path)


def search_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    runs = spark.read.schema(RUNS).parquet(path)
    return runs if experiment is None else runs.filter(F.col("experiment") == experiment)


def best_run(runs: DataFrame, experiment: str | None = None) -> DataFrame:
    """The run with the highest validation F1 (of each experiment when none is named); of equal ones
    that of the first trial, whose model a search keeps."""
    best_first = [F.desc_nulls_last("valid_f1"), "trial", "run_id"]
    if experiment is not None:
        return runs.filter(F.col("experiment") == experiment).orderBy(*best_first).limit(1)
    order = Window.partitionBy("experiment").orderBy(*best_first)
    return runs.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def optimization_history(runs: DataFrame) -> DataFrame:
    """Best F1 so far after each trial of an experiment."""
    so_far = (Window.partitionBy("experiment").orderBy("trial")
              .rowsBetween(Window.unboundedPreceding, 0))
    return runs.select("experiment", "trial", "valid_f1",
                       F.max("valid_f1").over(so_far).alias("best_f1"))
