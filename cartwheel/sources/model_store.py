"""Fitted models in immutable folders, made visible by a commit.

A model is written below ``<root>/<run_id>`` and never again. After that one row is appended to
the small table ``<root>/commits``. Readers look at commits only, so a model that was being written
when its job ended is never seen; the same run may be saved again then, as the half-written
folder is no commit's. A newer commit of the same run points to a folder of its own.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.schemas import COMMITS


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self, experiment: str | None = None) -> DataFrame:
        """All commits (schema ``COMMITS``); none if nothing was saved yet."""
        try:
            rows = self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], COMMITS)
        return rows if experiment is None else rows.filter(F.col("experiment") == experiment)

    def save(self, model: PipelineModel, run_id: str, experiment: str,
             valid_f1: float | None = None) -> str:
        """Write the model, then commit it; returns its folder."""
        taken = self.commits().filter(F.col("run_id") == run_id).count()
        folder = run_id if not taken else f"{run_id}-{uuid.uuid4().hex}"
        writer = model.write()
        (writer if taken else writer.overwrite()).save(f"{self.root}/{folder}")
        self._commit(run_id, experiment, valid_f1, folder)
        return f"{self.root}/{folder}"

    def _commit(self, run_id: str, experiment: str, valid_f1: float | None, folder: str) -> None:
        last = self.commits().agg(F.max("version")).first()[0]
        row = ((last or 0) + 1, experiment, run_id, valid_f1, folder, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(
            f"{self.root}/commits")

    def newest(self, experiment: str | None = None) -> DataFrame:
        """The last commit, as one row (none if there is no commit)."""
        return self.commits(experiment).orderBy(F.desc("version"), F.desc("ts"), "run_id").limit(1)

    def load(self, commit: DataFrame) -> PipelineModel:
        """The model of the (first) row of a commits table."""
        found = commit.first()
        if found is None:
            raise LookupError(f"no committed model below {self.root}")
        return PipelineModel.load(f"{self.root}/{found.folder}")

    def load_newest(self, experiment: str | None = None) -> PipelineModel:
        return self.load(self.newest(experiment))

    def load_best(self, runs: DataFrame, experiment: str) -> PipelineModel:
        """The committed model of the run with the highest F1 in the registry; of several commits
        of that run the last."""
        scored = runs.filter(F.col("experiment") == experiment).select(
            "run_id", F.col("valid_f1").alias("_f1"))
        return self.load(self.commits(experiment).join(scored, "run_id").orderBy(
            F.desc_nulls_last("_f1"), "run_id", F.desc("version")).limit(1))
