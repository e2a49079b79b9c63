"""The weekly run: ingest, features, drift check, training when needed, scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.operators.drift import drift_decision, mmd_drift
from cartwheel.operators.metrics import RETRAIN, degradation_decision, f1_expr
from cartwheel.operators.tables import latest_week_split
from cartwheel.plans.train import EXPERIMENT, N_TRIALS, SEED, optimize, score_positive
from cartwheel.plans.training import training_set_v2
from cartwheel.schemas import TRAINING_V2
from cartwheel.sources.files import SKIP
from cartwheel.sources.model_store import ModelStore
from cartwheel.sources.registry import best_run, search_runs
from cartwheel.sources.tables import (
    read_customers, read_products, read_transactions, write_features,
)
from cartwheel.streaming.ingest import ingest_distinct


@dataclass(frozen=True)
class Config:
    new_dir: str
    history_dir: str
    customers: str
    products: str
    work_dir: str
    n_trials: int = N_TRIALS
    seed: int = SEED
    space: dict | None = field(default=None)
    #: "drift" tests the newest week's inputs, "degradation" the model's F1 on the new table
    check: str = "drift"

    def path(self, name: str) -> str:
        return f"{self.work_dir.rstrip('/')}/{name}"


def drift_step(model: PipelineModel, table: DataFrame) -> DataFrame:
    """Drift of the newest week against all others, in the space of the model inputs."""
    prepared = PipelineModel(model.stages[:-1]).transform(table).select(
        "customer_id", "product_id", "week", "features")
    ref, new = latest_week_split(prepared)
    return drift_decision(mmd_drift(ref, new, features="features"))


def degradation_step(model: PipelineModel, table: DataFrame, runs: DataFrame,
                     experiment: str = EXPERIMENT) -> DataFrame:
    """The model's F1 on a labelled table against the registry's best run, and the decision."""
    current = model.transform(table).agg(f1_expr().alias("current_f1"))
    best = best_run(runs, experiment).select(F.col("valid_f1").alias("best_f1"))
    return degradation_decision(current.join(best, F.lit(True), "left"))  # one row each


PENDING, DONE = "pending", "done"


def _state(spark: SparkSession, cfg: Config) -> str:
    """Whether the last run went through; a first run has nothing pending."""
    try:
        return spark.read.schema("state string").parquet(cfg.path("state")).first().state
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return DONE
        raise


def _mark(spark: SparkSession, cfg: Config, state: str) -> None:
    (spark.createDataFrame([(state,)], "state string").coalesce(1).write.mode("overwrite")
     .parquet(cfg.path("state")))


def run_pipeline(spark: SparkSession, cfg: Config) -> dict:
    """One run. Tables pass between the steps as files; decisions are single rows.

    Returns the decision and the paths written. Without new files nothing else is done, unless an
    earlier run took files in and did not come to its end. When there is no usable model the step
    that needs one leads to training.
    """
    before = _state(spark, cfg)
    _mark(spark, cfg, PENDING)
    if not ingest_distinct(spark, cfg.new_dir, cfg.history_dir, cfg.path("ingest"),
                           cells=cfg.path("cells")) and before == DONE:
        _mark(spark, cfg, DONE)
        return {"decision": SKIP}
    tx = read_transactions(spark, cfg.history_dir)
    cust, prod = read_customers(spark, cfg.customers), read_products(spark, cfg.products)

    dropped: dict = {}
    write_features(training_set_v2(tx, cust, prod, cfg.seed, dropped=dropped),
                   cfg.path("training"))
    write_features(spark.createDataFrame(sorted(dropped.items()), "what string, n long")
                   .coalesce(1), cfg.path("dropped"))
    table = spark.read.schema(TRAINING_V2).parquet(cfg.path("training"))
    models = ModelStore(spark, cfg.path("models"))
    out = {"training": cfg.path("training"), "models": cfg.path("models"),
           "dropped": cfg.path("dropped")}
    try:
        model = models.load_newest(EXPERIMENT)
        step = drift_step(model, table) if cfg.check == "drift" else degradation_step(
            model, table, search_runs(spark, cfg.path("runs")))
        decision = step.first().decision
    except Exception as reason:  # noqa: BLE001 - any failure of the check means: train again
        model, decision, out["reason"] = None, RETRAIN, f"{type(reason).__name__}"
    if decision == RETRAIN:
        model, report, _ = optimize(table, cfg.space, cfg.n_trials, cfg.seed,
                                    registry=cfg.path("runs"), store=cfg.path("models"))
        write_features(report, cfg.path("report"))
        out["report"] = cfg.path("report")

    grid = training_set_v2(tx, cust, prod, cfg.seed, balance=False)
    out["scored"] = write_features(score_positive(model, grid), cfg.path("scored"))
    out["decision"] = decision
    _mark(spark, cfg, DONE)
    return out
