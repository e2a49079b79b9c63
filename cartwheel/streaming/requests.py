"""Requests as a stream: JSON lines are answered from scored candidates, each line's batch once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.operators.recommend import answers_json, recommend_requests, requests_from_json
from cartwheel.streaming.ingest import _run_id

ANSWERS = "customer_id string, json string"


def answer_requests(spark: SparkSession, folder: str, candidates: DataFrame, answers: str,
                    checkpoint: str, model=None, distinct: bool = False) -> int:
    """Answer the requests (one JSON object a line) of every file not seen yet, then stop. Returns
    the number of lines read.

    Candidates are a batch table, read anew for each micro-batch and cut down to the customers that
    it asks for before a ``model`` scores them. A micro-batch is written to a partition named by
    the checkpoint's id and its own number, so one that is tried again replaces itself. Lines that
    are no request of a customer are kept below ``<answers>-rejected``.
    """
    read: dict[int, int] = {}

    def answer(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = f"batch={_run_id(session, checkpoint)}-{batch_id}"
        lines = batch.withColumn("r", requests_column("value"))
        known = F.col("r.customer_id").isNotNull()
        found = answers_json(recommend_requests(
            requests_from_json(lines.filter(known)), candidates, model, distinct))
        found.write.mode("overwrite").parquet(f"{answers.rstrip('/')}/{own}")
        lines.filter(~known | known.isNull()).select("value").write.mode("overwrite").parquet(
            f"{answers.rstrip('/')}-rejected/{own}")
        read[batch_id] = batch.count()

    query = (spark.readStream.schema("value string").text(folder).writeStream
             .foreachBatch(answer).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(read.values())


def requests_column(column: str):
    from cartwheel.schemas import REQUESTS
    return F.from_json(column, REQUESTS)


def read_answers(spark: SparkSession, answers: str) -> DataFrame:
    """All answers so far: customer_id, json."""
    try:
        return spark.read.schema(ANSWERS).option("recursiveFileLookup", "true").parquet(answers)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ANSWERS)
