"""Incremental ingest of transaction files."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartwheel.schemas import TRANSACTIONS
from cartwheel.streaming.weekly_cells import apply_sales


def transaction_stream(spark: SparkSession, folder: str, schema: T.StructType = TRANSACTIONS,
                       max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def ingest_files(spark: SparkSession, folder: str, history: str, checkpoint: str,
                 schema: T.StructType = TRANSACTIONS, max_files: int | None = None) -> int:
    """Append every file not yet seen to ``history``, each exactly once, then stop. Returns the
    number of rows read. The checkpoint remembers processed files.

    The layout is that of ``ingest_distinct`` (a partition per micro-batch, replaced only when the
    batch is tried again), so both may write to one history and any reader sees all of it.
    """
    read: dict[int, int] = {}

    def append(batch: DataFrame, batch_id: int) -> None:
        own = f"{history.rstrip('/')}/batch={_run_id(batch.sparkSession, checkpoint)}-{batch_id}"
        batch.write.mode("overwrite").parquet(own)
        read[batch_id] = batch.sparkSession.read.schema(schema).parquet(own).count()

    query = (transaction_stream(spark, folder, schema, max_files).writeStream
             .foreachBatch(append).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(read.values())


def dedupe_stream(stream: DataFrame, ts: str, keys: list[str] | None = None,
                  late: str = "7 days") -> DataFrame:
    """Drop repeats of a row (all columns, or ``keys``) within the watermark. State older than
    ``late`` is forgotten and rows later than that are dropped; use ``ingest_distinct`` where
    repeats must be found against the whole history."""
    return (stream.withWatermark(ts, late)
            .dropDuplicatesWithinWatermark(keys or list(stream.columns)))


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its query; a new checkpoint has another one."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


def _stored(spark: SparkSession, history: str, schema: T.StructType, but: str) -> DataFrame | None:
    """Rows of every file below ``history``, however it was laid out, except the partition ``but``.
    None if there is no such folder yet."""
    try:
        rows = (spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(history))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.filter(~F.contains(F.col("_metadata.file_path"), F.lit(f"/{but}/"))).select(
        *schema.names)


def ingest_distinct(spark: SparkSession, folder: str, history: str, checkpoint: str,
                    schema: T.StructType = TRANSACTIONS, max_files: int | None = None,
                    date: str = "purchase_date", cells: str | None = None) -> int:
    """Append new files' rows that the history does not hold yet, each distinct row once. Returns
    the number of rows read; 0 means there was no new file. With ``cells`` the weekly cells kept
    there (weekly_cells.py) take in the appended rows in the same batch.

    Every micro-batch goes to a partition of its own, named by the checkpoint's id and the batch's
    number and overwritten only when that batch is tried again. It is compared with all other
    files of the history, whoever wrote them; rows outside the batch's dates are skipped by the
    scan.
    """
    names = list(schema.names)

    read: dict[int, int] = {}

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = f"batch={_run_id(session, checkpoint)}-{batch_id}"
        found = batch.agg(F.count("*").alias("n"), *([
            F.min(date).alias("low"), F.max(date).alias("high"),
            F.count_if(F.col(date).isNull()).alias("gaps")] if date in names else [])).first()
        read[batch_id] = found.n
        fresh = batch.distinct()
        old = _stored(session, history, schema, own)
        if old is not None:
            if date in names:
                inside = F.col(date).between(F.lit(found.low), F.lit(found.high))
                old = old.filter(inside | F.col(date).isNull() if found.gaps else inside)
            old = old.select(*[F.col(c).alias(f"_{c}") for c in names])
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
            fresh = fresh.join(old, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{history.rstrip('/')}/{own}")
        if cells is not None:
            apply_sales(session, cells, own.removeprefix("batch="),
                        session.read.schema(schema).parquet(f"{history.rstrip('/')}/{own}"))

    query = (transaction_stream(spark, folder, schema, max_files).writeStream
             .foreachBatch(append).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(read.values())
