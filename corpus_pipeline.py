"""A pipeline of text preparation over ``documents``: each stage works on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.llm.common import stage, table
from cartwheel.llm.decontaminate import keep_clean
from cartwheel.llm.ngram_join import keep_one_of_each
from cartwheel.llm.pieces_fst import round_trip
from cartwheel.llm.quality import keep_good

MODEL = "piece_bpe_32k.model"

#: Rows that are handed to a Python worker at a time: whole texts, so few enough to stay small.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bounds what a task's JVM and Python side hold of texts on their way; results don't change."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the fences of their language and source."""
    small_batches(spark)
    return keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id."""
    small_batches(spark)
    return keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces, and the text decoded from them with its length."""
    small_batches(spark)
    back = round_trip(docs, public_tokenizers.path(MODEL))
    return back.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces",
                       "n_chars", "text")


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", ngram_jaccard_join),
          ("benchmark decontamination", benchmark_decontamination),
          ("SentencePiece encoding and decoding", sentencepiece)]

#: Quantile sketches, simhash windows and piece paths have no SQL form; tests/llm compares the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
