"""Finding new input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The two outcomes of the new-data check.
READ_NEW = "read_new_data"
SKIP = "dont_predict"


def file_manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file below ``folder`` (column ``path``). File contents are not read: only the
    path column of the binary source is selected."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(folder).select("path"))


def base_name(path: str = "path"):
    return F.element_at(F.split(F.col(path), "/"), -1)


def detect_new_files(manifest_new: DataFrame, manifest_old: DataFrame) -> DataFrame:
    """Names in the new manifest that the old one does not have."""
    new = manifest_new.select(base_name().alias("file_name")).distinct()
    old = manifest_old.select(base_name().alias("file_name")).distinct()
    return new.join(old, "file_name", "left_anti")


def detect_new_count(manifest_new: DataFrame, manifest_old: DataFrame) -> DataFrame:
    """Decision by file counts only: ingest when the new side has at least as many names."""
    def names(m, alias):
        return m.agg(F.count_distinct(base_name()).alias(alias))
    extra = (names(manifest_new, "n").select("n").scalar()
             - names(manifest_old, "n").select("n").scalar())
    one = manifest_new.sparkSession.range(1)
    return (one.select(extra.alias("extra_files"))
            .withColumn("decision", F.when(F.col("extra_files") >= 0, READ_NEW)
                        .otherwise(SKIP)))


def detect_new_data_count(spark: SparkSession, new_folder: str, old_folder: str) -> DataFrame:
    return detect_new_count(file_manifest(spark, new_folder), file_manifest(spark, old_folder))
