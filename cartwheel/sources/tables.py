"""Table readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartwheel.functions import nan_to_null, yyyymmdd
from cartwheel.schemas import CUSTOMERS, PRODUCTS, TRAINING_V2, TRANSACTIONS


# Texts that mean a missing value in CSV files.
MISSING = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>", "#N/A", "-nan",
           "-NaN", "#NA", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN", "#N/A N/A"]


def _nan_free(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def read_transactions(spark: SparkSession, folder: str | list[str],
                      schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """All parquet files of one or more folders as one scan; columns are matched by name and
    absent ones are null. NaN becomes null."""
    paths = [folder] if isinstance(folder, str) else list(folder)
    return _nan_free(spark.read.schema(schema).option("recursiveFileLookup", "true")
                     .parquet(*paths))


def read_customers(spark: SparkSession, path: str, schema: T.StructType = CUSTOMERS) -> DataFrame:
    return _nan_free(spark.read.schema(schema).parquet(path))


def read_products(spark: SparkSession, path: str, schema: T.StructType = PRODUCTS) -> DataFrame:
    return _nan_free(spark.read.schema(schema).parquet(path))


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Overwrite ``path``; CSV gets a header row, parquet is the default between stages."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType = TRAINING_V2,
                     missing: list[str] = MISSING) -> DataFrame:
    """CSV with a header and a given schema, in one pass and without inference.

    Texts in ``missing`` are null in columns of every type. Two further columns report what did
    not parse: ``_rejected`` names the columns whose text is no value of their type (null there),
    ``_line`` holds a line with too few or too many fields; both are empty for good rows.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]
                         + [T.StructField("_line", T.StringType())])
    raw = (spark.read.schema(texts).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_line").csv(path))
    given = {f.name: F.when(~F.trim(f.name).isin(missing), F.col(f.name)) for f in schema}
    typed = {f.name: given[f.name] if isinstance(f.dataType, T.StringType)
             else given[f.name].try_cast(f.dataType) for f in schema}
    bad = F.array(*[F.when(given[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in typed])
    return raw.select(*[c.alias(n) for n, c in typed.items()],
                      F.array_compact(bad).alias("_rejected"), "_line")


def read_features_csv(spark: SparkSession, path: str, schema: T.StructType = TRAINING_V2,
                      rejects: str | None = None) -> DataFrame:
    """The rows of a CSV whose fields all parse. The others are written as parquet to ``rejects``;
    without such a folder they stay, with null where a field is no value of its type."""
    rows = read_csv_checked(spark, path, schema)
    if rejects is None:
        return rows.select(*schema.names)
    good = (F.size("_rejected") == 0) & F.col("_line").isNull()
    rows.filter(~good).write.mode("overwrite").parquet(rejects)
    return rows.filter(good).select(*schema.names)


def date_range(tx: DataFrame, column: str = "purchase_date") -> DataFrame:
    """One row: first and last purchase date as yyyyMMdd text."""
    return tx.agg(yyyymmdd(F.min(column)).alias("start_date"),
                  yyyymmdd(F.max(column)).alias("end_date"))


def archive_batch(df: DataFrame, root: str, batch: str | None = None) -> str:
    """Write a batch below ``root`` under a name carrying its date range; returns that path.

    Inside it the batch has a folder of its own, so batches of the same dates stand side by side.
    Only a batch that is written again under the same ``batch`` id replaces itself.
    """
    span = date_range(df).first()
    path = f"{root.rstrip('/')}/transactions_{span.start_date}_{span.end_date}.parquet"
    df.write.mode("overwrite").parquet(f"{path}/batch={batch or uuid.uuid4().hex}")
    return path
