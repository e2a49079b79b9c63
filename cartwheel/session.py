"""Session builder for local runs, and where intermediate tables go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "cartwheel") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent in a local session a fresh temporary folder is used, and it
    is remembered in the session. On a cluster executors would not see each other's files there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.cartwheel.scratch", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        folder = tempfile.mkdtemp(prefix="cartwheel-")
        spark.conf.set("spark.cartwheel.scratch", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows that a task sorts or hashes at once where a shuffle is dealt by ``spread``.
TASK_ROWS = 500_000


def spread(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys`` into a partition per TASK_ROWS of them, so
    that a task's memory does not grow with the input.

    Joined shuffle partitions are as many as the cores, however much there is. While that leaves a
    task no more than TASK_ROWS rows, or when ``rows`` is unknown, ``df`` stays as it is.
    """
    if rows is None:
        return df
    parts = -(-rows // TASK_ROWS)
    if parts <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parts, *keys)


def join_dealt(df: DataFrame, other: DataFrame, rows: int | None, key: str,
               how: str = "inner") -> DataFrame:
    """``df``, of about ``rows`` rows, joined by ``key`` to ``other``, which has few rows of a key.

    Where ``spread`` deals, the rows of ``df`` are not sorted: they stream past a hash table of their
    partition's part of ``other``, so a key that many of them share takes no memory either.
    """
    dealt = spread(df, rows, key)
    if dealt is not df:
        other = spread(other, rows, key).hint("shuffle_hash")
    return dealt.join(other, key, how)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage without keeping blocks on executors, so a lost executor costs only the
    task it was running; the columnar copy still lets later steps prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
