"""Two-sample drift test: kernel mean distance with a permutation p-value, over all rows.

The squared mean distance under a Gaussian kernel needs all pairs of rows. Random Fourier features
(Rahimi and Recht 2007) turn it into distances of mean vectors, which one pass of partial sums
gives: the cost is linear, nothing is sampled, and no pair is formed. The permutation test
(Gretton et al. 2012) relabels each row from a hash of its content, so all relabelled sums come out
of the same pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

# Significance level, permutations, and the fewest rows a side must have.
ALPHA = 0.05
N_PERM = 100
MIN_ROWS = 10
N_FEATURES = 128

_RESULT = "mmd2 double, p_value double, is_drift boolean, n_ref long, n_new long"


def _relabelled(keys: np.ndarray, salt: np.ndarray, share: float) -> np.ndarray:
    """Whether the hash of (row key, permutation) to [0, 1), the splitmix64 finaliser, is below
    ``share``; compared as integers of 53 bits."""
    with np.errstate(over="ignore"):
        z = keys[:, None] + salt[None, :] * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)) < np.uint64(math.ceil(share * float(1 << 53)))


def _drawn(seed: int, name: str, *at: int) -> float:
    """A number in (0, 1) from md5, so that any engine can recompute the features."""
    text = "|".join(map(str, (seed, name, *at)))
    return (int(hashlib.md5(text.encode()).hexdigest()[:12], 16) + 0.5) / 16 ** 12


def fourier_constants(width: int, n_features: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Standard normal directions (width x n_features; Box and Muller) and phases."""
    w = np.array([[math.sqrt(-2.0 * math.log(_drawn(seed, "r", i, j)))
                   * math.cos(2.0 * math.pi * _drawn(seed, "a", i, j)) for j in range(n_features)]
                  for i in range(width)])
    return w, 2.0 * np.pi * np.array([_drawn(seed, "b", j) for j in range(n_features)])


def _partial_sums(width: int, sigma: float, share: float, n_perm: int, n_features: int, seed: int):
    """Batch function: sums of the features of label-1 rows for the true labels (perm 0) and each
    relabelling (1..n_perm), and over all rows (perm -1), one small set per partition."""
    def run(batches: Iterator[pd.DataFrame | dict]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(seed)
        w, b = fourier_constants(width, n_features, seed)
        w = w / sigma
        salt = rng.integers(1, 2 ** 63, n_perm, dtype=np.uint64)
        sums = np.zeros((n_perm + 2, n_features + 2))
        for batch in batches:
            x = batch["x"] if isinstance(batch, dict) else np.stack(batch["x"].to_numpy())
            n = len(x)
            phi = np.empty((n, n_features + 2))
            phi[:, :-2] = np.sqrt(2.0 / n_features) * np.cos(x @ w + b)
            phi[:, -2] = np.einsum("ij,ij->i", phi[:, :-2], phi[:, :-2])
            phi[:, -1] = 1.0
            label = np.empty((n, n_perm + 2))
            label[:, 0] = 1.0
            label[:, 1] = batch["is_new"]
            label[:, 2:] = _relabelled(np.asarray(batch["key"]).astype(np.uint64), salt, share)
            sums += label.T @ phi
        yield pd.DataFrame({"perm": np.arange(-1, n_perm + 1), "s": list(sums)})
    return run


def _in_arrow(run, width: int):
    """The same for Arrow batches, whose vectors are read as one matrix without an object a row."""
    def read(batch: pa.RecordBatch) -> dict:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return {"x": x, **{c: batch.column(c).to_numpy() for c in ("is_new", "key")}}

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(map(read, batches)):
            yield pa.record_batch({"perm": pa.array(out["perm"], pa.int32()),
                                   "s": pa.array(list(out["s"]), pa.list_(pa.float64()))})
    return arrow


def _distance(one: np.ndarray, rest: np.ndarray) -> float:
    """Unbiased squared mean distance from the sums of two groups; the last two entries of each
    are the summed squared norms and the row count."""
    n1, n0 = one[-1], rest[-1]
    if n1 < 2 or n0 < 2:
        return -np.inf
    a, b = one[:-2], rest[:-2]
    return float((a @ a - one[-2]) / (n1 * (n1 - 1)) + (b @ b - rest[-2]) / (n0 * (n0 - 1))
                 - 2.0 * (a @ b) / (n1 * n0))


def median_squared_distance(rows: DataFrame, n: int) -> float | None:
    """Median of the squared distance over about 0.3 ``n`` pairs of the ``n`` rows (x, key).

    Rows are dealt by a hash of their key into n / 2 slots; a slot's rows of least and greatest
    second hash are a pair. Every row may be drawn, each slot keeps two rows however many copies
    fall into it (partial results are merged before the shuffle), and the median comes from a mergeable
    quantile sketch. Rows with one key never pair with each other. None without a pair.
    """
    row = F.struct(F.xxhash64("key", F.lit(2)).alias("h"), "x")
    slots = (rows.groupBy(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(max(1, n // 2))).alias("slot"))
             .agg(F.min(row).alias("a"), F.max(row).alias("b")).filter("a.h < b.h"))
    gaps = F.zip_with("a.x", "b.x", lambda u, v: (u - v) * (u - v))
    return slots.agg(F.percentile_approx(
        F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g), 0.5, 10_000)).first()[0]


def mmd_drift(ref: DataFrame, new: DataFrame, cols: list[str] | None = None,
              features: str | None = None, alpha: float = ALPHA, n_perm: int = N_PERM,
              n_features: int = N_FEATURES, seed: int = 42,
              min_rows: int = MIN_ROWS, width: str = "mean") -> DataFrame:
    """One row: distance, p-value, decision and both row counts. Inputs are numeric ``cols``
    (scaled to unit variance here) or a ready vector column ``features``. With fewer than
    ``min_rows`` rows on a side the distance and p-value are null and there is no drift.
    The kernel's width squared is half the mean squared distance of two rows (exact, no pass of its
    own), or with ``width="median"`` half the median, from hash-matched pairs. Where most pairs are
    equal, so that the median is 0, the mean is taken.
    """
    if width not in ("mean", "median"):
        raise ValueError(f"width is mean or median, not {width!r}")
    spark = ref.sparkSession
    both = ref.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    if features is None:
        vec = array_to_vector(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0))
                                        for c in cols]))
        ident = F.xxhash64(*[F.col(c) for c in sorted(both.columns) if c != "_new"])
    else:
        vec = F.col(features)
        ident = F.xxhash64(*[F.col(c) for c in sorted(ref.columns) if c != features])
    rows = both.select(vec.alias("v"), F.col("_new"), ident.alias("key"))
    head = rows.agg(F.sum(F.lit(1) - F.col("_new")).alias("n0"), F.sum("_new").alias("n1"),
                    Summarizer.metrics("mean", "variance").summary(F.col("v")).alias("s")).first()
    n0, n1 = int(head.n0 or 0), int(head.n1 or 0)
    if n0 < min_rows or n1 < min_rows:
        return spark.createDataFrame([(None, None, False, n0, n1)], _RESULT)

    from pyspark.ml.functions import vector_to_array
    var = np.asarray(head.s.variance.toArray())
    x = vector_to_array("v")
    if features is None:
        # unit variance per column; a constant column drops out
        scale = np.where(var > 0, 1.0 / np.sqrt(np.where(var > 0, var, 1.0)), 0.0)
        mean = head.s.mean.toArray()
        x = F.array(*[(x[i] - float(mean[i])) * float(scale[i]) for i in range(len(var))])
        var = (var > 0).astype(float)
    # mean squared distance of two rows is twice the total variance: half of it sets the width
    sigma = float(np.sqrt(var.sum())) or 1.0
    if width == "median":
        middle = median_squared_distance(rows.select(x.alias("x"), "key"), n0 + n1)
        sigma = math.sqrt(middle / 2.0) if middle else sigma
    run = _partial_sums(len(var), sigma, n1 / (n0 + n1), n_perm, n_features, seed)
    parts = rows.select(x.alias("x"), F.col("_new").alias("is_new"), "key").mapInArrow(
        _in_arrow(run, len(var)), "perm int, s array<double>")
    sums = {r.perm: np.asarray(r.s.toArray()) for r in parts.groupBy("perm").agg(
        Summarizer.sum(array_to_vector("s")).alias("s")).collect()}
    seen = _distance(sums[0], sums[-1] - sums[0])
    others = [_distance(sums[k], sums[-1] - sums[k]) for k in range(1, n_perm + 1)]
    p = (1 + sum(d >= seen for d in others)) / (1 + n_perm)
    return spark.createDataFrame([(seen, p, p < alpha, n0, n1)], _RESULT)


def drift_decision(result: DataFrame) -> DataFrame:
    """Add the next step: retrain on drift, otherwise predict."""
    from cartwheel.operators.metrics import PREDICT, RETRAIN
    return result.withColumn("decision", F.when(F.col("is_drift"), RETRAIN).otherwise(PREDICT))
