"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartwheel.session import stage  # noqa: F401 - re-exported to the operators

MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_text_as_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    column = batch.column(name)
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split() cuts at exactly these six characters."""
    return text.split()


def give_back() -> None:
    """Returns free memory to the system: a worker process outlives its task, and what it keeps
    counts against its executor while others' tasks run there."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bound so that a task's memory stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers for the places of a window; any odd values serve.
PLACES = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & MASK | 1) for i in range(64)]


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, in order; empty when there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * PLACES[0]
    for k in range(1, width):
        total = total + mix64(words[k:k + n] + np.uint64(k)) * PLACES[k]
    return mix64(total)


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; fewer words make one shingle."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return window_hashes(np.append(words, np.uint64(len(words))), len(words) + 1)
    return np.unique(window_hashes(words, width))


def record(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch from lists or arrays, one a field."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is built from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
