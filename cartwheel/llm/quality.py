"""Quality rules with thresholds learned per language and source.

Every document is measured (words, symbols, repeated lines and words). Mergeable quantile sketches of
the measures are kept per (language, source); merged, they serve per language and for all documents.
A document is held against the quantiles of its own group, or of the next wider one while a group
has too few documents: an upper fence lies ``SPREAD`` times the distance from the lower quartile to
the median above the median, plus a margin. The lower half is used because rejects pile up above, so
up to half of a group may be bad without moving its fence. Two fixed rules come before: too few
words, and more than half of the words in repeated windows.

Cases: null and empty texts have no words and fail; null languages and sources form groups like any
other value; null doc_ids and repeated rows are rows like any other; further columns are passed on
untouched by the filter (measures are held in one struct whose name no column has); an empty table
gives an empty result. Sketches are approximate above some hundred documents a group (rank error
about 1 %), so a document lying on a fence may fall on either side; what a run decides is fixed by
the table of fences it writes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm.common import stage, words_of

# Fixed values of the measures.
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))

MIN_GROUP = 100
SPREAD = 12.0
#: Ratios held against fences, with the margin that is always allowed.
MARGINS = {"symbol_ratio": 0.1, "dup_line_ratio": 0.4, "repeat_ratio": 0.4, "word_length": 0.5}
#: Ratios that may also lie too low.
TWO_SIDED = ("word_length",)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words in ``width``-word windows that occur at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    window = ids[:n]
    for k in range(1, width):  # pairs of numbers below 2**31 are packed and numbered anew
        _, window = np.unique((window << 31) | ids[k:k + n], return_inverse=True)
    again = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k:k + n] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The values of MEASURES for one text."""
    words = words_of(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(text.translate(None, SPACES + CONTINUATION)),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            len(lines), repeat_words(words))


def _measure_series(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = [measure(t.encode() if t is not None else b"") for t in texts]
        yield pd.DataFrame(rows, columns=list(MEASURES), dtype="int64")


def _measured(text: str) -> Column:
    kind = "struct<" + ", ".join(f"{m}:long" for m in MEASURES) + ">"
    return F.pandas_udf(_measure_series, kind)(F.col(text))


def ratios(m: Column) -> dict[str, Column]:
    words = F.greatest(m["n_words"], F.lit(1))
    return {"symbol_ratio": m["n_symbols"] / words,
            "dup_line_ratio": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
            "repeat_ratio": m["n_repeat_words"] / words, "word_length": m["word_chars"] / words}


def base_failed(m: Column) -> Column:
    return ((m["n_words"] < MIN_WORDS)
            | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]))


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, n and one sketch per ratio, over documents that pass the fixed rules."""
    rows = measured.filter(~base_failed(F.col("m"))).select(
        "lang", "source", *[c.cast("double").alias(k) for k, c in ratios(F.col("m")).items()])
    return rows.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(k).alias(k) for k in MARGINS])


def fences(groups: DataFrame, spread: float = SPREAD, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source and a struct ``fence`` of low and high limits for every group of sketches."""
    def limits(part: DataFrame) -> Column:
        columns = []
        for k, margin in MARGINS.items():
            low, mid = (F.kll_sketch_get_quantile_double(k, F.lit(q)) for q in (0.25, 0.5))
            width = F.lit(spread) * (mid - low) + F.lit(margin)
            columns += [(mid + width).alias(f"{k}_high"),
                        (mid - width if k in TWO_SIDED else F.lit(float("-inf"))).alias(f"{k}_low")]
        return F.struct(*columns)

    def merged(*by: str) -> DataFrame:
        return groups.groupBy(*by).agg(F.sum("n").alias("n"), *[
            F.kll_merge_agg_double(k).alias(k) for k in MARGINS])

    own = groups.select("lang", "source", "n", limits(groups).alias("own"))
    by_lang = merged("lang")
    by_lang = by_lang.select(F.col("lang").alias("lang_"), F.col("n").alias("lang_n"),
                             limits(by_lang).alias("by_lang"))
    all_rows = merged().filter("n > 0")  # a sketch of nothing has no quantiles
    all_rows = all_rows.select(limits(all_rows).alias("all"))
    wide = own.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_")), "left")
    return wide.join(F.broadcast(all_rows), F.lit(True), "left").select(  # one row
        "lang", "source", F.when(F.col("n") >= min_group, F.col("own"))
        .when(F.col("lang_n") >= min_group, F.col("by_lang")).otherwise(F.col("all"))
        .alias("fence"))


def learned_fences(measured: DataFrame) -> DataFrame:
    return stage(fences(stage(sketches(measured), "sketches")), "fences")


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept; a group without a fence holds no row that passes."""
    f = limits.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), "fence")
    inside = F.lit(True)
    for k, value in ratios(F.col("m")).items():
        inside &= value.between(F.col("fence")[f"{k}_low"], F.col("fence")[f"{k}_high"])
    joined = measured.join(f, F.col("lang").eqNullSafe(F.col("lang_"))
                           & F.col("source").eqNullSafe(F.col("source_")), "left")
    failed = base_failed(F.col("m"))
    return (joined.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & F.coalesce(inside, F.lit(True)))
            .drop("lang_", "source_", "fence"))


def measured_rows(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the struct ``m``; texts are read once and not moved."""
    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"),
                       F.col("source").cast("string"), _measured("text").alias("m"))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row of ``docs``."""
    measured = stage(measured_rows(docs), "measures")
    rows = judged(measured, learned_fences(measured))
    return rows.select("doc_id", *[F.col("m")[k].alias(k) for k in MEASURES], "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Measured twice, once for the fences and once to filter in place: that costs less than
    moving the texts to a table of verdicts.
    """
    limits = learned_fences(stage(measured_rows(docs), "measures"))
    row = docs.select(F.struct("*").alias("row"), F.col("lang").cast("string").alias("lang"),
                      F.col("source").cast("string").alias("source"), _measured("text").alias("m"))
    return judged(row, limits).filter("kept").select("row.*")
