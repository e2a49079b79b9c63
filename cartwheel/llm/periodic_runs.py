"""Periodic runs of words: stretches that repeat one phrase, and texts collapsed to its first copy.

A run is a stretch of words with smallest period q (words q apart are equal) of at least ``least``
words and ``periods`` periods that no neighbouring word extends keeping q.

1. Words are numbered within the text. Where no sequence of 8 words occurs twice there is no run,
   since every 8 words of a run but the last few occur again a period later. Only maximal
   stretches of such repeated places are searched; every run lies in one of them.
2. Phase one of Baier's suffix sorter groups the positions of a stretch: groups are taken from the
   greatest down, and positions just before the members of a group move on into a group whose
   context is longer by theirs. The context a position ends in is the longest Lyndon word that
   starts there, so the groups are the Lyndon array. This is done under the order of the word
   numbers and under its reverse.
3. By the runs theorem the Lyndon words of one of the two arrays are the roots of every run. Roots
   that follow each other at their own distance are extended both ways as long as words a period
   apart are equal (longest common extensions, compared directly, block by block).

All steps are exact and of about linear time. Rows are worked on one by one, without a shuffle; a
task holds one text at a time.

Cases: null and empty texts have no words, no runs and an empty collapsed text; repeated rows stay;
null doc_ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm.common import PLACES, record, slices, texts_of, words_of

LEAST, PERIODS = 24, 3
#: Words of a sequence whose repetition marks a place; at most a third of ``least``.
GRAM = 8


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word starting at each position (a word ends lowest)."""
    n = len(symbols)
    first: dict[int, list[int]] = defaultdict(list)
    for i, c in enumerate(symbols):
        first[c].append(i)
    members = [first[c] for c in sorted(first)]
    order = len(members)
    context = [1] * order
    before, after = list(range(-1, order - 1)), [*range(1, order), -1]
    group = [0] * n
    for g, held in enumerate(members):
        for i in held:
            group[i] = g
    left = list(range(n))  # the nearest position not taken yet, at or before i (path-compressed)
    out = [0] * n
    g = order - 1
    while g >= 0:
        size = context[g]
        held = [i for i in members[g] if group[i] == g]
        members[g] = ()
        for i in held:
            out[i] = size
            left[i] = i - 1
        followers: dict[int, int] = {}
        for i in held:
            j = i
            while j >= 0 and left[j] != j:
                j = left[j]
            while i >= 0 and left[i] != i:
                left[i], i = j, left[i]
            if j >= 0:
                followers[j] = followers.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, n_times in followers.items():
            moved.setdefault((n_times, group[j]), []).append(j)
        for n_times, old in sorted(moved, reverse=True):
            # right behind the old group, so the fewer copies the nearer to it
            new = len(members)
            held = moved[n_times, old]
            members.append(held)
            context.append(context[old] + n_times * size)
            behind = after[old]
            before.append(old)
            after.append(behind)
            after[old] = new
            if behind >= 0:
                before[behind] = new
            for j in held:
                group[j] = new
        g = before[g]
    return out


def _forward(a: np.ndarray, at: int, period: int) -> int:
    """How many words from ``at`` on equal the word a period before."""
    begin, step = at, 32
    while at < len(a):
        differ = a[at:at + step] != a[at - period:at - period + len(a[at:at + step])]
        if differ.any():
            return at - begin + int(differ.argmax())
        at += len(differ)
        step *= 2
    return at - begin


def _chains(a: np.ndarray, lyndon: np.ndarray, least: int, periods: int) -> Iterator[tuple]:
    """(first root, roots, period): Lyndon words of one length, each starting where one ended.

    Chains that can't reach the length of a run are left out: a run goes on for less than a
    period at both ends of its roots.
    """
    at = np.arange(len(a))
    order = np.lexsort((at, at % lyndon, lyndon))
    at, p = at[order], lyndon[order]
    follows = np.zeros(len(a), bool)
    follows[1:] = (p[1:] == p[:-1]) & (at[1:] - at[:-1] == p[1:])
    # a copy begins and ends with the same words as the root before
    ends = np.minimum(at + p, len(a)) - 1
    follows[1:] &= (a[at[1:]] == a[at[:-1]]) & (a[ends[1:]] == a[ends[:-1]])
    begin = np.flatnonzero(~follows)
    roots = np.diff(np.append(begin, len(a)))
    p, at = p[begin], at[begin]
    keep = (roots + 2) * p - 2 >= np.maximum(least, periods * p)
    yield from zip(at[keep].tolist(), roots[keep].tolist(), p[keep].tolist())


def runs_of(codes: list[int], least: int = LEAST, periods: int = PERIODS) -> set[tuple]:
    """(start, length, period) of all runs of a sequence of numbers, by Lyndon roots."""
    a = np.array(codes, np.int64)
    back = a[::-1]
    found: set[tuple] = set()
    for symbols in (codes, (-a).tolist()):
        for first, roots, p in _chains(a, np.array(lyndon_array(symbols), np.int64), least, periods):
            at, last = first, first + (roots - 1) * p
            while at <= last:
                end = at + p + _forward(a, at + p, p)
                # to the left: the same in the reversed sequence
                begin = at - _forward(back, len(a) - at, p)
                if end - begin >= max(least, periods * p):
                    found.add((begin, end - begin, p))
                at += max(1, (end - at) // p) * p
    return found


def repeated_stretches(a: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal [begin, end) whose sequences of 8 words all occur at least twice."""
    n = len(a) - GRAM + 1
    if n <= 1 or len(a) < least:
        return []
    codes = a.astype(np.uint64) + np.uint64(1)
    grams = codes[:n] * PLACES[0]
    for k in range(1, GRAM):
        grams += codes[k:k + n] * PLACES[k]
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return []
    marked = np.zeros(n + 2, np.int8)
    marked[order[1:][same] + 1] = 1
    marked[order[:-1][same] + 1] = 1
    turns = np.flatnonzero(np.diff(marked))
    return [(b, e + GRAM - 1) for b, e in zip(turns[::2].tolist(), turns[1::2].tolist())
            if e + GRAM - 1 - b >= least]


def text_runs(words: list[bytes], least: int = LEAST, periods: int = PERIODS) -> list[tuple]:
    """Sorted (start, length, period) of the runs of a text's words."""
    if GRAM * periods > least:
        raise ValueError(f"runs of {least} words and {periods} periods are too short to be marked")
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(numbers) == len(codes):
        return []
    found: set[tuple] = set()
    for begin, end in repeated_stretches(np.array(codes, np.int64), least):
        found.update((begin + s, n, p) for s, n, p in runs_of(codes[begin:end], least, periods))
    return sorted(found)


def collapse(words: list[bytes], runs: list[tuple]) -> list[bytes]:
    """Words without those that a run repeats: each run keeps its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def document_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS,
                  change: Callable[[int, list], list] | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and the collapsed text, per row.

    ``change`` may replace a row's words before they are searched.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)),
                        ("collapsed", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            ids = batch.column("doc_id").to_pylist()
            sizes, found, collapsed = [], [], []
            for doc_id, text in zip(ids, texts_of(batch)):
                words = words_of(text)
                if change is not None:
                    words = change(doc_id, words)
                runs = text_runs(words, least, periods)
                sizes.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                collapsed.append(b" ".join(collapse(words, runs)).decode("utf-8", "replace"))
            yield record(schema, [ids, sizes, found, collapsed])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        search, "doc_id long, n_words long, "
                "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def greatest_exponent(runs: str) -> Column:
    """The run with the greatest length / period (ties: least start, then period); null if none."""
    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1)
                .when(a["start"] > b["start"], 1).when(a["period"] < b["period"], -1)
                .when(a["period"] > b["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, order), F.lit(0))


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Makes the end of about every tenth row's text periodic, as a known occurrence of runs."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
