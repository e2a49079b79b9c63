"""Benchmark decontamination by SimHash windows, multi-index Hamming search and exact similarity.

1. Texts become words: A-Z in lower case, ASCII punctuation read as blanks.
2. A hit starts and ends with shingles of its item, so only places of a document whose 5-word
   shingle some item has can begin one. Documents without such a place are done.
3. From each such place windows of 0.75 to 1.33 of the items' sizes (12 % apart) get a 64-bit SimHash
   of their words, each weighing by its length; window sums are differences of running sums. Every
   item has the SimHash of all its words.
4. Fingerprints are cut into four blocks of 16 bits. If two differ in at most RADIUS bits, some
   block differs in at most RADIUS / 4; a table per block and class of item sizes lists all
   such block values, so every item within the radius of a window is found.
5. For each such item the best stretch is searched by the exact weighted Jaccard similarity of
   5-word shingles; a shingle that occurs in k distinct item texts of the whole
   benchmark weighs 1/k, one that is not in the item the item's mean. From 0.75 on it is
   a hit. Items of fewer than five words have one shingle, of all their words.

The radius comes from measured recall (README): edits and cuts down to 0.75 turn few bits.

Items come in blocks of bounded size, each sent to all tasks in one pass over the documents; whole
texts are read, and documents are not shuffled.

Cases: null and empty texts and items without words hit nothing; item ids may repeat or be null, and
each such item row counts; repeated documents each get their hits; other columns are passed on; an
empty table on either side gives no hits. Long texts are read in overlapping stretches.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import WordHash, give_back, record, slices, stage, texts_of, window_hashes

WIDTH = 5
SIMILARITY = 0.75
RADIUS = 20
BLOCKS, BLOCK_BITS = 4, 16
CLASS_STEP = 1.12
#: Sizes of a window that may hold an item, as shares of the item's.
LEAST, MOST = 0.72, 1.4
STRETCH = 8192
#: Items of one pass: at most so many, and so many bytes of text.
PASS_ITEMS = 4096
PASS_BYTES = 16 << 20
HIT = "array<struct<item_id:long,similarity:double,first_word:long,n_words:long>>"

_CLEAN = bytes.maketrans(string.ascii_uppercase.encode() + string.punctuation.encode(),
                         string.ascii_lowercase.encode() + b" " * len(string.punctuation))
_NEAR = np.array([sum(1 << b for b in bits) for k in range(RADIUS // BLOCKS + 1)
                  for bits in combinations(range(BLOCK_BITS), k)], np.int64)


def clean_words(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def running_sums(hashes: np.ndarray, lengths: np.ndarray, longest: int) -> np.ndarray:
    """(words + 1, 64) running sums of every word's +weight or -weight for each bit.

    Sums may wrap around: only differences over at most ``longest`` words are used, which fit.
    """
    kind = np.int16 if longest < 4096 else np.int32
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    weight = np.clip(lengths - 1, 1, 8).astype(np.int8)[:, None]
    signed = np.where(bits, weight, -weight)
    sums = np.zeros((len(hashes) + 1, 64), kind)
    np.cumsum(signed, axis=0, dtype=kind, out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return np.packbits(sums[last] - sums[first] > 0, axis=1).view(">u8").ravel().astype(np.uint64)


def size_step(n: float) -> int:
    return round(np.log(n) / np.log(CLASS_STEP))


def size_class(n: int) -> int:
    return max(1, round(CLASS_STEP ** size_step(n)))


@dataclass
class Item:
    item_id: int | None
    n: int
    width: int
    weights: dict  # shingle hash -> weight
    total: float


class Screen:
    """One block of items, ready to be held against documents."""

    def __init__(self, rows: list[tuple], times: dict | None = None):
        """``times``: the distinct item texts of each shingle with several; else found from rows."""
        hashed, self.items, prints = WordHash(), [], []
        shingles, texts = [], {}
        for item_id, text in rows:
            words = clean_words((text or "").encode())
            if not words:
                continue
            h = hashed.of(words)
            width = min(WIDTH, len(words))
            shingles.append(set(window_hashes(h, width).tolist()))
            texts[b" ".join(words)] = shingles[-1]
            sums = running_sums(h, np.array(list(map(len, words))), len(words))
            prints.append(fingerprints(sums, np.array([0]), np.array([len(words)]))[0])
            self.items.append(Item(item_id, len(words), width, {}, 0.0))
        if times is None:
            times = {}
            for s in texts.values():
                for x in s:
                    times[x] = times.get(x, 0) + 1
        for item, s in zip(self.items, shingles):
            item.weights = {x: 1.0 / times.get(x, 1) for x in s}
            item.total = sum(item.weights.values())
        self.prints = np.array(prints, np.uint64)
        self.classes: dict[int, tuple] = {}
        members: dict[int, list] = {}
        for i, item in enumerate(self.items):
            members.setdefault(size_class(item.n), []).append(i)
        for size, own in members.items():
            near = np.zeros((BLOCKS, 1 << BLOCK_BITS), bool)
            for i in own:
                for b in range(BLOCKS):
                    part = (int(self.prints[i]) >> (b * BLOCK_BITS)) & ((1 << BLOCK_BITS) - 1)
                    near[b, part ^ _NEAR] = True
            self.classes[size] = (np.array(own), near)
        # every width's shingles of all items, to look for the first exact trace of a hit
        self.known = {w: np.unique(np.array([x for i in self.items if i.width == w
                                             for x in i.weights], np.uint64))
                      for w in {i.width for i in self.items}}
        sizes = np.arange(size_step(LEAST * min(members)), size_step(MOST * max(members)) + 1) \
            if members else []
        self.windows = sorted({max(1, round(CLASS_STEP ** int(k))) for k in sizes})

    def candidates(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray,
                   owner: np.ndarray) -> set:
        """(owner, item) for all windows from the places ``begin`` that are within the radius of an
        item of their size; a window ends at ``end`` at the latest."""
        found = set()
        for size in self.windows:
            fits = np.flatnonzero(end - begin >= LEAST * size)
            first = begin[fits]
            prints = fingerprints(sums, first, np.minimum(first + size, end[fits]))
            blocks = [((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1))
                      .astype(np.int64) for b in range(BLOCKS)]
            for item_size, (own, near) in self.classes.items():
                if not LEAST * item_size <= size <= MOST * item_size:
                    continue
                hit = near[0][blocks[0]]
                for b in range(1, BLOCKS):
                    hit |= near[b][blocks[b]]
                at = np.flatnonzero(hit)
                for rows in np.array_split(at, max(1, len(at) * len(own) >> 20)):
                    apart = np.bitwise_count(prints[rows, None] ^ self.prints[own][None, :])
                    r, k = np.nonzero(apart <= RADIUS)
                    found.update(zip(owner[fits[rows[r]]].tolist(), own[k].tolist()))
        return found

    def best(self, item: Item, at: np.ndarray, shingles: np.ndarray) -> tuple[float, int, int]:
        """(similarity, first, last) of the best stretch, from the item's shingles at places ``at``.

        A best stretch may start with a shingle that doesn't come again in it, so from each place it
        is sought up to the next one of the same shingle; a shingle counts once in a stretch.
        """
        mean = item.total / len(item.weights)
        # shingles that a hit may hold besides the item's
        spare = len(item.weights) * (1 / SIMILARITY - 1) + 1e-9
        found = 0.0, 0, 0
        for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) - 1 > spare) + 1):
            own, places = shingles[run].tolist(), at[run]
            if sum(item.weights[x] for x in set(own)) < SIMILARITY * item.total - 1e-9:
                continue
            weight = np.array([item.weights[x] for x in own])
            last, before = {}, np.full(len(own), -1)
            after = np.full(len(own), len(own))
            for k, x in enumerate(own):
                if x in last:
                    before[k] = last[x]
                    after[last[x]] = k
                last[x] = k
            other = places - np.arange(len(own))  # shingles of no item before each place
            for a in range(len(own)):
                b = min(int(after[a]), int(np.searchsorted(other, other[a] + spare, "right")))
                same = np.cumsum(np.where(before[a:b] < a, weight[a:b], 0.0))
                value = same / (item.total + mean * (other[a:b] - other[a]))
                k = int(np.argmax(value))
                if value[k] > found[0]:
                    found = float(value[k]), int(places[a]), int(places[a + k]) + 1
        return found

    def hits(self, texts: list[bytes], hashed: WordHash) -> list[list[dict]]:
        """Per text, its items with similarity, first word and number of words."""
        out: list[dict] = [{} for _ in texts]
        if not self.items:
            return [[] for _ in texts]
        longest = max(i.n for i in self.items)
        overlap = 2 * longest + WIDTH
        pieces, owner, offset, words = [], [], [], 0

        def flush():
            if pieces:
                self._search(pieces, owner, offset, hashed, out)
            pieces.clear(), owner.clear(), offset.clear()

        for t, text in enumerate(texts):
            found = clean_words(text)
            for at in range(0, max(1, len(found)), STRETCH):
                part = found[at:at + STRETCH + overlap]
                if part:
                    pieces.append(part)
                    owner.append(t)
                    offset.append(at)
                    words += len(part)
                    if words > 4 * STRETCH:
                        flush()
                        words = 0
        flush()
        return [list(found.values()) for found in out]

    def _search(self, pieces, owner, offset, hashed, out) -> None:
        n = np.array(list(map(len, pieces)))
        begin = np.cumsum(n) - n
        flat = [w for p in pieces for w in p]
        h = hashed.of(flat)
        traces = {}  # per width: places whose shingle some item has, and these
        owners = np.repeat(np.arange(len(n)), n)
        for width, known in self.known.items():
            s = window_hashes(h, width)
            if not len(s):
                continue
            place = np.flatnonzero(known[np.minimum(np.searchsorted(known, s), len(known) - 1)] == s)
            # not across the end of a stretch
            place = place[place + width <= (begin + n)[owners[place]]]
            if len(place):
                traces[width] = place, s[place]
        if not traces:
            return
        starts = np.unique(np.concatenate([place for place, _ in traces.values()]))
        # running sums of the stretches with such places only, moved together
        some = np.zeros(len(n), bool)
        some[owners[starts]] = True
        moved = np.cumsum(np.where(some, 0, n)) - np.where(some, 0, n)
        kept = np.flatnonzero(some[owners])
        sums = running_sums(h[kept], np.fromiter((len(flat[w]) for w in kept.tolist()), np.int64,
                                                 len(kept)), 2 * max(i.n for i in self.items))
        own = owners[starts]
        pairs = self.candidates(sums, starts - moved[own], (begin + n - moved)[own], own)
        for k, i in sorted(pairs):
            item = self.items[i]
            if item.width not in traces:
                continue
            place, s = traces[item.width]
            low, high = np.searchsorted(place, [begin[k], begin[k] + n[k]])
            mine = np.array([x in item.weights for x in s[low:high].tolist()], bool)
            if not mine.any():
                continue
            value, a, b = self.best(item, place[low:high][mine] - begin[k], s[low:high][mine])
            if value >= SIMILARITY - 1e-12:
                known = out[owner[k]].get(i)
                if known is None or value > known["similarity"]:
                    out[owner[k]][i] = {
                        "item_id": item.item_id, "similarity": value,
                        "first_word": offset[k] + a, "n_words": b - a + item.width - 1}


def item_shingles(texts: DataFrame) -> DataFrame:
    """(x): every shingle of each distinct text, read as words."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"words": pa.array(
                [b" ".join(clean_words(t)) for t in texts_of(batch)], pa.binary())})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, schema = WordHash(), pa.schema([("x", pa.int64())])
        for batch in slices(batches):
            for t in texts_of(batch, "words"):
                h = hashed.of(t.split())
                if len(h):
                    s = np.unique(window_hashes(h, min(WIDTH, len(h))))
                    yield record(schema, [s.view(np.int64)])

    return texts.select("text").mapInArrow(words, "words binary").distinct().mapInArrow(cut, "x long")


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[tuple], dict]]:
    """The items as (item_id, text), in blocks of bounded number and size, each with the number of
    distinct item texts of the whole benchmark for those of its shingles that are in several."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-2 * n // PASS_ITEMS) if n > PASS_ITEMS else 1, -(-2 * size // PASS_BYTES)
                 if size > PASS_BYTES else 1)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    several = stage(item_shingles(rows).groupBy("x").agg(F.count("*").alias("k")).filter("k > 1"),
                    "item-shingles")
    for b in range(blocks):
        found = rows.filter(place == b).orderBy("item_id", "text").collect()
        if found:
            own = item_shingles(rows.filter(place == b)).distinct()
            times = several.join(own, "x").select("x", "k").toArrow()
            yield [tuple(r) for r in found], dict(zip(
                np.asarray(times.column("x")).astype(np.int64).view(np.uint64).tolist(),
                times.column("k").to_pylist()))


def _searcher(screen):
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashed = WordHash()
        for texts in batches:
            yield pd.Series(screen.value.hits(
                [t.encode() if t is not None else b"" for t in texts], hashed), dtype=object)
        hashed.clear()
        give_back()

    return search


def with_hits(docs: DataFrame, benchmark: DataFrame, column: str = "hits") -> DataFrame:
    """``docs`` with an array of (item_id, similarity, first_word, n_words) in ``column``."""
    spark = docs.sparkSession
    none = F.array().cast(HIT)
    total = none
    for rows, times in item_blocks(benchmark):
        search = F.pandas_udf(_searcher(spark.sparkContext.broadcast(Screen(rows, times))), HIT)
        total = F.concat(total, search(F.col("text")))
    return docs.withColumn(column, F.coalesce(total, none))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: one row per document and item it holds."""
    hits = with_hits(docs.select(F.col("doc_id").cast("long"), "text"), benchmark)
    return hits.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    row = with_hits(docs.select(F.struct("*").alias("row"), "text"), benchmark)
    return row.filter(F.size("hits") == 0).select("row.*")
