"""Similarity join of documents on 5-word shingles by a token-group matrix.

Documents link when the Jaccard similarity of their shingle sets is at least 0.75; the result is each
document's connected component. No pair of copies is listed, and no link between texts is lost:

1. Documents with equal sets form a class and go on as one.
2. Seeds: classes are grouped by each of eight minimum hashes; the least of a group is compared, by
   its text, with those that share several of the eight. Links found this way join classes.
3. Each class is cut to its rarest shingles: of two sets that link, the first n - ceil(0.75 n) + 1
   shingles in any common order must meet, and the number that must meet follows from both sizes.
   The order puts shingles first whose bucket in a count sketch over all documents is low.
4. Token-group matrix: classes are put into groups of like size and like minimum hash; a token keeps
   the groups whose union holds it. How many of its tokens a class finds in a group bounds its
   overlap with every member, so only groups that reach the least possible number are opened.
   Classes joined by seeds count as one, and their own groups are left out.
5. Classes of one component in one group that still can't be told from those of another are compared
   by text, chunk by chunk, up to the first link: it joins both components.

Shingles are 64-bit hashes of words' 64-bit hashes. Words are cut at ASCII white space after
lower-casing A-Z; fewer than five words make one shingle.

Cases: null and empty texts have no shingles and link with nothing; rows that share a doc_id count
as one document with several texts; a null doc_id gets a stand-in above 2**62 from its text, and its
component is null unless a real one is reached; repeated rows each get a row; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cartwheel.llm.common import (
    MASK, WordHash, mix64, record, shingle_set, slices, stage, texts_of, words_of,
)
from cartwheel.llm.components import components

WIDTH = 5
HASHES = 8
AGREE = 3
#: log2 of the count sketch's buckets, and buckets a page of it.
SKETCH = 21
PAGE = 1 << 15
#: Groups of the matrix: sizes within a factor, and a share of the minimum hashes.
BAND = 1.06
BLOCKS = 8
STAND_IN = 1 << 62
BLOOM = 22
#: Classes of one entity that are compared at once, and their shingles.
CHUNK, CHUNK_SHINGLES = 64, 100_000
_TWISTS = [np.uint64((0xA0761D6478BD642F * (2 * k + 1)) & MASK | 1) for k in range(HASHES)]


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(STAND_IN)
                      + F.pmod(F.xxhash64("text"), F.lit(1 << 61)))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key().alias("key"), F.xxhash64("text").alias("h"), "text")


def needed(n: int) -> int:
    """Least overlap of a set of n with any set it links to: ceil(0.75 n)."""
    return -(-3 * n // 4)


def required_within(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    """A lower bound of the tokens that the cut sets of two linked sets share, with sizes in two
    ranges; null if no two of them can link.

    Sets of sizes a >= b overlap in ceil(3 (a + b) / 7) or more, of which the larger one's uncut rest
    takes ceil(0.75 a) - 1 at most. With ceil(0.75 a) <= 0.75 a + 0.75, no less than
    (12 b - 9 a + 7) / 28 are shared, which is least for the smallest b and the largest a: at most one
    below the least over all sizes, whose ceilings go up and down.
    """
    least = F.least(12 * other_low - 9 * high, 12 * low - 9 * other_high) + 7
    apart = (low * 0.75 > other_high) | (other_low * 0.75 > high)
    return F.when(~apart, F.greatest(F.lit(1), F.ceil(least / F.lit(28.0))))


def shingle_rows(keys: DataFrame) -> DataFrame:
    """key, h, n, a, b (hashes of the set), minima; and rows of the count sketch by page."""
    schema = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("a", pa.int64()),
                        ("b", pa.int64()), ("minima", pa.list_(pa.int64())),
                        ("page", pa.int32()), ("counts", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, sketch = WordHash(), np.zeros(1 << SKETCH, np.uint32)
        for batch in slices(batches):
            n, a, b, minima, all_sets = [], [], [], [], []
            for text in texts_of(batch):
                s = shingle_set(hashed.of(words_of(text.lower())), WIDTH)
                n.append(len(s))
                x = mix64(s + np.uint64(1))
                a.append(int(x.sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(np.bitwise_xor.reduce(mix64(x ^ _TWISTS[0])).astype(np.int64)))
                minima.append([int(mix64(s * t).min().astype(np.int64)) for t in _TWISTS]
                              if len(s) else [])
                all_sets.append(s)
            flat = np.concatenate(all_sets)
            np.add.at(sketch, (flat >> np.uint64(64 - SKETCH)).astype(np.int64), 1)
            blank = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield record(schema, [batch.column("key"), batch.column("h"), n, a, b, minima, *blank])
        if sketch.any():
            pages = [(p, zlib.compress(sketch[p * PAGE:(p + 1) * PAGE].tobytes(), 1))
                     for p in range((1 << SKETCH) // PAGE)]
            blank = [pa.nulls(len(pages), f.type) for f in list(schema)[:6]]
            yield record(schema, [*blank, [p for p, _ in pages], [c for _, c in pages]])

    return stage(keys.mapInArrow(work, "key long, h long, n long, a long, b long, "
                                       "minima array<long>, page int, counts binary"),
                 "shingle-rows")


def sketch_levels(rows: DataFrame) -> np.ndarray:
    """A byte per bucket that grows with the logarithm of its count; of fixed size."""
    def add(key, group):
        total = np.zeros(PAGE, np.uint64)
        for data in group.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(data), np.uint32)
        levels = np.minimum(4 * np.log2(1.0 + total), 127).astype(np.uint8)
        return pa.table({"page": pa.array([key[0].as_py()], pa.int32()),
                         "levels": pa.array([levels.tobytes()], pa.binary())})

    found = (rows.filter("page is not null").select("page", "counts").groupBy("page")
             .applyInArrow(add, "page int, levels binary").toArrow())
    out = np.zeros(1 << SKETCH, np.uint8)
    for page, levels in zip(found.column("page").to_pylist(), found.column("levels").to_pylist()):
        out[page * PAGE:(page + 1) * PAGE] = np.frombuffer(levels, np.uint8)
    return out


def cut_tokens(keys: DataFrame, ids: DataFrame, levels) -> DataFrame:
    """(token, key): the first tokens of every set in the common order, as many as must meet.

    For the keys in ``ids``, and few others that the bit set lets through.
    """
    bits = keys.sparkSession.sparkContext.broadcast(bloom_of(ids))
    schema = pa.schema([("token", pa.int64()), ("key", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, level = WordHash(), levels.value
        for batch in slices(batches):
            x = mix64(batch.column("key").to_numpy().astype(np.uint64))
            batch = batch.filter(pa.array(bits.value[(x >> np.uint64(64 - BLOOM)).astype(np.int64)]))
            if not batch.num_rows:
                continue
            tokens, lengths = [], []
            for text in texts_of(batch):
                s = shingle_set(hashed.of(words_of(text.lower())), WIDTH)
                order = (level[(s >> np.uint64(64 - SKETCH)).astype(np.int64)].astype(np.uint64)
                         << np.uint64(56)) | (mix64(s) >> np.uint64(8))
                first = len(s) - needed(len(s)) + 1 if len(s) else 0
                tokens.append(np.partition(order, first - 1)[:first] if first else order)
                lengths.append(first)
            keys_ = np.repeat(batch.column("key").to_numpy(), lengths)
            yield record(schema, [np.concatenate(tokens).astype(np.int64), keys_])

    return keys.select("key", "text").mapInArrow(work, "token long, key long")


def bloom_of(ids: DataFrame) -> np.ndarray:
    """A bit set of fixed size that holds every id; it only keeps texts from being moved in vain."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BLOOM, bool)
        for batch in batches:
            x = mix64(batch.column("key").to_numpy().astype(np.uint64))
            bits[(x >> np.uint64(64 - BLOOM)).astype(np.int64)] = True
        yield pa.record_batch({"bits": pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)],
                                                pa.binary())})

    def add(key, group):
        total = np.zeros((1 << BLOOM) // 8, np.uint8)
        for data in group.column("bits").to_pylist():
            total |= np.frombuffer(zlib.decompress(data), np.uint8)
        return pa.table({"bits": pa.array([total.tobytes()], pa.binary())})

    parts = ids.select("key").mapInArrow(work, "bits binary").groupBy(
        (F.spark_partition_id() % 16).alias("at")).applyInArrow(
            lambda key, group: add(key, group.select(["bits"])), "bits binary")
    total = np.zeros((1 << BLOOM) // 8, np.uint8)
    for row in parts.collect():  # at most 16
        total |= np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(total).astype(bool)


def maybe_in(keys: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``keys`` (key, text) whose key is in ``ids``, and few others."""
    bits = keys.sparkSession.sparkContext.broadcast(bloom_of(ids))

    def may_be(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = mix64(batch.column("key").to_numpy().astype(np.uint64))
            yield batch.filter(pa.array(bits.value[(x >> np.uint64(64 - BLOOM)).astype(np.int64)]))

    return keys.select("key", "text").mapInArrow(may_be, "key long, text string")


def linked(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows (u, v) of ``pairs`` whose texts link, found by their whole shingle sets."""
    some = maybe_in(keys, pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct())
    both = (pairs.join(some.withColumnsRenamed({"key": "v", "text": "text_v"}), "v")
            .join(some.withColumnsRenamed({"key": "u", "text": "text_u"}), "u")
            .select("u", "v", "text_u", "text_v"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, last, last_set = WordHash(), None, None
        for batch in slices(batches, 256):
            us, vs = [], []
            for u, v, a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(),
                                  texts_of(batch, "text_u"), texts_of(batch, "text_v")):
                if a != last:
                    last, last_set = a, shingle_set(hashed.of(words_of(a.lower())), WIDTH)
                other = shingle_set(hashed.of(words_of(b.lower())), WIDTH)
                same = len(np.intersect1d(last_set, other, assume_unique=True))
                if same and 100 * same >= 75 * (len(last_set) + len(other) - same):
                    us.append(u)
                    vs.append(v)
            yield record(schema, [us, vs])

    return both.mapInArrow(work, "u long, v long").distinct()


def seed_pairs(classes: DataFrame) -> DataFrame:
    """(u, v): the least class of each group of equal minimum hashes with the group's others."""
    spread = classes.select("key", F.posexplode("minima").alias("at", "value"))
    least = (spread.groupBy("at", "value").agg(F.min("key").alias("u"), F.count("*").alias("c"))
             .filter("c > 1").drop("c"))
    return (spread.join(least, ["at", "value"]).filter("key <> u")
            .groupBy("u", F.col("key").alias("v")).agg(F.count("*").alias("agree"))
            .filter(F.col("agree") >= AGREE).select("u", "v"))


def matrix_pairs(tokens: DataFrame, classes: DataFrame,
                 labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of entities of different components that the token-group matrix can't tell apart, and
    the classes (key, n, cap) that belong to entities."""
    # one entity: the classes of one component in one group
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(BAND)))).cast("int")
    members = stage(classes.join(labels, F.col("key") == F.col("node"), "left").select(
        "key", "n", F.coalesce("label", "key").alias("comp"), band.alias("band"),
        F.pmod(F.col("minima")[0], F.lit(BLOCKS)).cast("int").alias("block")), "members")
    entity = ["comp", "band", "block"]
    # tokens that one class alone holds link nothing: one shuffle of narrow rows that may spill
    own = W.partitionBy("token")
    held = stage(tokens.withColumn("first", F.min("key").over(own))
                 .withColumn("last", F.max("key").over(own)).filter("first <> last")
                 .select("token", "key"), "held-tokens")
    mine = held.join(members, "key")
    shared = (mine.groupBy("token").agg(F.min("key").alias("first"), F.max("key").alias("last"))
              .filter("first <> last").select("token"))
    mine = stage(mine.join(shared, "token"), "shared-tokens")
    # of two sets, the one whose cut ends first in the common order has those of its cut tokens that
    # lie in the overlap in the other's cut too; so the larger of both caps bounds the overlap, and
    # the smaller need not: the other's cut may hold tokens of the uncut rest of the first
    caps = mine.groupBy("key").agg(F.count("*").alias("s"), F.max("n").alias("n")).select(
        "key", (F.ceil(F.col("n") * 0.75) - 1 + F.col("s")).alias("cap"))
    members = stage(members.join(caps, "key"), "capped-members")
    postings = stage(mine.groupBy("token", *entity).agg(F.count("*").alias("rows")).drop("rows"),
                     "postings")
    sizes = members.groupBy(*entity).agg(F.min("n").alias("low"), F.max("n").alias("high"),
                                         F.max("cap").alias("cap"))
    # matrix: a token's groups, with the least and the greatest component that holds it there
    matrix = postings.groupBy("token", "band", "block").agg(
        F.min("comp").alias("c1"), F.max("comp").alias("c2"))
    groups = members.groupBy("band", "block").agg(
        F.min("n").alias("g_low"), F.max("n").alias("g_high"), F.max("cap").alias("g_cap"))
    reach = int(np.ceil(np.log(4 / 3) / np.log(BAND))) + 1
    q = postings.select("token", *entity)
    m = matrix.select("token", F.col("band").alias("g_band"), F.col("block").alias("g_block"),
                      "c1", "c2")
    found = (q.join(m, "token")
             .filter((F.abs(F.col("band") - F.col("g_band")) <= reach)
                     & ((F.col("c1") != F.col("comp")) | (F.col("c2") != F.col("comp"))))
             .groupBy(*entity, "g_band", "g_block").agg(F.count("*").alias("c")))
    g = groups.withColumnsRenamed({"band": "g_band", "block": "g_block"})
    opened = stage(found.join(sizes, entity).join(g, ["g_band", "g_block"])
                   .filter((F.col("c") >= required_within(
                       F.col("low"), F.col("high"), F.col("g_low"), F.col("g_high")))
                       & (7 * F.greatest("cap", "g_cap") >= 3 * (F.col("low") + F.col("g_low"))))
                   .select(*entity, "g_band", "g_block", "low", "high", "cap"), "opened")
    # open: an entity meets those entities of its opened groups that open its own group too
    one = postings.join(opened, entity)
    two = one.select("token", *[F.col(c).alias(f"{c}_2") for c in entity],
                     F.col("g_band").alias("band"), F.col("g_block").alias("block"),
                     F.col("low").alias("low_2"), F.col("high").alias("high_2"),
                     F.col("cap").alias("cap_2"))
    met = (one.join(two, ["token", "band", "block"])
           .filter((F.col("g_band") == F.col("band_2")) & (F.col("g_block") == F.col("block_2"))
                   & (F.col("comp") < F.col("comp_2")))
           .groupBy(*entity, *[f"{c}_2" for c in entity])
           .agg(F.count("*").alias("c"), *[F.first(x).alias(x)
                                           for x in ("low", "high", "cap", "low_2",
                                                     "high_2", "cap_2")])
           .filter((F.col("c") >= required_within(F.col("low"), F.col("high"), F.col("low_2"),
                                                  F.col("high_2")))
                   & (7 * F.greatest("cap", "cap_2") >= 3 * (F.col("low") + F.col("low_2")))))
    met = stage(met.select(*entity, *[f"{c}_2" for c in entity]), "met")
    return met, members


def opened_links(met: DataFrame, members: DataFrame, keys: DataFrame) -> DataFrame:
    """(u, v): a link between the classes of two entities that meet, if there is one.

    The classes of an entity are one component already, so one link is enough, and what is compared
    are chunks of bounded size: no row is made for a pair of classes.
    """
    entity = ["comp", "band", "block"]
    parts = members.groupBy(*entity).agg(F.greatest(
        F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).alias("parts"))
    placed = members.join(parts, entity).select(
        "key", *entity, F.pmod(F.xxhash64("key"), F.col("parts")).alias("part"))
    chunks = placed.groupBy(*entity, "part").agg(F.min("key").alias("chunk"),
                                                 F.count("*").alias("size"))
    of_key = stage(placed.join(chunks, [*entity, "part"]).select("key", "chunk"), "chunk-keys")
    chunks = stage(chunks.drop("part"), "chunks")
    second = chunks.withColumnsRenamed({"chunk": "chunk_2", "size": "size_2",
                                        **{c: f"{c}_2" for c in entity}})
    first_is_large = F.col("size") >= F.col("size_2")
    pairs = stage(met.join(chunks, entity).join(second, [f"{c}_2" for c in entity]).select(
        F.when(first_is_large, F.col("chunk")).otherwise(F.col("chunk_2")).alias("large"),
        F.when(first_is_large, F.col("chunk_2")).otherwise(F.col("chunk")).alias("small")),
        "chunk-pairs")
    wanted = (pairs.select(F.col("large").alias("chunk"))
              .unionAll(pairs.select(F.col("small").alias("chunk"))).distinct())
    mine = stage(of_key.join(wanted, "chunk", "left_semi"), "opened-keys")
    texts = stage(maybe_in(keys, mine).join(mine, "key").groupBy("chunk").agg(
        F.collect_list("key").alias("keys"), F.collect_list("text").alias("texts")), "chunk-texts")
    both = (pairs.join(texts.select(F.col("chunk").alias("small"), F.col("keys").alias("keys_s"),
                                    F.col("texts").alias("texts_s")), "small")
            .join(texts.select(F.col("chunk").alias("large"), F.col("keys").alias("keys_l"),
                               F.col("texts").alias("texts_l")), "large")
            .select("large", "keys_s", "texts_s", "keys_l", "texts_l"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, last, own = WordHash(), None, []

        def sets(texts):
            return [shingle_set(hashed.of(words_of(t.encode().lower())), WIDTH) for t in texts]

        def link(ids, others, keys_):
            for u, a in zip(ids, others):
                for v, b in zip(keys_, own):
                    if 4 * len(a) >= 3 * len(b) and 4 * len(b) >= 3 * len(a):
                        same = len(np.intersect1d(a, b, assume_unique=True))
                        if 100 * same >= 75 * (len(a) + len(b) - same):
                            return u, v
            return None

        for batch in slices(batches, 16):
            found = []
            for r in batch.to_pylist():  # rows come sorted by the large chunk
                if r["large"] != last:
                    last, own = r["large"], sets(r["texts_l"])
                found.append(link(r["keys_s"], sets(r["texts_s"]), r["keys_l"]))
            found = [x for x in found if x]
            yield record(schema, [[u for u, _ in found], [v for _, v in found]])

    return both.mapInArrow(work, "u long, v long").distinct()


def class_labels(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (key, h, n, a, b) of all documents, and (n, a, b, first, label) of each class: its least
    key and the least key of its component."""
    spark = docs.sparkSession
    keys = keyed(docs)
    rows = shingle_rows(keys)
    levels = spark.sparkContext.broadcast(sketch_levels(rows))
    texts = rows.filter("page is null")
    classes = stage(texts.filter("n > 0").groupBy("n", "a", "b").agg(
        F.min("key").alias("key"), F.first("minima").alias("minima")), "classes")
    seeds = stage(linked(stage(seed_pairs(classes), "seed-pairs"), keys), "seed-links")
    joined = stage(components(seeds), "seed-labels")
    met, members = matrix_pairs(cut_tokens(keys, classes, levels), classes, joined)
    more = opened_links(met, members, keys)
    labels = stage(components(seeds.unionByName(more)), "labels")
    found = stage(classes.join(labels, F.col("key") == F.col("node"), "left").select(
        "n", "a", "b", F.col("key").alias("first"), F.coalesce("label", "key").alias("label")),
        "class-labels")
    return texts.select("key", "h", "n", "a", "b"), found


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    rows, found = class_labels(docs)
    out = rows.join(found, ["n", "a", "b"], "left")
    own = F.when(F.col("key") < STAND_IN, F.col("key"))
    return out.select(own.alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, own).when(F.col("label") < STAND_IN, F.col("label"))
                      .alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns; rows without words stay.

    The row kept has the component's least doc_id; of several texts under that doc_id the one with
    the least hash, and of rows equal in both the one whose columns hash least.
    """
    rows, found = class_labels(docs)
    roots = (rows.join(found.filter("first = label"), ["n", "a", "b"])
             .filter("key = first").groupBy("key", "h").agg(F.count("*").alias("times"))
             .groupBy("key").agg(F.min(F.struct("h", "times")).alias("one"))
             .select("key", "one.*"))
    empty = rows.filter("n = 0").select("key", "h", F.lit(1).cast("long").alias("times")).distinct()
    keep = stage(roots.unionByName(empty), "kept-keys")
    row = docs.select(F.struct("*").alias("row"), doc_key().alias("key"),
                      F.xxhash64("text").alias("h"), F.xxhash64(*docs.columns).alias("all"))
    kept = row.join(keep, ["key", "h"])  # narrow keys; the texts move once at most
    once = kept.filter("times = 1").select("row.*")
    order = W.partitionBy("key", "h").orderBy("all")
    again = (kept.filter("times > 1").withColumn("at", F.row_number().over(order))
             .filter("at = 1").select("row.*"))
    return once.unionByName(again)
