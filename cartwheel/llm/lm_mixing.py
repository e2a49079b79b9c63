"""Scores of texts by logistic mixing of hashed-context bit predictors.

A token is coded byte by byte and bit by bit, closed by a blank. Each predictor keeps, for its context
(the document's language with the last 1, 2 or 4 bytes of the token, or all of it so far) and the
bits of the byte so far, how often a 0 and a 1 followed. The predictors' log odds are added with
weights chosen by a gate (place in the token, and how much the longest context has seen); the weights
are learned online, and a last table refines the result by what really followed predictions of its
kind. Bits add up to the token's log probability, tokens to the text's. The language column is part
of what is coded, at the share it has among training rows.

No context reaches over the start of a token, so a distinct token is scored once and joined to the
documents' token counts (bags.py). All statistics cover all training rows:

1. token counts over all rows, and over the training rows;
2. shards of the token table: tokens that begin alike, down to a depth at which no more than LIMIT
   (or 1/4096 of all, if that is more) do, stand in one shard, so that contexts of that depth or
   more are counted inside it, in a table as large as the shard needs. These tables grow with the
   corpus and are never sent anywhere;
3. bit counts of all other contexts, in tables of fixed size that are added up and sent to all tasks:
   the short contexts, of which there is a bounded number, and those above a shard's depth;
4. gate weights and refinement: each shard is a lesson. It is learned online in an order given by
   the tokens' hashes, each token predicted as if its own occurrence had not been counted; the
   lessons' weights are averaged. A shard is a function of the token table alone, so scores don't
   depend on how rows lie in partitions;
5. one score per distinct token, then sums per document.

Cases: null and empty texts have only the end token; a null doc_id is held out (the checksum of no
text is 0); repeated rows each get a row; other columns are not read; an empty table gives an
empty result. Contexts restart inside a token after 65,536 bytes, which bounds a task's memory.
Tokens that share more than the last of LEVELS with too many others are dealt by hash: contexts
beyond that depth are then counted per shard.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm import bags
from cartwheel.llm.common import give_back, record, stage

HOT = 250_000
#: Bytes of context of each predictor (0: the whole token so far) and log2 of its shared table's size.
PREDICTORS = ((1, 16), (2, 20), (4, 21), (0, 20))
SLOTS = sum(1 << bits for _, bits in PREDICTORS)
PAGE = 1 << 14
PART = 65_536
GATES = 20
BUCKETS = 32
PRIOR = 0.05
RATE = 0.8
#: Bytes of tokens between two steps of the weights.
STEP = 8192
END = b"\n"
#: Tokens of a shard on average, and how many that begin alike stay together.
SHARD, LIMIT, HOT_SHARE = 32_768, 65_536, 4096
#: Bytes of a token that may decide its shard, tried in turn.
LEVELS = (2, 4, 7, 11, 16, 24, 32, 48, 64)
_NODE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.full(PART + 1, 0x5851F42D4C957F2D, np.uint64), dtype=np.uint64)


def token_bag(text: bytes, mark: int) -> dict:
    """Lower-cased words and one end token, each after the four bytes of the language's mark."""
    lead = mark.to_bytes(4, "big")
    bag = {lead + w: n for w, n in Counter(text.lower().split()).items()}
    bag[lead + END] = 1
    return bag


class Bits:
    """The bits of a chunk of marked tokens with the table slots of their contexts.

    ``deep`` marks bytes whose whole context is counted in the tokens' shard.
    """

    def __init__(self, tokens: list[bytes], depths: np.ndarray | None = None):
        parts, owner = [], []
        marks = np.array([int.from_bytes(t[:4], "big") for t in tokens], np.uint64)
        for i, t in enumerate(tokens):
            t = t[4:] if t[4:] != END else b""
            for at in range(0, len(t), PART):
                parts.append(t[at:at + PART])
                owner.append(i)
            if t and len(t) % PART:
                parts[-1] += b" "
            else:
                parts.append(b" ")
                owner.append(i)
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        first = np.cumsum(length) - length
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.owner = np.repeat(np.array(owner), length)
        self.place = np.arange(len(self.data)) - np.repeat(first, length)
        self.deep = np.zeros(len(self.data), bool) if depths is None \
            else self.place >= depths[self.owner]
        #: The place's part of the gate.
        self.zone = np.searchsorted([1, 2, 4, 7], self.place, side="right") * 4
        wide = self.data.astype(np.uint64) + np.uint64(1)
        back = [np.zeros(len(wide), np.uint64)]
        for k in range(1, 1 + max(n for n, _ in PREDICTORS)):
            back.append(np.where(self.place >= k, np.roll(wide, k), np.uint64(0)))
        terms = wide * _POWERS[self.place]
        before = np.cumsum(terms, dtype=np.uint64) - terms
        whole = before - np.repeat(before[first], length)
        marks = (marks * _NODE)[self.owner]
        self.contexts = []
        for k, (n, _) in enumerate(PREDICTORS):
            if n:
                c = back[1].copy()
                for j in range(2, n + 1):
                    c |= back[j] << np.uint64(9 * (j - 1))
            else:
                c = whole
            self.contexts.append(((c + np.uint64(k + 1)) * _SPREAD) ^ marks)

    def each(self, inner_bits: int = 0) -> Iterator[tuple]:
        """For every bit of a byte: its values, the bits before it, slots of the shared tables, and
        with ``inner_bits`` the deep bytes' slots of the shard's table."""
        node = np.ones(len(self.data), np.int64)
        for k in range(8):
            bit = (self.data >> np.uint8(7 - k)) & np.uint8(1)
            mixed = (node.astype(np.uint64) + np.uint64(k << 8)) * _NODE
            slots, base, spread = [], 0, None
            for c, (_, bits) in zip(self.contexts, PREDICTORS):
                spread = (c ^ mixed) * _SPREAD
                slots.append((spread >> np.uint64(64 - bits)).astype(np.int64) + base)
                base += 1 << bits
            inner = (spread[self.deep] >> np.uint64(64 - inner_bits)).astype(np.int64) \
                if inner_bits else None
            yield bit, node, slots, inner
            node = node * 2 + bit

    def each_inner(self, inner_bits: int, among: np.ndarray) -> Iterator[tuple]:
        """The values of every bit of the bytes ``among``, and their slots of the shard's table."""
        data, c = self.data[among], self.contexts[-1][among]
        node = np.ones(len(data), np.int64)
        for k in range(8):
            bit = (data >> np.uint8(7 - k)) & np.uint8(1)
            mixed = (node.astype(np.uint64) + np.uint64(k << 8)) * _NODE
            yield bit, (((c ^ mixed) * _SPREAD) >> np.uint64(64 - inner_bits)).astype(np.int64)
            node = node * 2 + bit

class Shard:
    """Tokens that hold all there is of their deep contexts, and the counts of these contexts."""

    KEEP = 1 << 20  # bytes of tokens whose bits are kept between counting and use
    ROOM = 1  # the table has 2 ** ROOM to 2 ** (ROOM + 1) slots a bit of a deep byte

    def __init__(self, words: list[bytes], seen: np.ndarray, depths: np.ndarray,
                 step: int = 16_384):
        self.words, self.seen, self.depths = words, seen, depths
        self.ranges = list(chunks(words, step))
        self.kept: list[Bits] | None = None
        if sum(map(len, words)) <= self.KEEP:
            self.kept = [Bits(words[a:b], depths[a:b]) for a, b in self.ranges]
        deep = sum(int(bits.deep.sum()) for _, _, bits in self.parts())
        self.inner_bits = max(8, (8 * deep).bit_length() + self.ROOM)
        self.table = np.zeros(2 << self.inner_bits, np.float32)
        for a, b, bits in self.parts():
            weight = seen[a:b][bits.owner]
            among = np.flatnonzero(bits.deep & (weight > 0))
            weight = weight[among]
            for bit, inner in bits.each_inner(self.inner_bits, among):
                np.add.at(self.table, 2 * inner + bit, weight)

    def parts(self) -> Iterator[tuple[int, int, Bits]]:
        for i, (a, b) in enumerate(self.ranges):
            yield a, b, self.kept[i] if self.kept else Bits(self.words[a:b], self.depths[a:b])


def counted(bits: Bits, table: np.ndarray, shard: Shard | None) -> Iterator[tuple]:
    """For every bit of a byte: its values, the bits before it, and each predictor's counts."""
    deep, shared = np.flatnonzero(bits.deep), np.flatnonzero(~bits.deep)
    both = table.view(np.int64)  # the two counts of a slot are fetched as one
    for bit, node, slots, inner in bits.each(shard.inner_bits if shard else 0):
        found = [both[s] for s in slots[:-1]]
        if shard:
            last = np.empty(len(bit), np.int64)
            last[deep], last[shared] = shard.table.view(np.int64)[inner], both[slots[-1][shared]]
            found.append(last)
        else:
            found.append(both[slots[-1]])
        yield bit, node, [(f.view(np.float32)[::2], f.view(np.float32)[1::2]) for f in found]


def chunks(tokens: list[bytes], size: int = 65_536) -> Iterator[tuple[int, int]]:
    """Ranges of tokens of about ``size`` bytes."""
    begin = total = 0
    for i, t in enumerate(tokens):
        total += len(t) + 1
        if total >= size:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(tokens):
        yield begin, len(tokens)


def summed(vectors: DataFrame, key: str, dtype: type) -> DataFrame:
    """Sums of the vectors (``data``) of each ``key``, added one after the other as they stream by:
    a task holds one sum, however many vectors there are."""
    schema = pa.schema([(key, pa.int32()), ("data", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for k, data in zip(batch.column(key).to_pylist(), batch.column("data")):
                part = np.frombuffer(data.as_buffer(), dtype)
                if k == at:
                    total += part
                    continue
                if total is not None:
                    yield record(schema, [[at], [total.tobytes()]])
                at, total = k, part.copy()
        if total is not None:
            yield record(schema, [[at], [total.tobytes()]])

    return (vectors.repartition(key).sortWithinPartitions(key)
            .mapInArrow(add, f"{key} int, data binary"))


def bit_counts(tokens: DataFrame) -> np.ndarray:
    """(slots, 2) counts of 0 and 1 over the training tokens, of contexts that no shard counts; of
    fixed size, summed by pages."""
    schema = pa.schema([("page", pa.int32()), ("data", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, any_row = np.zeros(2 * SLOTS), False
        for batch in batches:
            words = batch.column("token").to_pylist()
            seen = batch.column("c").to_numpy(zero_copy_only=False).astype(np.float64)
            depths = batch.column("depth").to_numpy(zero_copy_only=False)
            any_row = any_row or bool(words)
            for a, b in chunks(words):
                bits = Bits(words[a:b], depths[a:b])
                weight = seen[a:b][bits.owner]
                shared = ~bits.deep
                for bit, _, slots, _ in bits.each():
                    for s in slots[:-1]:
                        np.add.at(table, 2 * s + bit, weight)
                    np.add.at(table, 2 * slots[-1][shared] + bit[shared], weight[shared])
        if any_row:
            for page in range(0, SLOTS, PAGE):
                part = table[2 * page:2 * (page + PAGE)]
                if part.any():
                    yield record(schema, [[page // PAGE], [part.tobytes()]])

    pages = summed(tokens.filter("c > 0").select("token", "c", "depth")
                   .mapInArrow(count, "page int, data binary"), "page", np.float64).toArrow()
    out = np.zeros(2 * SLOTS, np.float32)
    for page, data in zip(pages.column("page").to_pylist(), pages.column("data").to_pylist()):
        part = np.frombuffer(data)
        out[2 * PAGE * page:2 * PAGE * page + len(part)] = part
    return out


def sharded(tokens: DataFrame) -> DataFrame:
    """``tokens`` with depth and shard: functions of the set of tokens."""
    count = tokens.count()
    limit = max(LIMIT, count // HOT_SHARE)
    key, depth = F.lit(None).cast("string"), F.lit(LEVELS[-1])
    left, crowded = tokens.select("token"), []
    for level in LEVELS:  # mostly one or two rounds
        lead = F.hex(F.substring("token", 1, 4 + level))
        full = [r[0] for r in left.groupBy(lead.alias("lead")).count()
                .filter(F.col("count") > limit).select("lead").collect()]  # at most HOT_SHARE
        crowded.append((level, lead, full))
        if not full:
            break
        left = left.filter(lead.isin(full))
    for level, lead, full in reversed(crowded):
        here = ~lead.isin(full) if full else F.lit(True)
        key, depth = F.when(here, lead).otherwise(key), F.when(here, level).otherwise(depth)
    shards = max(1, -(-count // SHARD))
    return (tokens.withColumn("depth", depth.cast("int"))
            .withColumn("shard", F.pmod(F.xxhash64(F.coalesce(key, F.hex("token"))), F.lit(shards))))


def shard_of(group: pa.Table, step: int | None = None) -> tuple[np.ndarray, Shard]:
    """An order of a group's tokens, and the shard in that order: by their hashes for a lesson of
    ``step`` bytes at a time, else as they are spelt, so that neighbours share contexts."""
    words = group.column("token").to_pylist()
    if step:
        order = np.argsort(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64,
                                       len(words)), kind="stable")
    else:
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    return order, Shard([words[i] for i in order.tolist()],
                        group.column("c").to_numpy().astype(np.float32)[order],
                        group.column("depth").to_numpy()[order], step or 16_384)


def gate(zone: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Number of the weight set: place in the token by how much the longest context has seen."""
    return zone + (seen >= 0.5) + (seen >= 4) + (seen >= 32)


def refine_key(node: np.ndarray, odds: np.ndarray) -> np.ndarray:
    return node * BUCKETS + np.clip((odds * 2 + BUCKETS / 2), 0, BUCKETS - 1).astype(np.int64)


def odds_of(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.log((one + np.float32(PRIOR)) / (zero + np.float32(PRIOR)))


def learn_gates(tokens: DataFrame, counts) -> tuple[np.ndarray, np.ndarray]:
    """Weights (gates, predictors) and refinement (256 * buckets,) log odds, from all shards."""
    k = len(PREDICTORS)
    size = 2 * GATES * k + 512 * BUCKETS

    def learn(group):  # no annotations: as strings they can't be told apart
        table = counts.value
        weights = np.full((GATES, k), 0.4)
        mass = np.full((GATES, k), 1e-3)
        refine = np.zeros((2, 256 * BUCKETS))
        _, shard = shard_of(group, STEP)
        for a, b, bits in shard.parts():
            times = shard.seen[a:b][bits.owner]
            for bit, node, pairs in counted(bits, table, shard):
                one_bit = bit.astype(np.float32)
                pairs = [(np.maximum(z - (1 - one_bit), 0), np.maximum(o - one_bit, 0))
                         for z, o in pairs]
                x = [odds_of(z, o) for z, o in pairs]
                which = gate(bits.zone, pairs[-1][0] + pairs[-1][1])
                now = weights.T.astype(np.float32)
                odds = sum(x[j] * now[j][which] for j in range(k))
                p = 1 / (1 + np.exp(-odds))
                miss, curve = times * (one_bit - p), times * p * (1 - p) + 1e-6
                for j in range(k):  # a step of Newton's method for each weight alone
                    slope = np.bincount(which, miss * x[j], GATES)
                    bend = np.bincount(which, curve * x[j] * x[j], GATES)
                    mass[:, j] = mass[:, j] * 0.98 + bend
                    weights[:, j] += RATE / k * np.clip(slope / (mass[:, j] + 1), -0.5, 0.5)
                key = refine_key(node, odds)
                refine[0] += np.bincount(key, times * (1 - one_bit), 256 * BUCKETS)
                refine[1] += np.bincount(key, times * one_bit, 256 * BUCKETS)
        give_back()
        # the weights' share in the average follows what each gate has seen here
        return pa.table({"data": pa.array([np.concatenate(
            [(weights * mass).ravel(), mass.ravel(), refine.ravel()]).tobytes()], pa.binary())})

    schema = pa.schema([("at", pa.int32()), ("data", pa.binary())])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("data"):
                part = np.frombuffer(data.as_buffer())
                total = part.copy() if total is None else total + part
        if total is not None:  # one vector a task, in one of sixteen sums
            yield record(schema, [[TaskContext.get().partitionId() % 16], [total.tobytes()]])

    lessons = (tokens.filter("c > 0").select("shard", "token", "c", "depth").groupBy("shard")
               .applyInArrow(learn, "data binary").mapInArrow(together, "at int, data binary"))
    total = np.zeros(size)
    for row in summed(lessons, "at", np.float64).collect():  # at most 16, of fixed size
        total += np.frombuffer(row["data"])
    n = GATES * k
    weights = np.where(total[n:2 * n] > 0, total[:n] / np.maximum(total[n:2 * n], 1e-9), 0.4)
    zero, one = total[2 * n:].reshape(2, -1)
    centre = (np.arange(BUCKETS) - BUCKETS / 2 + 0.5) / 2  # a bucket's own odds as the prior
    p = 1 / (1 + np.exp(-np.tile(centre, 256)))
    return weights.reshape(GATES, k), np.log((one + 8 * p) / (zero + 8 * (1 - p)))


def token_log10(words: list[bytes], table: np.ndarray, weights: np.ndarray, refine: np.ndarray,
                shard: Shard | None = None) -> np.ndarray:
    """log10 probability of every token; ``words`` are those of ``shard`` where there is one."""
    out = np.zeros(len(words))
    parts = shard.parts() if shard else ((a, b, Bits(words[a:b])) for a, b in chunks(words))
    now = np.ascontiguousarray(weights.T, np.float32)
    refined = (0.5 / (1 + np.exp(-refine))).astype(np.float32)
    for a, b, bits in parts:
        total = np.zeros(len(bits.data))
        for bit, node, pairs in counted(bits, table, shard):
            which = gate(bits.zone, pairs[-1][0] + pairs[-1][1])
            odds = sum(odds_of(z, o) * now[j][which] for j, (z, o) in enumerate(pairs))
            p = np.float32(0.5) / (1 + np.exp(-odds)) + refined[refine_key(node, odds)]
            p = np.clip(p, np.float32(1e-6), np.float32(1 - 1e-6))
            total += np.log(np.where(bit == 1, p, 1 - p))
        total /= np.log(10)
        out[a:b] = np.bincount(bits.owner, total, b - a)
    return out


def score_documents(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    language = F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")
    marked = docs.select(F.col("doc_id").cast("long"), "text", F.crc32(language).alias("mark"),
                         (F.crc32(id_text) % 10 == 0).alias("held_out"))
    both = (bags.corpus_counts(marked.filter("not held_out"), token_bag, "binary")
            .select("token", F.col("n").alias("c"), F.col("n"))
            .unionByName(bags.corpus_counts(marked.filter("held_out"), token_bag, "binary")
                         .select("token", F.lit(0).cast("long").alias("c"), "n"))
            .groupBy("token").agg(F.sum("c").alias("c"), F.sum("n").alias("n")))
    marks = stage(both, "tokens")
    # the base counts a word over all languages: as many rows as words, joined to the marked ones
    word = F.substring("token", 5, 1 << 30)
    words = (marks.filter("c > 0").groupBy(word.alias("word"))
             .agg(F.sum("c").alias("all_c")))
    tokens = stage(sharded(marks).withColumn("word", word).join(words, "word", "left")
                   .select("token", "n", "c", F.coalesce("all_c", F.lit(0)).alias("all_c"),
                           "depth", "shard"), "tokens")
    known = words.agg(F.coalesce(F.sum("all_c"), F.lit(0)).alias("n"),
                      F.count("*").alias("v")).first()
    n, v = int(known["n"]), int(known["v"])
    rows = int(tokens.filter(word == F.lit(END))
               .agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])  # training rows of all languages
    counts = spark.sparkContext.broadcast(bit_counts(tokens))  # of fixed size
    weights, refine = learn_gates(tokens, counts)
    schema = pa.schema([("token", pa.binary()), ("n", pa.int64()), ("known", pa.float64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def value(group):
        order, shard = shard_of(group)
        score = np.empty(len(order))
        score[order] = token_log10(shard.words, counts.value, weights, refine, shard)
        for i, w in enumerate(shard.words):
            if w[4:] == END:  # one in each document, it codes the language too
                score[order[i]] += np.log10((shard.seen[i] + 0.5) / (max(rows, 1) + 1))
        c = group.column("all_c").to_numpy()
        give_back()
        return pa.Table.from_arrays([
            group.column("token"), group.column("n"), pa.array((c > 0).astype(np.float64)),
            pa.array(np.log10((c + 0.1) / (n + 0.1 * (v + 1)))), pa.array(score)], schema=schema)

    values = stage(tokens.groupBy("shard").applyInArrow(
        value, "token binary, n long, known double, base_score double, score double"), "scores")
    sums = bags.document_sums(
        marked.drop("held_out"), token_bag, values, ["known", "base_score", "score"],
        "binary", lambda text, bag: (len(text), sum(bag.values())), ["n_bytes", "n_tokens"], hot)
    return sums.select("doc_id", (F.crc32(id_text) % 10 == 0).alias("held_out"), "n_tokens",
                       F.round("known").cast("long").alias("n_known"),
                       F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
                       (-F.col("score") * F.lit(float(np.log2(10)))
                        / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
