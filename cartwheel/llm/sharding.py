"""Shards by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of slots. Bytes and rows are summed per slot, and a map of
slots to shards, balanced by bytes, is stored under a version. Rebalancing writes a new version that
moves slots, never single records; a record's slot does not change.

Equal rows are counted before the shuffle and told apart by their copy number, which takes part in
the hash: however many there are, they are spread over all slots.

Maps of all versions lie in one folder. A map opened there goes on from the newest version; asked
for another number of shards, it is edited and stored as the next one.

Cases: null text has size 1 and no bytes; null doc_id is hashed like any value; repeated rows each
keep a place; an empty table gives an empty result and a map of empty slots; other columns are not
read. A slot's rows are numbered by a sort of narrow rows within the slot, so one task sees one
slot (1/4096 of the rows). One record longer than a shard's share stays whole.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from cartwheel.llm.common import null_text_as_empty, stage
from cartwheel.session import scratch_path

SLOTS = 4096


#: Copies of equal rows that are unpacked at a time.
BLOCK = 4096


def virtual_slot(doc_id: Column, checksum: Column, copy: Column, slots: int = SLOTS) -> Column:
    """The slot of a record; ``copy`` numbers equal records from 0."""
    return F.pmod(F.xxhash64(doc_id, checksum, copy), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot: narrow rows; the texts are not moved."""
    data = F.encode(null_text_as_empty(), "UTF-8")
    equal = docs.select(F.col("doc_id").cast("long"),
                        (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
                        F.crc32(data).alias("text_crc32")).groupBy(
                            "doc_id", "size", "text_crc32").agg(F.count("*").alias("_n"))
    # unpacked in two steps, so that no array is longer than a block or the number of blocks
    copies = (equal.withColumn("_block", F.explode(F.sequence(
        F.lit(0), ((F.col("_n") - 1) / BLOCK).cast("long"))))
        .withColumn("_copy", F.explode(F.sequence(
            F.col("_block") * BLOCK, F.least(F.col("_n"), (F.col("_block") + 1) * BLOCK) - 1))))
    return copies.select("doc_id", "size", "text_crc32", virtual_slot(
        F.col("doc_id"), F.col("text_crc32"), F.col("_copy"), slots).alias("vslot"))


def slot_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def balanced_map(totals: list, slots: int, shards: int) -> list[tuple[int, int]]:
    """(slot, shard): the largest slot first, each to the shard with the fewest bytes."""
    sizes = {r["vslot"]: r["bytes"] for r in totals}
    heap = [(0, s) for s in range(shards)]
    out = []
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out.append((slot, shard))
        heapq.heappush(heap, (load + sizes.get(slot, 0), shard))
    return sorted(out)


def rebalanced_map(old: list[tuple[int, int]], totals: list, shards: int) -> list[tuple[int, int]]:
    """An edit of ``old`` for ``shards`` shards: slots move one by one off the fullest shard.

    Only as many slots move as it takes for no single move to help any more.
    """
    sizes = {r["vslot"]: r["bytes"] for r in totals}
    owner = dict(old)
    load = {s: 0 for s in range(shards)}
    held: dict[int, list] = {s: [] for s in load}
    for slot, shard in old:
        shard = shard if shard < shards else min(load, key=lambda s: (load[s], s))
        owner[slot] = shard
        load[shard] += sizes.get(slot, 0)
        held[shard].append((sizes.get(slot, 0), slot))
    for _ in range(len(owner)):
        high, low = max(load, key=lambda s: (load[s], s)), min(load, key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        best = max((x for x in held[high] if 0 < x[0] <= gap // 2), default=None)
        if best is None:
            break
        held[high].remove(best)
        held[low].append(best)
        owner[best[1]] = low
        load[high] -= best[0]
        load[low] += best[0]
    return sorted(owner.items())


class SlotMap:
    """Slot-to-shard maps of all versions, as one table in the shared folder. ``version`` is the
    newest one stored there, 0 if there is none."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "slot-map")
        try:
            stored = spark.read.schema("vslot int, shard int, version int").parquet(self.path)
            self.version = stored.agg(F.max("version")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            self.version = 0

    def store(self, pairs: list[tuple[int, int]]) -> int:
        """Add a version; earlier ones stay readable. The rows are as many as there are slots."""
        self.version += 1
        (self.spark.createDataFrame(pairs, "vslot int, shard int").coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path}/version={self.version}"))
        return self.version

    def load(self, version: int | None = None) -> DataFrame:
        return self.spark.read.schema("vslot int, shard int").parquet(
            f"{self.path}/version={version or self.version}")

    def rebalance(self, totals: list, shards: int) -> int:
        """Edit the newest map for ``shards`` shards and store it as the next version."""
        return self.store(rebalanced_map(self.pairs(), totals, shards))

    def pairs(self, version: int | None = None) -> list[tuple[int, int]]:
        return sorted((r["vslot"], r["shard"]) for r in self.load(version).collect())


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS,
                    slot_map: SlotMap | None = None) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard, slot for every row; ``slot`` is the row's place in
    its shard, 0 to rows - 1. Without a stored map, one balanced by bytes is made and stored; one
    for another number of shards is rebalanced and stored first."""
    spark = docs.sparkSession
    rows = stage(records(docs, slots), "shard-rows")
    totals = slot_totals(rows).collect()  # at most ``slots`` rows
    slot_map = slot_map or SlotMap(spark)
    if not slot_map.version:
        slot_map.store(balanced_map(totals, slots, shards))
    elif {shard for _, shard in slot_map.pairs()} != set(range(shards)):
        slot_map.rebalance(totals, shards)
    owner = dict(slot_map.pairs())
    counts = {r["vslot"]: r["rows"] for r in totals}
    begin, ahead = [], {}
    for slot in sorted(owner):
        shard = owner[slot]
        begin.append((slot, shard, ahead.get(shard, 0)))
        ahead[shard] = ahead.get(shard, 0) + counts.get(slot, 0)
    places = spark.createDataFrame(begin, "vslot int, shard int, begin long")
    order = W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("at", F.row_number().over(order))
            .join(F.broadcast(places), "vslot")  # one row a slot, a fixed number
            .select("doc_id", "size", "text_crc32", "vslot", "shard",
                    (F.col("begin") + F.col("at") - 1).alias("slot")))
