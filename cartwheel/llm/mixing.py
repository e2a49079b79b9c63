"""Mixing of sources to target weights by systematic sampling.

1. A source's target is its weight's share of the mix, at most ``most`` times its size; what is cut
   off is shared again by weight. This is one water level: target = least(cap, weight * level).
2. A document's expected copies are target / size of its source. They are added up along the
   source's order, one random offset is added, and a document is emitted once for each whole number
   that its stretch crosses, so at most ceil(expected) times.

Only the fraction of a running sum decides what it crosses. Expected copies are kept in units of
2^-32 and sums between buckets modulo one, which is exact and cannot overflow.

The order is (size class, hash, size, doc_id). Classes are 1/16 of an octave at most, so a source's
words come near its target though documents differ in length. A class is cut into ranges of the
hash of about ``BUCKET`` rows; rows are added up inside these and one row per range carries the
sums on, so a source or size that holds most of the rows is spread over many tasks.

Everything is DataFrame functions. Cases: null text has size 0; null source is a source of its own,
the last; null doc_id is kept; equal rows are counted as one group and written as many rows; a
source without words has target 0; an empty table gives an empty result; other columns only tell
rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cartwheel.llm.common import null_text_as_empty, stage

#: One expected copy.
ONE = 1 << 32
#: Rows that are added up in one task at a time, on average.
BUCKET = 1 << 16
#: Equal rows that are kept as one row.
BLOCK = 4096

# Fixed value: what separates words.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(c: str = "text") -> Column:
    return F.regexp_count(null_text_as_empty(c), F.lit(WORD)).cast("long")


def source_key(c: str = "source") -> Column:
    """Sorts by code point, null last; never null."""
    return F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(c)))


def hash32(seed: int, value: Column) -> Column:
    """0 to 2^32 - 1, from md5, so that any engine draws alike."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), value)), 1, 8), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Monotone: sizes below 32 one by one, then 16 classes an octave."""
    octave = F.length(F.bin(size))
    return F.when(size < 32, size.cast("int")).otherwise(
        octave * 32 + F.call_function("shiftright", size, octave - 5).cast("int"))


def sized_rows(docs: DataFrame, seed: int) -> DataFrame:
    """source_key, doc_id, size, same, n, class, h: one row for up to any number of equal rows.

    ``same`` is a checksum of all columns.
    """
    rows = docs.select(
        source_key().alias("source_key"), F.col("doc_id").cast("long"), n_words().alias("size"),
        F.xxhash64(*docs.columns).alias("same"))
    return (rows.groupBy("source_key", "doc_id", "size", "same").agg(F.count("*").alias("n"))
            .withColumn("class", size_class(F.col("size")))
            .withColumn("h", hash32(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """source_key, source_size, target for a table of one row per source (source_key, source_size).

    ``weights`` go round over the sources in order. The windows run over sources, not documents.
    """
    order = W.orderBy("source_key")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    rows = (sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn))
            .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    # sources that are capped come first by cap / weight; the level is the greatest of what is
    # left per weight after each of them
    filled = W.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before, everything = filled.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    left = (F.sum("source_size").over(everything) * F.lit(float(share))
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    open_weight = (F.sum("weight").over(everything)
                   - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = F.max("level").over(everything)
    return (rows.withColumn("level", left / open_weight)
            .select("source_key", "source_size",
                    F.least("cap", F.col("weight") * level).alias("target")))


def mix(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, most: float = 2,
        seed: int = 42, bucket: int = BUCKET) -> DataFrame:
    """How often the mix takes each row of ``docs`` (doc_id, text, source).

    source_key, doc_id, size, same, source_size, target, copies: one row per row of ``docs``. The
    mix has ``share`` times the words of ``docs``; no source more than ``most`` times its own and no
    document more than ceil(``most``) copies.
    """
    rows = stage(sized_rows(docs, seed), "mix-rows")
    classes = stage(rows.groupBy("source_key", "class").agg(
        F.sum(F.ceil(F.col("n") / BLOCK)).alias("blocks"), F.max("n").alias("largest"),
        F.sum(F.col("n") * F.col("size")).alias("words")), "mix-classes")
    per_source = targets(classes.groupBy("source_key").agg(F.sum("words").alias("source_size")),
                         weights, share, most)
    step = F.least(F.lit(float(most * ONE)),
                   F.floor(F.col("target") / F.col("source_size") * F.lit(float(ONE)) + F.lit(0.5)))
    plan = stage(classes.join(per_source, "source_key").select(
        "source_key", "class", "source_size", "target",
        F.ceil(F.col("blocks") / bucket).alias("ranges"),
        F.when(F.col("source_size") > 0, step).otherwise(0).cast("long").alias("step")), "mix-plan")

    blocks = (rows.join(plan, ["source_key", "class"])
              .withColumn("range", F.shiftright(F.col("h") * F.col("ranges"), 32))
              .withColumn("block", F.explode(F.sequence(
                  F.lit(0), ((F.col("n") - 1) / BLOCK).cast("long"))))
              .withColumn("n", F.least(F.lit(BLOCK), F.col("n") - F.col("block") * BLOCK))
              .withColumn("advance", F.pmod(F.col("n") * F.col("step"), F.lit(ONE))))
    place = ["source_key", "class", "range"]
    sums = blocks.groupBy(*place).agg(F.sum("advance").alias("advance"))
    ahead = W.partitionBy("source_key").orderBy("class", "range").rowsBetween(
        W.unboundedPreceding, -1)
    start = hash32(seed, F.concat(F.lit("offset|"), "source_key"))
    starts = stage(sums.select(*place, F.pmod(
        start + F.coalesce(F.sum(F.pmod("advance", F.lit(ONE))).over(ahead), F.lit(0)),
        F.lit(ONE)).alias("start")), "mix-starts")

    inside = (W.partitionBy(*place).orderBy("h", "size", "doc_id", "same", "block")
              .rowsBetween(W.unboundedPreceding, -1))
    placed = (blocks.withColumn("inside", F.coalesce(F.sum("advance").over(inside), F.lit(0)))
              .join(starts, place)
              .withColumn("start", F.pmod(F.col("start") + F.col("inside"), F.lit(ONE))))
    if (classes.agg(F.max("largest")).first()[0] or 0) > BLOCK * BLOCK:
        placed = placed.repartition("doc_id", "same", "block")  # many equal rows: spread them again
    nth = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    reach = F.col("start") + F.col("nth") * F.col("step")
    return (placed.withColumn("nth", nth)
            .select("source_key", "doc_id", "size", "same", "source_size", "target",
                    (F.shiftright(reach + F.col("step"), 32) - F.shiftright(reach, 32))
                    .alias("copies")))


def emit(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mixed`` takes it, with all columns.

    Texts are moved once, to meet their number of copies. Copies of equal rows are alike, so a
    group of them is emitted as one row's copies.
    """
    key = F.xxhash64(*docs.columns)
    copies = (mixed.groupBy(F.col("same").alias("_same"), F.col("doc_id").alias("_id"),
                            F.col("source_key").alias("_source"))
              .agg(F.sum("copies").alias("_copies")).filter("_copies > 0"))
    rows = docs.withColumns({"_same": key, "_source": source_key()}).dropDuplicates()
    met = rows.join(copies, (rows["_same"] == copies["_same"]) & (rows["_source"]
                    == copies["_source"]) & rows["doc_id"].cast("long").eqNullSafe(copies["_id"]))
    blocks = met.withColumn("_block", F.explode(F.sequence(
        F.lit(0), ((F.col("_copies") - 1) / BLOCK).cast("long"))))
    return (blocks.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.least(
        F.lit(BLOCK), F.col("_copies") - F.col("_block") * BLOCK))))
        .select(*[docs[c] for c in docs.columns]))
