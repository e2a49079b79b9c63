"""Alignment of two tokenizers' ids over the same text, and corpus-wide support of linked ids.

1. Both tokenizers encode a space and the text. Tokens are turned back into bytes; where either's
   bytes are not the text's, the row has no tokens.
2. Byte ends of the tokens go into a dictionary from end to token index, one a tokenizer. The
   intersection of their keys, sorted, cuts both id lists into groups: the shortest stretches that
   begin and end together. Every A token of a group is linked with every B token of it.
3. Links are written per row as distinct id pairs with their number. The number of rows that hold a
   pair, and the best pair of each A id, are corpus-wide counts; rows meet the counts of their pairs
   in a join. The ``hot`` most frequent pairs (a fixed number) are broadcast, as they occur in most
   rows; all others are shuffled.

A row's pairs are written in pieces of at most ``PIECE``, so that neither a long text nor one
large group makes a large row; a row with more than ``EXPANDED`` links is worked on A id by A id.

Cases: null and empty texts, and texts that a tokenizer doesn't give back, have no tokens: zeros and
an empty ``groups``; special tokens' strings inside texts are plain text; repeated rows each count as
a row; null doc_ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import record, slices, stage, texts_of
from cartwheel.llm.token_counts import byte_letters

#: Id pairs are kept as A id * 2^20 + B id.
SHIFT = 20
#: Id pairs in one row of the link table.
PIECE = 65_536
#: Links that are expanded at once.
EXPANDED = 2_000_000
#: Most frequent pairs that are broadcast: about 10 MB.
HOT = 200_000

# The space mark of sentencepiece files, and what byte-level vocabularies cut at.
MARK = "▁"
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        value = {c: b for b, c in enumerate(byte_letters())}
        self.bytes = [b""] * self.library.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        specials = {t["id"] for t in spec.get("added_tokens", [])}
        for token, i in self.library.get_vocab().items():
            if i not in specials:
                self.bytes[i] = bytes([value[c] for c in token])
        self.ranks = self._ranks(spec, specials)

    def _ranks(self, spec: dict, specials: set[int]):
        """A faster engine with the same ids, where ids are the merges' order; else None."""
        import tiktoken
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        vocab, ends = model.get("vocab", {}), model.get("end_of_word_suffix")
        in_order = all(vocab.get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
        if (model.get("type"), cut.get("type"), cut.get("use_regex", True), spec.get("normalizer")) \
                != ("BPE", "ByteLevel", True, None) or cut.get("add_prefix_space") or ends \
                or model.get("ignore_merges") or not in_order or len(vocab) - len(
                    specials & set(vocab.values())) != 256 + len(merges):
            return None
        ranks = {b: i for i, b in enumerate(self.bytes) if b}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks,
                                 special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        # a space is put before the text; the other tokenizer adds its own
        if self.ranks is not None:
            return [self.ranks.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.library.encode_batch_fast(
            [" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that puts a space before the text and falls back to bytes."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else
                              b"" if self.library.is_control(i) or self.library.is_unknown(i)
                              else piece.replace(MARK, " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Side:
    """One tokenizer with its tokens' bytes and their lengths."""

    def __init__(self, tokenizer):
        self.encode, self.bytes = tokenizer.encode, tokenizer.bytes
        self.lengths = np.array(list(map(len, self.bytes)), np.int64)


class Printer:
    """Prints groups: every id with what may follow it, A's ids before B's."""

    def __init__(self, side_a: Side, side_b: Side):
        self.size = len(side_a.bytes), len(side_b.bytes)
        # in a group, and as its last token
        self.texts = [f"{i}{end}" for size, ends in zip(self.size, (",|", ",;"))
                      for end in ends for i in range(size)]

    def groups(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the groups' ids in order."""
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        shown_a, shown_b = a.copy(), b + 2 * self.size[0]
        shown_a[ends_a - 1] += self.size[0]
        shown_b[ends_b - 1] += self.size[1]
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + np.repeat(ends_b - n_b, n_a)] = shown_a
        shown[np.arange(len(b)) + np.repeat(ends_a, n_b)] = shown_b
        return "".join(map(self.texts.__getitem__, shown.tolist()))[:-1]


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side, Printer]:
    """One pair of tokenizers a worker process."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    pair = Side(ByteBpe(path_a)), Side(Pieces(path_b))
    return (*pair, Printer(*pair))


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of A and B tokens up to each byte end that both have; arguments: tokens' lengths."""
    index_a = dict(zip(np.cumsum(a).tolist(), range(1, len(a) + 1)))
    index_b = dict(zip(np.cumsum(b).tolist(), range(1, len(b) + 1)))
    ends = sorted(filter(index_b.__contains__, index_a))  # the keys of both
    return (np.fromiter(map(index_a.__getitem__, ends), np.int64, len(ends)),
            np.fromiter(map(index_b.__getitem__, ends), np.int64, len(ends)))


def _weighted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) and how often each occurs."""
    found, times = np.unique(group << SHIFT | ids, return_counts=True)
    return found >> SHIFT, found & ((1 << SHIFT) - 1), times


def links(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray,
          expanded: int = EXPANDED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct id pairs and the number of their links; each pair in one part."""
    n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    group = np.repeat(np.arange(len(n_a)), n_a)
    times_a, times_b, parts = None, None, 1
    if int(n_a @ n_b) > expanded:
        # equal ids of a group are taken together, and A ids in parts
        group, a, times_a = _weighted(group, a)
        in_b, b, times_b = _weighted(np.repeat(np.arange(len(n_b)), n_b), b)
        n_b = np.bincount(in_b, minlength=len(n_b))
        ends_b = np.cumsum(n_b)
        parts = -(-int(n_b[group].sum()) // expanded)
    first_b = ends_b - n_b
    for part in range(parts):
        mine = np.flatnonzero(a % parts == part) if parts > 1 else np.arange(len(a))
        each = n_b[group[mine]]
        at_b = np.arange(each.sum()) + np.repeat(first_b[group[mine]] - np.cumsum(each) + each, each)
        pairs = np.repeat(a[mine], each) << SHIFT | b[at_b]
        if times_a is None:
            yield np.unique(pairs, return_counts=True)
        else:
            found, where = np.unique(pairs, return_inverse=True)
            times = np.zeros(len(found), np.int64)
            np.add.at(times, where, np.repeat(times_a[mine], each) * times_b[at_b])
            yield found, times


ALIGNED = pa.schema([
    ("row", pa.int64()), ("head", pa.bool_()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
    ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
ALIGNED_DDL = ("row long, head boolean, doc_id long, n_a long, n_b long, n_groups long, "
               "n_links long, groups string, pairs array<long>, times array<long>")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment of every row of ``docs`` (doc_id, text) and its links.

    A row has one line with ``head`` true (doc_id, n_a, n_b, n_groups, n_links and the printed
    ``groups``) and further ones if it has many pairs; ``pairs`` and ``times`` are spread over all
    of them. ``row`` numbers rows. It depends on the layout, so write the result before using it
    twice.
    """
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b, printer = sides(path_a, path_b)
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 128):
            raw = texts_of(batch)
            texts = [t.decode("utf-8", "replace") for t in raw]
            lines: list[tuple] = []
            size = 0
            for doc_id, text, ids_a, ids_b in zip(batch.column("doc_id").to_pylist(), raw,
                                                  side_a.encode(texts), side_b.encode(texts)):
                number += 1
                want = b" " + text
                if not text or b"".join(map(side_a.bytes.__getitem__, ids_a)) != want \
                        or b"".join(map(side_b.bytes.__getitem__, ids_b)) != want:
                    lines.append((number, True, doc_id, 0, 0, 0, 0, "", [], []))
                    continue
                a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
                ends_a, ends_b = common_ends(side_a.lengths[a], side_b.lengths[b])
                n_links = int(np.diff(ends_a, prepend=0) @ np.diff(ends_b, prepend=0))
                head = (True, doc_id, len(a), len(b), len(ends_a), n_links,
                        printer.groups(a, b, ends_a, ends_b))
                for pairs, times in links(a, b, ends_a, ends_b):
                    for at in range(0, len(pairs), PIECE):
                        lines.append((number, *head, pairs[at:at + PIECE], times[at:at + PIECE]))
                        head = (False, None, None, None, None, None, None)
                        size += PIECE if len(pairs) > PIECE else len(pairs)
                        if size > 4 * PIECE:
                            yield record(ALIGNED, [list(c) for c in zip(*lines)])
                            lines, size = [], 0
            if lines:
                yield record(ALIGNED, [list(c) for c in zip(*lines)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(aligned, ALIGNED_DDL)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): rows that hold an id pair, and whether none of its A id is in more.

    The best count of each A id is one row per id, so the vocabulary bounds that broadcast.
    """
    counts = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count("*").alias("n")), "pair-counts")
    id_a = F.shiftright("pair", SHIFT)
    most = counts.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("most"))
    return counts.withColumn("id_a", id_a).join(F.broadcast(most), "id_a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_support(aligned: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """row, n_best, count_sum: links whose pair is the best of its A id, and counts over links."""
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    # the limit bounds the broadcast
    top = stage(counts.orderBy(F.desc("n"), "pair").limit(hot), "hot-pairs")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    warm = held.join(F.broadcast(top), "pair").groupBy("row").agg(*sums)
    cold = held.join(F.broadcast(top.select("pair")), "pair", "left_anti").join(
        counts, "pair").groupBy("row").agg(*sums)
    return warm.unionByName(cold)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum, for every row."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = stage(align(docs, path_a, path_b).withColumn("groups", digest), "aligned")
    support = link_support(aligned, stage(pair_counts(aligned), "pairs"), hot)
    figures = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    heads = aligned.filter("head").select(
        "row", *figures, F.lit(0).cast("long").alias("n_best"),
        F.lit(0).cast("long").alias("count_sum"))
    nothing = [F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in figures]
    return (heads.unionByName(support.select("row", *nothing, "n_best", "count_sum"))
            .groupBy("row").agg(*[F.max(c).alias(c) for c in figures],
                                F.sum("n_best").alias("n_best"),
                                F.sum("count_sum").alias("count_sum"))
            .select(*figures[:-1], F.col("groups").alias("groups_sha256"), "n_best", "count_sum"))
