"""Sums over a document's tokens of values kept in a corpus-wide token table.

The token table grows with the corpus, so it is never sent to tasks as a whole. Its ``hot`` most
frequent tokens (a fixed number) are; all others meet their documents in a shuffle join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import record, slices, texts_of

#: Tokens that a task counts before it hands its sums on.
FLUSH = 300_000
ARROW = {"string": pa.string(), "binary": pa.binary()}


def _bags(batch: pa.RecordBatch, bag: Callable[..., dict]) -> Iterator[tuple[bytes, dict]]:
    """Texts and their bags; a ``mark`` column is handed to ``bag`` too."""
    texts = texts_of(batch)
    if "mark" in batch.schema.names:
        for text, mark in zip(texts, batch.column("mark").to_pylist()):
            yield text, bag(text, mark)
    else:
        for text in texts:
            yield text, bag(text)


def corpus_counts(docs: DataFrame, bag: Callable[..., dict], kind: str) -> DataFrame:
    """(token, n) over the ``text`` (and ``mark``) of all rows of ``docs``.

    No token may end with a blank.
    """
    schema = pa.schema([("token", ARROW[kind]), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        get = total.get
        for batch in batches:
            for _, found in _bags(batch, bag):
                for token, n in found.items():
                    total[token] = get(token, 0) + n
                if len(total) >= FLUSH:
                    yield record(schema, [list(total), list(total.values())])
                    total.clear()
        if total:
            yield record(schema, [list(total), list(total.values())])

    given = [c for c in ("text", "mark") if c in docs.columns]
    return (docs.select(*given).mapInArrow(count, f"token {kind}, n long")
            .groupBy("token").agg(F.sum("n").alias("n")))


def hottest(values: DataFrame, names: list[str], hot: int) -> tuple[dict, np.ndarray]:
    """Index and values of the ``hot`` most frequent tokens: bounded by that number.

    ``values`` has token, n and the columns in ``names``. Very long tokens stay in the table.
    """
    # the limit, applied by tasks first, bounds what reaches the driver
    top = (values.filter(F.octet_length("token") <= 64)
           .orderBy(F.desc("n"), "token").limit(hot).select("token", *names).toArrow())
    index = {t: i for i, t in enumerate(top.column("token").to_pylist())}
    matrix = np.stack([top.column(c).to_numpy().astype(np.float64) for c in names], axis=1) \
        if len(index) else np.zeros((0, len(names)))
    return index, matrix


def document_sums(docs: DataFrame, bag: Callable[..., dict], values: DataFrame,
                  names: list[str], kind: str, own: Callable[[bytes, dict], tuple],
                  own_names: list[str], hot: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, perhaps mark): doc_id, ``own_names`` (long) and
    ``names``.

    ``own`` measures a document from its text and bag. Each of ``names`` is the sum over the
    document's tokens of count times value (double); a token without a value adds nothing.
    Repeated rows stay as many rows; null doc_ids and null texts are kept.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hottest(values, names, hot))
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("token", ARROW[kind]),
                        ("n", pa.int64()), ("head", pa.int64()),
                        *[(c, pa.int64()) for c in own_names],
                        *[(f"hot_{c}", pa.float64()) for c in names]])
    ddl = (f"doc_id long, h long, token {kind}, n long, head long, "
           + ", ".join([f"{c} long" for c in own_names] + [f"hot_{c} double" for c in names]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, matrix = shared.value
        place = index.get
        for batch in slices(batches):
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("h").to_pylist()
            tokens, counts, doc, mark, heads = [], [], [], [], []
            for d, h, (text, found) in zip(ids, marks, _bags(batch, bag)):
                at = np.fromiter(map(lambda t: place(t, -1), found), np.int64, len(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                warm = at >= 0
                heads.append((*own(text, found), *(n[warm] @ matrix[at[warm]])))
                cold = np.flatnonzero(~warm)
                if len(cold):
                    keys = list(found)
                    tokens.extend(keys[i] for i in cold.tolist())
                    counts.append(n[cold])
                    doc.extend([d] * len(cold))
                    mark.extend([h] * len(cold))
            rest = len(own_names) + len(names)
            if tokens:
                nulls = [pa.nulls(len(tokens), f.type) for f in schema][-rest:]
                yield record(schema, [doc, mark, tokens, np.concatenate(counts),
                                      np.zeros(len(tokens), np.int64), *nulls])
            # heads carry a key that no token has (none ends with a blank), spread by the mark
            no_token = [f"{h % 4096} " if kind == "string" else b"%d " % (h % 4096) for h in marks]
            yield record(schema, [ids, marks, no_token, [0] * len(ids), [1] * len(ids),
                                  *[list(c) for c in zip(*heads)]])

    given = [c for c in ("text", "mark") if c in docs.columns]
    found = (docs.select(F.col("doc_id").cast("long"), *given, F.xxhash64(*given).alias("h"))
             .mapInArrow(rows, ddl))
    summed = (found.join(values.select("token", *names), "token", "left").groupBy("doc_id", "h")
              .agg(F.sum("head").alias("head"), *[F.max(c).alias(c) for c in own_names],
                   *[(F.max(f"hot_{c}")
                      + F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0.0)) / F.sum("head")
                      ).alias(c) for c in names]))
    # identical rows were summed together: as many rows again
    return summed.select("doc_id", *own_names, *names, F.explode(
        F.sequence(F.lit(1), F.col("head").cast("int"))).alias("copy")).drop("copy")
