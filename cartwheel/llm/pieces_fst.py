"""SentencePiece encoding and decoding by weighted finite-state transducers.

The model file is compiled into two machines. The normaliser maps white space to the space mark and
adds the leading mark. The piece machine accepts piece strings; its states are the last piece
emitted, with the byte pieces as fallback for characters that no piece covers. An input composed
with both is a lattice, and the encoding is its shortest path in the tropical semiring.

* Unigram models: the weight of an arc is the negative score of its piece.
* Merge (BPE) models: pieces are chosen by merge order, which no sum of piece weights expresses. But
  a piece sequence is the model's encoding exactly if every two neighbours are, on their own, the
  encoding of their concatenation (merges inside a part never depend on what stands outside until
  a boundary is crossed). So an arc from piece a to piece b weighs 0 if the pair is such an encoding
  and infinity otherwise, and just one path has a finite weight.

Texts are cut where no piece can reach across (before a space mark after another character, and
around characters in no longer piece); the path is searched once for each distinct cut.

Cases: null and empty texts have no pieces; other columns are not read; repeated rows stay; an empty table gives an empty result. Like the library, decoding
turns a space mark in the text into a space, and a literal mark is not told from a space.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import give_back, slices, texts_of

# Fixed values of the model file format.
MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Distinct cuts whose paths a worker remembers.
REMEMBERED = 200_000
PAIRS = 300_000


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


class PieceMachine:
    """The compiled model: ``encode`` text to ids, ``decode`` ids to text."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            top = list(message_fields(f.read()))
        trainer = dict(message_fields(next(v for k, v in top if k == 2)))
        norm = dict(message_fields(next(v for k, v in top if k == 3)))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE) or norm.get(2) or norm.get(1, b"") != b"identity" \
                or norm.get(4, 1) or not norm.get(5, 1):
            raise ValueError("only identity normalisers that keep white space are supported")
        self.prefix = bool(norm.get(3, 1))
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_id: dict[int, int] = {}
        self.out: list[bytes] = []
        for i, body in enumerate(v for k, v in top if k == 1):
            piece = dict(message_fields(body))
            text, kind = piece[1].decode(), piece.get(3, NORMAL)
            self.out.append(text.replace(MARK, " ").encode() if kind in (NORMAL, UNKNOWN) else b"")
            if kind == BYTE:
                value = int(text[3:5], 16)
                self.byte_id[value] = i
                self.out[i] = bytes([value])
            elif kind == NORMAL:
                self.ids[text] = i
                self.scores[text] = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
            elif kind in (USER, UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
        if len(self.byte_id) != 256:
            raise ValueError("a model with byte fallback is needed")
        self._compile()

    def _compile(self) -> None:
        self.steps: dict[str, int] = {}  # arcs of the piece machine: every beginning of a piece
        after: dict[str, set] = {}
        for piece in self.ids:
            for k in range(1, len(piece)):
                self.steps.setdefault(piece[:k], -1)
                after.setdefault(piece[k - 1], set()).add(piece[k])
        self.steps.update(self.ids)
        if any(MARK in after.get(c, ()) for c in after if c != MARK):
            raise ValueError("pieces that go on after a space mark are not supported")
        joined = {d for ds in after.values() for d in ds} | set(after)
        known = "".join(map(re.escape, sorted(joined - {MARK})))
        self.cuts = re.compile(f"{MARK}*[{known}]+|{MARK}+|.", re.DOTALL)
        self.after = after
        self.pairs: dict[tuple[str, str], bool] = {}
        self.built: dict[str, tuple | None] = {}
        self.paths = _Paths(self)

    def history(self, piece: str) -> tuple | None:
        """How the merge order builds a piece from its characters: the merges' scores, and the last
        and first part before and after each. None if it does not build this piece."""
        if piece in self.built:
            return self.built[piece]
        parts, scores = list(piece), self.scores
        merges, ends, starts = [], [parts[-1]], [parts[0]]
        while len(parts) > 1:
            best, where = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, k
            if where < 0:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
            merges.append(best)
            ends.append(parts[-1])
            starts.append(parts[0])
        merges.append(-np.inf)
        found = self.built[piece] = (merges, ends, starts) if len(parts) == 1 else None
        return found

    def weight_is_zero(self, last: str, piece: str) -> bool:
        """Whether the arc from the state ``last`` by ``piece`` has a finite weight.

        The two parts' merges are run side by side, best score first and leftmost among equals;
        the weight is infinite as soon as a merge across the boundary comes first.
        """
        right = self.history(piece)
        if right is None or not last:
            return right is not None
        pair = self.pairs.get((last, piece))
        if pair is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            (left_merges, ends, _), (right_merges, _, starts) = self.history(last), right
            i = j = 0
            scores, pair = self.scores, True
            while True:
                across = scores.get(ends[i] + starts[j])
                ahead, behind = left_merges[i], right_merges[j]
                if across is not None and across > ahead and across >= behind:
                    pair = False
                    break
                if ahead >= behind:
                    if ahead == -np.inf:
                        break
                    i += 1
                else:
                    j += 1
            self.pairs[last, piece] = pair
        return pair

    def arcs(self, text: str, at: int) -> list[str]:
        """Pieces that may start at a position, shortest first; a bare character always may."""
        found = [text[at]]
        steps, end = self.steps, at + 1
        while end <= len(text):
            piece = text[at:end]
            value = steps.get(piece)
            if value is None:
                break
            if value >= 0 and end > at + 1:
                found.append(piece)
            end += 1
        return found

    def zero_path(self, text: str) -> list[str]:
        """The path of finite weight through the lattice of a merge model, longest arcs first.

        Every weight is 0 or infinity, so the first path found is the shortest; states from
        which the end can't be reached are remembered, so each is visited once.
        """
        n, arcs, pairs, check = len(text), self.arcs, self.pairs, self.weight_is_zero
        dead: set[tuple[int, str]] = set()
        path: list[str] = []
        open_arcs = [arcs(text, 0)]
        at, last = 0, ""
        while True:
            choices = open_arcs[-1]
            while choices:
                piece = choices.pop()
                fits = pairs.get((last, piece))
                if fits is None:
                    fits = check(last, piece)
                if fits and not (dead and (at + len(piece), piece) in dead):
                    path.append(piece)
                    at += len(piece)
                    if at == n:
                        return path
                    last = piece
                    open_arcs.append(arcs(text, at))
                    break
            else:
                open_arcs.pop()
                if not open_arcs:
                    raise ValueError("no path")
                dead.add((at, path.pop()))
                at -= len(last)
                last = path[-1] if path else ""

    def lightest_path(self, text: str) -> list[str]:
        """Shortest path of a unigram model: the lattice's positions in order."""
        fallback = min(self.scores.values()) - 10.0
        best: list[tuple[float, str]] = [(0.0, "")] + [(np.inf, "")] * len(text)
        for at in range(len(text)):
            for piece in self.arcs(text, at):
                total = best[at][0] - self.scores.get(piece, fallback)
                if total < best[at + len(piece)][0]:
                    best[at + len(piece)] = (total, piece)
        path, at = [], len(text)
        while at:
            path.append(best[at][1])
            at -= len(best[at][1])
        return path[::-1]

    def path_ids(self, text: str) -> bytes:
        """The shortest path's ids as 32-bit values."""
        path = self.zero_path(text) if self.kind == BPE else self.lightest_path(text)
        try:
            return array("i", [self.ids[p] for p in path]).tobytes()
        except KeyError:
            return array("i", chain.from_iterable(
                [self.ids[p]] if p in self.ids else [self.byte_id[b] for b in p.encode()]
                for p in path)).tobytes()

    def forget(self) -> None:
        """Gives back the memory of paths and pairs: a worker process outlives its task."""
        self.paths.clear()
        self.paths.older = {}
        self.pairs.clear()
        give_back()

    def normalise(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.paths.__getitem__, self.cuts.findall(
            self.normalise(text)))), np.int32)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


class _Paths(dict):
    """Paths of cuts already met, in two generations: what is used again outlives the older one."""

    def __init__(self, machine: PieceMachine):
        super().__init__()
        self.machine, self.older = machine, {}

    def __missing__(self, cut: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        found = self.older.get(cut)
        if found is None:
            # no piece holds two characters that stand side by side in no piece: cut there too
            after, begin, parts = self.machine.after, 0, []
            for k in range(1, len(cut)):
                if cut[k] not in after.get(cut[k - 1], ()):
                    parts.append(cut[begin:k])
                    begin = k
            if begin:
                parts.append(cut[begin:])
                found = b"".join([self[p] for p in parts])
            else:
                found = self.machine.path_ids(cut)
        self[cut] = found
        return found


@lru_cache(maxsize=2)
def machine(path: str) -> PieceMachine:
    """One compiled machine a worker process."""
    return PieceMachine(path)


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()),
                     ("pieces", pa.list_(pa.int32()))])
DECODED = ENCODED.append(pa.field("text", pa.string()))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _encoded(docs: DataFrame, model: str, back: bool) -> DataFrame:
    schema = DECODED if back else ENCODED

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = machine(model)
        for batch in slices(batches, 256):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch)]
            ids = [fst.encode(t) for t in texts]
            columns = [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()),
                       _lists(ids)]
            if back:
                columns.append(pa.array([fst.decode(i.tolist()) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        fst.forget()

    ddl = "doc_id long, n_chars long, pieces array<int>" + ", text string" * back
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, ddl)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_chars and ``pieces`` (array of ids) for every row of ``docs`` (doc_id, text)."""
    return _encoded(docs, model, False)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``encode_documents`` with ``text`` read back from the ids in the same pass."""
    return _encoded(docs, model, True)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``text``, read back from ``pieces``, to the columns doc_id, n_chars, pieces."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = machine(model)
        for batch in slices(batches, 256):
            texts = [fst.decode(i) for i in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_chars"), batch.column("pieces"),
                 pa.array(texts, pa.string())], schema=DECODED)

    return (encoded.select("doc_id", "n_chars", "pieces")
            .mapInArrow(decode, "doc_id long, n_chars long, pieces array<int>, text string"))
