"""Token counts without token ids: pieces are counted once per distinct pre-token.

1. Every text is cut into pre-tokens; a corpus-wide count of distinct pre-tokens is made.
2. The vocabulary's merges run once per distinct pre-token, giving its number of pieces.
3. Per document, pre-token frequencies are joined to these numbers and summed (bags.py).

Cases: null text counts as empty (0 tokens); repeated rows each get a row; other columns are not
read; an empty table gives an empty result; a text may be one very long pre-token.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm import bags
from cartwheel.llm.common import record, slices, stage

#: Entries of the token table that are sent to tasks: about 60 MB a worker at most.
HOT = 400_000

# The normaliser and split pattern of the supported vocabulary file.
NORMALISER = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: The same pattern for texts of U+0000 to U+017F without U+0130, where classes can be listed.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBER, _SPACE = "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_OTHER = re.compile("[^\x00-įı-ſ]")


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte value."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class PreTokens:
    """Cuts texts into pre-tokens and counts the pieces of a pre-token, for one vocabulary file."""

    def __init__(self, path: str):
        self.path = path
        self._tools = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        if [s["type"] for s in steps] != NORMALISER or split.get("pattern") != {"Regex": PATTERN}:
            raise ValueError(f"{path}: normaliser or split pattern is not supported")

    def __getstate__(self):
        return {**self.__dict__, "_tools": None}

    def tools(self):
        if self._tools is None:
            from tokenizers import Regex, Tokenizer, pre_tokenizers
            library = Tokenizer.from_file(self.path)
            split = pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
            cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
            self._tools = (library, split, cut, byte_letters())
        return self._tools

    def _cut(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return _PLAIN.findall(text.lower())
        library, split, _, _ = self.tools()
        return [p for p, _ in split.pre_tokenize_str(library.normalizer.normalize_str(text))]

    def bag(self, text: bytes) -> Counter:
        """Pre-token frequencies; a special string is a pre-token of its own."""
        text = text.decode("utf-8", "replace")
        if not any(s in text for s in self.specials):
            return Counter(self._cut(text))
        out: Counter = Counter()
        for k, part in enumerate(self.tools()[2].split(text)):
            out.update([part] if k % 2 else self._cut(part))
        return out

    def pieces(self, token: str) -> int:
        if token in self.specials:
            return 1
        library, _, _, letters = self.tools()
        return len(library.model.tokenize("".join([letters[b] for b in token.encode()])))


def piece_table(counts: DataFrame, cutter: PreTokens) -> DataFrame:
    """(token, n, pieces): the merges run once for each row of ``counts``."""
    schema = pa.schema([("token", pa.string()), ("n", pa.int64()), ("pieces", pa.int64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            tokens = batch.column("token").to_pylist()
            yield record(schema, [tokens, batch.column("n"), [cutter.pieces(t) for t in tokens]])

    return counts.mapInArrow(measure, "token string, n long, pieces long")


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text)."""
    cutter = PreTokens(vocabulary)
    table = stage(piece_table(bags.corpus_counts(docs, cutter.bag, "string"), cutter), "pieces")
    sums = bags.document_sums(docs, cutter.bag, table, ["pieces"], "string",
                              lambda text, bag: (len(text),), ["n_bytes"], hot)
    return sums.select("doc_id", "n_bytes", F.round("pieces").cast("long").alias("n_tokens"),
                       (F.round("pieces") > limit).alias("over_limit"))
