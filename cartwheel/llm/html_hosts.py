"""Main text of web pages by page structure and a suffix array per host.

1. Each page is read tag by tag into blocks of text. Elements that are no running text (menus,
   footers, forms, scripts, notices, adverts, comments and so on, by tag, role, class or id) are
   left out. The page's candidates are the blocks of its article, else of its main element, else
   all that remain.
2. Pages of a host are put together in bounded chunks. In a chunk, the token streams of the pages'
   candidates are joined and sorted as suffixes (by doubling, to a depth of RUN tokens); equal
   suffixes are substrings of RUN tokens or more that pages share.
3. What chunks of one host share is counted over the whole host. Each chunk sends a packed set of
   short prints of its substrings of RUN tokens, and learns which prints other chunks have too; for
   those it sends the 64-bit hashes and its pages' counts, and gets the host's sums back. A short
   print that two substrings share costs a hash sent in vain, and changes no count. Rows of these
   exchanges are dealt by parts of the hashes, a part for PART_CHUNKS chunks, so no group grows with
   the host. A content that stands in several chunks is counted by the first of them.
4. Tokens covered by a substring that is repeated across distinct pages are boilerplate and removed;
   unique runs are kept. In pages without an article or main element two pages are enough; inside
   one, the substring must be in half of the host's pages and ten at least, so that passages
   quoted by several articles stay. The same holds for a page that would lose more than half of
   its tokens: it is another version of a page. Pages with equal candidates count as one page.

Cases: null or empty html gives an empty text; a null or broken url belongs to the host "" and is
returned as it is; null page_ids and repeated rows are rows like any other; extra columns are not
read; an empty table gives an empty result; unclosed and misnested tags are tolerated. White space
is what Unicode calls so, a no-break space included.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import PLACES, mix64, record, slices, stage

RUN = 8
CHUNK_PAGES = 256
#: Chunks of a host whose hashes meet in one group.
PART_CHUNKS = 16
#: Bits of a short print in a host of one chunk; a chunk more takes log2 of them more.
PRINT_BITS = 21
ARTICLE_SHARE, ARTICLE_PAGES = 0.5, 10

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|"""
                  r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

RAW = frozenset("script style textarea title noscript iframe template svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr object math "
                   "mi mn mo mrow msup msub msubsup mfrac msqrt mroot mtext semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end is often left out; they are not tracked unless they are left out themselves.
LOOSE = INLINE | frozenset("p li dt dd tr td th thead tbody tfoot option h1 h2 h3 h4 h5 h6".split())
OUT_TAGS = frozenset("head nav footer aside form menu dialog button select fieldset".split())
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "comment comments disqus respond replies sidebar widget widgets related recommended share "
    "sharing social menu nav navbar navigation breadcrumb breadcrumbs footer login signup search "
    "pagination pager toolbar complementary contentinfo".split())
#: Left out only outside an article or main element, where they may hold the title.
OUT_OUTSIDE = frozenset({"header", "masthead"})

#: Names with such a part say what stands beside or around, not what the element is.
LAYOUT = frozenset("has with no without open work works".split())
WRAPS = frozenset("wrap wrapper container layout area".split())
WRAPPED = frozenset("content main page site".split())

BODY, MAIN, ARTICLE = 0, 1, 2


def attribute_names(attributes: str) -> tuple[set[str], bool]:
    """(parts of the words in class, id and role; whether the element has ``hidden``)."""
    names: set[str] = set()
    hidden = False
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        hidden |= key == "hidden"
        if key in ("class", "id", "role"):
            for word in value.strip("\"'").split():
                parts = {p.lower() for p in _NAME_PART.findall(word)}
                if LAYOUT.isdisjoint(parts) and (WRAPS.isdisjoint(parts)
                                                 or WRAPPED.isdisjoint(parts)):
                    names |= parts
    return names, hidden


def page_blocks(html: str) -> tuple[int, list[str]]:
    """(kind of the candidates, their texts in order)."""
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, bool]] = []  # open elements and whether each is left out
    out = 0
    depth = {"article": 0, "main": 0}
    parts: list[str] = []
    at, size = 0, len(html)

    def close_block() -> None:
        if parts:
            words = entities.unescape("".join(parts)).split()
            parts.clear()
            if words:
                kind = ARTICLE if depth["article"] else MAIN if depth["main"] else BODY
                blocks.append((kind, " ".join(words)))

    def pop() -> None:
        nonlocal out
        name, left_out = stack.pop()
        out -= left_out
        if name in depth:
            depth[name] -= 1

    for tag in iter(lambda: _TAG.search(html, at), None):
        if tag.start() > at and not out:
            parts.append(html[at:tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name, closing, attributes = tag[2].lower(), tag[1], tag[3]
        if name not in INLINE and name not in RAW:
            if not out:
                close_block()
            while not closing and stack and stack[-1][0] in LOOSE:
                pop()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    while len(stack) > k:
                        pop()
                    break
        elif name in RAW:
            end = re.compile(f"</{name}\\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else size
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            names, hidden = attribute_names(attributes) if attributes else (set(), False)
            inside = depth["article"] or depth["main"]
            left_out = (name in OUT_TAGS or not OUT_NAMES.isdisjoint(names)
                        or not inside and (name in OUT_OUTSIDE or not OUT_OUTSIDE.isdisjoint(names))
                        or hidden)
            if name in ("body", "html", "main") or name == "article" and not (
                    names & {"comment", "ad", "ads", "related"}):
                left_out = False
            if left_out or name not in LOOSE:
                stack.append((name, left_out))
                out += left_out
                if name in depth:
                    depth[name] += 1
    if at < size and not out:
        parts.append(html[at:])
    close_block()
    best = max((kind for kind, _ in blocks), default=BODY)
    return best, [text for kind, text in blocks if kind == best]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte, so that bytes that are mostly 0 take no room."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zlib.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)


def pack_blocks(blocks: list[str]) -> bytes:
    """A page's blocks, of which none is empty or holds a line feed."""
    return zlib.compress("\n".join(blocks).encode(), 1)


def blocks_of(group: pa.Table) -> pa.Array:
    texts = [zlib.decompress(d).decode() for d in group.column("blocks").to_pylist()]
    return pa.array([t.split("\n") if t else [] for t in texts], pa.list_(pa.string()))


def pack_mask(mask: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(mask).tobytes(), 1)


def unpack_mask(data: bytes) -> np.ndarray:
    """With up to 7 places more than were packed."""
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8)).astype(bool)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted whole numbers as gaps in Golomb's code: the low bits of a gap, then the rest as so
    many zeros before a one. It takes about 1.6 bits more than the logarithm of the mean gap."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    low = max(0, (int(values[-1]) // n).bit_length() - 1)
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - low:]
    ones = np.cumsum((gaps >> np.uint64(low)).astype(np.int64) + 1) - 1
    rest = np.zeros(ones[-1] + 1, np.uint8)
    rest[ones] = 1
    return bytes([low]) + n.to_bytes(4, "little") + np.packbits(
        np.concatenate([bits.ravel(), rest])).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    low, n = data[0], int.from_bytes(data[1:5], "little")
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=5))
    wide = np.zeros((n, 64), np.uint8)
    wide[:, 64 - low:] = bits[:n * low].reshape(n, low)
    ones = np.flatnonzero(bits[n * low:])[:n]
    gaps = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
    gaps += np.diff(ones, prepend=-1).astype(np.uint64) - np.uint64(1) << np.uint64(low)
    return np.cumsum(gaps, dtype=np.uint64)


def host_parts(chunks: int) -> int:
    return -(-chunks // PART_CHUNKS)


def short_prints(hashes: np.ndarray, chunks: int) -> np.ndarray:
    bits = PRINT_BITS + (min(chunks, PART_CHUNKS) - 1).bit_length()
    return hashes >> np.uint64(64 - bits)


class Streams:
    """The token streams of a chunk's pages, a boundary token (0) after each block: ``tokens`` of
    page p stand at ``begins[p]`` and are ``sizes[p]``; ``first`` are pages of distinct contents
    and ``same`` says for every page which of these it equals."""

    def __init__(self, pages: pa.Array):
        texts = pages.flatten()
        words = pc.split_pattern(texts, " ")
        in_block = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        self.words = coded.dictionary
        ends = np.cumsum(in_block + 1)
        self.tokens = np.zeros(ends[-1] if len(ends) else 0, np.int64)
        inside = np.ones(len(self.tokens), bool)
        inside[ends - 1] = False
        self.tokens[inside] = coded.indices.to_numpy(zero_copy_only=False) + 1
        blocks = pc.list_value_length(pages).to_numpy(zero_copy_only=False).astype(np.int64)
        stops = np.concatenate([[0], ends])[np.cumsum(blocks)]
        self.sizes = np.diff(stops, prepend=0)
        self.begins = stops - self.sizes
        found: dict[bytes, int] = {}
        raw = self.tokens.astype(np.int32).tobytes()
        self.same = np.array([found.setdefault(raw[4 * b:4 * e], len(found))
                              for b, e in zip(self.begins.tolist(), stops.tolist())], np.int64)
        self.first = np.unique(self.same, return_index=True)[1]

    def runs(self) -> None:
        """Makes ``hashes``, of the substrings of RUN tokens; ``places``, where those of the distinct
        contents begin; ``owner``, whose these are; and ``contents``, a hash of each content."""
        by_word = np.fromiter(map(xxhash.xxh3_64_intdigest, ["\n", *self.words.to_pylist()]),
                              np.uint64, len(self.words) + 1)
        each = by_word[self.tokens]
        total = np.zeros(max(0, len(each) - RUN + 1), np.uint64)
        for k in range(RUN):
            total += each[k:k + len(total)] * PLACES[k]
        self.hashes = mix64(total)
        n = np.maximum(0, self.sizes[self.first] - RUN + 1)
        self.owner = np.repeat(np.arange(len(self.first)), n)
        self.places = np.arange(n.sum()) + np.repeat(self.begins[self.first] - np.cumsum(n) + n, n)
        self.contents = np.array([xxhash.xxh3_64_intdigest(
            each[self.begins[p]:self.begins[p] + self.sizes[p]].tobytes())
            for p in self.first], np.uint64)


class ChunkRuns:
    """What a chunk of a host of several asks the others about its substrings of RUN tokens."""

    def __init__(self, pages: pa.Array, chunks: int):
        self.chunks, self.parts, self.streams = chunks, host_parts(chunks), Streams(pages)
        self.streams.runs()
        self.contents = np.sort(self.streams.contents)
        self.at_places = self.streams.hashes[self.streams.places]

    def part(self, values: np.ndarray, p: int) -> np.ndarray:
        return values if self.parts == 1 else values[values % np.uint64(self.parts) == p]

    def prints(self, p: int) -> np.ndarray:
        return np.unique(short_prints(self.part(self.at_places, p), self.chunks))

    def asked(self, p: int) -> tuple[bytes, bytes]:
        """The short prints of a part's substrings, and its contents."""
        return pack_sorted(self.prints(p)), pack_sorted(self.part(self.contents, p))

    def owned(self, masks: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
        """For every part, the hashes whose prints other chunks have too, and in how many contents
        that this chunk counts they are."""
        mine = [self.part(self.contents, p) for p in masks]
        mine = np.concatenate([c[own[:len(c)]] for c, (_, own) in zip(mine, masks.values())])
        counts = np.isin(self.streams.contents, mine)[self.streams.owner]
        for p, (shared, _) in masks.items():
            prints = self.prints(p)
            known = prints[shared[:len(prints)]]
            sent = lookup(short_prints(self.at_places, self.chunks), known,
                          np.ones(len(known)), 0) == 1
            if self.parts > 1:
                sent &= self.at_places % np.uint64(self.parts) == p
            hashes, owner, counted = self.at_places[sent], self.streams.owner[sent], counts[sent]
            order = np.lexsort((owner, hashes))
            hashes, owner, counted = hashes[order], owner[order], counted[order]
            new = np.ones(len(order), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            counted[1:] &= new[1:] | (owner[1:] != owner[:-1])
            number = np.cumsum(new) - 1
            yield p, hashes[new], np.bincount(number[counted], minlength=new.sum())


def lookup(keys: np.ndarray, known: np.ndarray, values: np.ndarray, other: int) -> np.ndarray:
    """``values`` at the places of ``keys`` among the sorted ``known``; ``other`` where missing."""
    if not len(known):
        return np.full(len(keys), other, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at].astype(np.int64), other)


def chunks_that_share(prints: list[np.ndarray],
                      contents: list[np.ndarray]) -> tuple[list, list, int]:
    """For every chunk, which of its prints another chunk has too, and which of its contents no
    chunk before it has; and the distinct contents."""
    values = np.sort(np.concatenate(prints), kind="stable")
    twice = np.unique(values[1:][values[1:] == values[:-1]])
    every = np.concatenate(contents)
    distinct, first = np.unique(every, return_index=True)  # the first place of equal ones
    is_first = np.zeros(len(every), bool)
    is_first[first] = True
    ends = np.cumsum([len(c) for c in contents])[:-1]
    return [lookup(x, twice, twice, -1) >= 0 for x in prints], np.split(is_first, ends), len(distinct)


def repeated_tokens(pages: list[list[str]] | pa.Array,
                    elsewhere: tuple[np.ndarray, np.ndarray] | None = None,
                    ) -> tuple[list[np.ndarray], int]:
    """For every page's tokens (a boundary token after each block), in how many distinct pages the
    most shared substring of RUN tokens that covers the token occurs; and the distinct pages.
    ``elsewhere``: sorted hashes of substrings that other chunks share, and the host's counts."""
    streams = Streams(pages if isinstance(pages, pa.Array) else pa.array(
        pages, pa.list_(pa.string())))
    first, sizes = streams.first, streams.sizes
    # one stream a distinct content; pages end in tokens that nothing else has
    begins = np.cumsum(sizes[first] + 1) - sizes[first] - 1
    words = len(streams.words)
    parts = []
    for c, p in enumerate(first):
        parts += [streams.tokens[streams.begins[p]:streams.begins[p] + sizes[p]],
                  np.array([words + 1 + c])]
    rank = np.concatenate(parts) if parts else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(first)), sizes[first] + 1)
    length = 1
    while length < RUN:  # ranks of substrings twice as long, from pairs of ranks
        ahead = np.zeros_like(rank)
        ahead[:-length] = rank[length:] + 1
        _, rank = np.unique(rank * (len(rank) + words + len(first) + 3) + ahead,
                            return_inverse=True)
        length *= 2
    order = np.lexsort((owner, rank))  # the suffix array to this depth
    ranks, owners = rank[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranks[1:] != ranks[:-1]) | (owners[1:] != owners[:-1])
    in_pages = np.bincount(ranks[new], minlength=1)
    shared = in_pages[rank] if len(rank) else rank
    if elsewhere is not None and len(elsewhere[0]):
        streams.runs()
        places = streams.places + (begins - streams.begins[first])[streams.owner]
        shared[places] = np.maximum(shared[places], lookup(
            streams.hashes[streams.places], *elsewhere, 0))
    cover = shared.copy()
    for k in range(1, RUN):
        cover[k:] = np.maximum(cover[k:], shared[:-k])
    by_content = [cover[b:b + sizes[p]] for b, p in zip(begins, first)]
    return [by_content[c] for c in streams.same], len(first)


def unique_runs(kinds: list[int], pages: list[list[str]] | pa.Array,
                elsewhere: tuple[np.ndarray, np.ndarray] | None = None,
                host_contents: int | None = None) -> list[str]:
    """The texts of a chunk's pages without what is repeated across them and, with ``elsewhere``
    and the host's distinct pages, across the other chunks of the host."""
    covers, distinct = repeated_tokens(pages, elsewhere)
    distinct = host_contents or distinct
    article_limit = max(ARTICLE_PAGES, ARTICLE_SHARE * distinct)
    out = []
    if isinstance(pages, pa.Array):
        pages = pages.to_pylist()
    for kind, blocks, cover in zip(kinds, pages, covers):
        limit = 2 if kind == BODY else article_limit
        if 2 * (cover >= limit).sum() > len(cover):
            limit = article_limit  # another version of a page, not a page with boilerplate
        if not len(cover) or cover.max() < limit:
            out.append("\n".join(blocks))
            continue
        kept, at = [], 0
        for text in blocks:
            words = text.split(" ")
            own = cover[at:at + len(words)]
            at += len(words) + 1
            left = [w for w, c in zip(words, own) if c < limit]
            if left:
                kept.append(" ".join(left))
        out.append("\n".join(kept))
    return out


def main_texts(pages: DataFrame, chunk_pages: int = CHUNK_PAGES) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract(
        F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(www\.)?", "//"),
        r"^//([^/?#:]*)", 1)), F.lit(""))
    named = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html",
                         host.alias("host"))
    # as many rows as hosts; a large host's pages are dealt out so that no group grows with it
    # (a table of known size, so that a small one is sent to the pages and they stay in place)
    chunks = stage(named.groupBy("host").agg(
        F.ceil(F.count("*") / chunk_pages).cast("int").alias("chunks")), "host-chunks")
    dealt = named.join(chunks, "host").withColumn(
        "chunk", F.pmod(F.xxhash64("page_id", "url"), F.col("chunks")).cast("int"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
                        ("chunk", pa.int32()), ("chunks", pa.int32()), ("kind", pa.int32()),
                        ("blocks", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            found = [page_blocks(h or "") for h in batch.column("html").to_pylist()]
            yield record(schema, [
                *(batch.column(c) for c in ("page_id", "url", "host", "chunk", "chunks")),
                [k for k, _ in found], [pack_blocks(b) for _, b in found]])

    blocks = (dealt.select("page_id", "url", "host", "chunk", "chunks", "html").mapInArrow(
        read, "page_id long, url string, host string, chunk int, chunks int, kind int, "
              "blocks binary"))

    def cleaned(group, elsewhere, distinct):
        texts = unique_runs(group.column("kind").to_pylist(),
                            blocks_of(group), elsewhere, distinct)
        return pa.table({"page_id": group.column("page_id"), "url": group.column("url"),
                         "text": pa.array(texts, pa.string())})

    def clean(group):
        return cleaned(group, None, None)

    def clean_by_host(group, sums):
        elsewhere, distinct = None, None
        if sums.num_rows:
            hashes, counts = (np.concatenate([take(d) for d in sums.column(c).to_pylist()])
                              for c, take in (("hashes", unpack_sorted), ("counts", unpack)))
            order = np.argsort(hashes)
            elsewhere, distinct = (hashes[order], counts[order]), sums.column("distinct")[0].as_py()
        return cleaned(group, elsewhere, distinct)

    result, by_chunk = "page_id long, url string, text string", blocks.groupBy("host", "chunk")
    if chunks.filter("chunks > 1").isEmpty():
        return by_chunk.applyInArrow(clean, result)
    # the shuffled blocks are read three times: to ask, to count and to clean
    return by_chunk.cogroup(host_sums(blocks).groupBy("host", "chunk")).applyInArrow(
        clean_by_host, result)


def host_sums(blocks: DataFrame) -> DataFrame:
    """For every chunk of a host of several, in rows (host, chunk): the hashes of its substrings of
    RUN tokens that stand in two of the host's distinct pages or more and may stand in another
    chunk, how many pages these are, and the host's distinct pages."""
    def table(spec: str, rows: list[tuple]) -> pa.Table:
        fields = [f.split() for f in spec.split(", ")]
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        columns = list(zip(*rows)) or [()] * len(fields)
        return pa.table({n: pa.array(c, kinds[t]) for (n, t), c in zip(fields, columns)})

    asked = "host string, part int, chunk int, prints binary, contents binary"
    told = "host string, chunk int, part int, shared binary, own binary, distinct long"
    counted = "host string, part int, chunk int, hashes binary, counts binary, distinct long"
    summed = "host string, chunk int, hashes binary, counts binary, distinct long"

    def of_chunk(group) -> ChunkRuns | None:
        chunks = group.column("chunks")[0].as_py() if group.num_rows else 1
        return ChunkRuns(blocks_of(group), chunks) if chunks > 1 else None

    def ask(key, group):
        host, chunk = (k.as_py() for k in key)
        runs = of_chunk(group)
        return table(asked, [(host, p, chunk, *runs.asked(p)) for p in range(runs.parts)]
                     if runs else [])

    def tell(key, group):
        host, part = (k.as_py() for k in key)
        group = group.sort_by("chunk")
        names = group.column("chunk").to_pylist()
        shared, own, distinct = chunks_that_share(*(
            [unpack_sorted(d) for d in group.column(c).to_pylist()] for c in ("prints", "contents")))
        return table(told, [(host, c, part, pack_mask(s), pack_mask(o), distinct)
                            for c, s, o in zip(names, shared, own)])

    def count(key, group, answers):
        host, chunk = (k.as_py() for k in key)
        runs = of_chunk(group)
        if runs is None:
            return table(counted, [])
        distinct = sum(answers.column("distinct").to_pylist())
        masks = {p: (unpack_mask(s), unpack_mask(o)) for p, s, o in zip(*(
            answers.column(c).to_pylist() for c in ("part", "shared", "own")))}
        return table(counted, [(host, p, chunk, pack_sorted(sent), pack(n), distinct)
                               for p, sent, n in runs.owned(masks)])

    def add(key, group):
        host = key[0].as_py()
        sent = [unpack_sorted(d) for d in group.column("hashes").to_pylist()]
        values, at = np.unique(np.concatenate(sent), return_inverse=True)
        total = np.bincount(at, np.concatenate([unpack(d) for d in group.column(
            "counts").to_pylist()]), len(values)).astype(np.int64)
        values, total = values[total > 1], total[total > 1]
        rows = []
        for chunk, distinct, mine in zip(*(group.column(c).to_pylist()
                                           for c in ("chunk", "distinct")), sent):
            n = lookup(mine, values, total, 0)
            rows.append((host, chunk, pack_sorted(mine[n > 1]), pack(n[n > 1]), distinct))
        return table(summed, rows)

    by_chunk = blocks.groupBy("host", "chunk")
    told_rows = by_chunk.applyInArrow(ask, asked).groupBy("host", "part").applyInArrow(tell, told)
    return (by_chunk.cogroup(told_rows.groupBy("host", "chunk")).applyInArrow(count, counted)
            .groupBy("host", "part").applyInArrow(add, summed))
