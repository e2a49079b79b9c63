"""Mixing, alignment and periodic runs against brute force and the libraries."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartwheel.llm import alignment, mixing, periodic_runs as runs

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, source string, key string"


# ---------------------------------------------------------------- mixing

def water_targets(sizes, weights, share, most):
    """Targets by the rule itself: shares by weight, cut at the cap, the excess shared again."""
    total, out, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            return out
        for i in over:
            out[i] = most * sizes[i]
            open_.discard(i)
        if not open_:
            return out


@pytest.mark.parametrize("sizes", [[10, 1000, 30, 500], [1, 1, 1], [5], [0, 7, 9], [100, 1, 1, 90, 3]])
def test_targets_are_a_water_level(spark, sizes):
    table = spark.createDataFrame([(f"0{i}", n) for i, n in enumerate(sizes)],
                                  "source_key string, source_size long")
    got = [r.target for r in mixing.targets(table, [3, 1, 2], 1.5, 2).orderBy("source_key").collect()]
    want = water_targets(sizes, [[3, 1, 2][i % 3] for i in range(len(sizes))], 1.5, 2)
    assert got == pytest.approx(want)


def mixed_by_hand(rows, seed=42):
    """(doc_id, size, copies) by one pass over each source in the stated order, in whole numbers."""
    def h(value):
        return int(hashlib.md5(f"{seed}|{value}".encode()).hexdigest()[:8], 16)

    def size_class(n):
        return n if n < 32 else 32 * n.bit_length() + (n >> (n.bit_length() - 5))

    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        key = "1" if source is None else "0" + source
        by_source[key].append((doc_id, len((text or "").encode().split())))
    keys = sorted(by_source)
    sizes = [sum(n for _, n in by_source[k]) for k in keys]
    aims = water_targets(sizes, [[3, 1, 2][i % 3] for i in range(len(keys))], 1.5, 2)
    out = []
    for key, size, aim in zip(keys, sizes, aims):
        step = min(2 << 32, math.floor(aim / size * 2 ** 32 + 0.5)) if size else 0
        at = h("offset|" + key)
        for doc_id, n in sorted(by_source[key], key=lambda r: (
                size_class(r[1]), h("" if r[0] is None else r[0]), r[1], r[0] or 0)):
            out.append((doc_id, n, (at + step >> 32) - (at >> 32)))
            at += step
    return sorted(out, key=str)


def mix_rows():
    rows = [(i, "w " * (i * 37 % 90), "abc"[min(i % 7, 2)]) for i in range(700)]
    rows += [(None, "x y z", None), (None, None, None), (5000, "", "a"), (5001, "long " * 5000, "c")]
    return rows + [(6000, "same text here", "b")] * 300


@pytest.mark.parametrize("bucket", [1 << 16, 7])
def test_mix_equals_one_pass(spark, bucket):
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, "k") for r in rows], DOCS)
    got = mixing.mix(docs, bucket=bucket)
    want = mixed_by_hand(rows)
    assert sorted(((r.doc_id, r.size, r.copies) for r in got.collect()), key=str) == want
    again = mixing.mix(docs.repartition(13), bucket=bucket)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    by_source = got.groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                              F.max("target").alias("target"), F.max("copies").alias("m"),
                                              F.max("size").alias("largest")).collect()
    for r in by_source:
        assert abs(r.taken - r.target) <= 2 * r.largest + 0.05 * r.target and r.m <= 2


def test_blocks_of_equal_rows(spark, monkeypatch):
    """Equal rows are counted in blocks; small blocks give the same draw, shuffled again or not."""
    docs = spark.createDataFrame([(*r, "k") for r in mix_rows()], DOCS)
    want = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BLOCK", 4)
    assert sorted(map(str, mixing.mix(docs).collect())) == want


def test_mix_emits_whole_rows(spark):
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, "k") for r in rows], DOCS)
    drawn = mixing.mix(docs)
    want = Counter()
    for r in drawn.collect():
        want[r.doc_id, r.size] += r.copies
    got = Counter((r.doc_id, len((r.text or "").encode().split()))
                  for r in mixing.emit(docs, drawn).collect())
    assert got == +want
    assert mixing.emit(docs, drawn).columns == docs.columns


def test_mix_of_odd_tables(spark, docs, no_docs):
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, "a", "k"), (2, "", None, "k")], DOCS)
    assert [r.copies for r in mixing.mix(empty).collect()] == [0, 0]


def test_mix_stays_native(spark, docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ---------------------------------------------------------------- alignment

TEXT = st.text(alphabet=st.sampled_from(list("abethin rosd ABC'st\n\t\x1cİſ²12_!<s>|　中Ж\U0001f600")),
               max_size=60)


def aligned_by_hand(texts, tokens):
    """Groups from shared byte ends, all links listed, counts from sets of linked pairs."""
    out, held = [], []
    for text, (a, b) in zip(texts, tokens):
        groups, links = [], []
        if text and b"".join(t for _, t in a) == b"".join(t for _, t in b) == b" " + text.encode():
            end_a = np.cumsum([len(t) for _, t in a]).tolist()
            end_b = np.cumsum([len(t) for _, t in b]).tolist()
            i = j = 0
            for end in sorted(set(end_a) & set(end_b)):
                i_next, j_next = end_a.index(end, i) + 1, end_b.index(end, j) + 1
                groups.append(([x for x, _ in a[i:i_next]], [y for y, _ in b[j:j_next]]))
                i, j = i_next, j_next
            links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        out.append((groups, links))
        held.append(set(links))
    count = Counter(p for s in held for p in s)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    rows = []
    for groups, links in out:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
                     len(links), hashlib.sha256(shown.encode()).hexdigest() if shown else "",
                     sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links)))
    return rows


def library_tokens(texts):
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(alignment.byte_letters())}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    assert decoders.ByteLevel().decode([chr(288)]) == " "
    for text in texts:
        ids = b.encode(text or "")
        yield ([(i, bytes(letters[c] for c in a.id_to_token(i)))
                for i in a.encode(" " + (text or ""), add_special_tokens=False).ids],
               [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                 else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids])


def figures(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum)


@pytest.mark.parametrize("hot", [200_000, 5])
def test_alignment_of_documents(spark, docs, no_docs, hot):
    more = spark.createDataFrame([(20, "a ▁ mark", "a", "k"), (21, "<s> <|endoftext|> </s>", "a", "k"),
                                  (22, "  two  spaces\n\n", None, "k"), (23, "中文字 ￿ ü🙂", "b", "k")], DOCS)
    rows = docs.select("doc_id", "text").union(more.select("doc_id", "text"))
    texts = [r.text for r in rows.collect()]
    want = aligned_by_hand(texts, library_tokens(texts))
    got = alignment.aligned_documents(rows, A, B, hot)
    assert sorted(map(figures, got.collect())) == sorted(want)
    assert [r.doc_id for r in got.collect()].count(None) == 2
    assert alignment.aligned_documents(no_docs, A, B).count() == 0


@given(TEXT)
@settings(max_examples=40, deadline=None)
def test_groups_of_a_text(text):
    a, b, printer = alignment.sides(A, B)
    (ids_a,), (ids_b,) = a.encode([text]), b.encode([text])
    tokens = next(library_tokens([text]))
    assert [i for i, _ in tokens[0]] == ids_a and [t for _, t in tokens[0]] == [a.bytes[i] for i in ids_a]
    assert [i for i, _ in tokens[1]] == ids_b and [t for _, t in tokens[1]] == [b.bytes[i] for i in ids_b]
    assert alignment.ByteBpe(A).ranks is not None  # the faster engine is the one compared
    if not text:
        return
    x, y = np.array(ids_a), np.array(ids_b)
    ends = alignment.common_ends(a.lengths[x], b.lengths[y])
    shown = printer.groups(x, y, *ends)
    want = aligned_by_hand([text], [tokens])[0]
    assert hashlib.sha256(shown.encode()).hexdigest() == want[4]


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6),
                          st.lists(st.integers(0, 3), min_size=1, max_size=6)), max_size=6),
       st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_links_in_parts(groups, expanded):
    a = np.array([i for x, _ in groups for i in x], np.int64)
    b = np.array([i for _, y in groups for i in y], np.int64)
    ends = [np.cumsum([len(g[k]) for g in groups]).astype(np.int64) for k in (0, 1)]
    want = Counter((i, j) for x, y in groups for i in x for j in y)
    got = Counter()
    for pairs, times in alignment.links(a, b, *ends, expanded):
        for p, n in zip(pairs.tolist(), times.tolist()):
            assert (p >> 20, p & 0xFFFFF) not in got  # a pair is in one part
            got[p >> 20, p & 0xFFFFF] = n
    assert got == want


# ---------------------------------------------------------------- periodic runs

def longest_lyndon(s):
    return [max(j - i for j in range(i + 1, len(s) + 1)
                if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def all_runs(s, least, periods):
    found = {}
    for p in range(1, len(s) // periods + 1):
        i = 0
        while i + p < len(s):
            begin = i
            while i + p < len(s) and s[i] == s[i + p]:
                i += 1
            if i > begin and i - begin + p >= max(least, periods * p):
                found.setdefault((begin, i - begin + p), p)
            i += i == begin
    return sorted((b, n, p) for (b, n), p in found.items())


@given(st.lists(st.integers(0, 2), max_size=16))
@settings(max_examples=400, deadline=None)
def test_grouping_gives_lyndon_arrays(s):
    assert runs.lyndon_array(s) == longest_lyndon(s)


@given(st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k - 1), max_size=60)))
@settings(max_examples=400, deadline=None)
def test_all_runs_of_a_sequence(s):
    assert sorted(runs.runs_of(s, 2, 2)) == all_runs(s, 2, 2)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=25), st.integers(1, 90)),
                max_size=5))
@settings(max_examples=300, deadline=None)
def test_runs_of_a_text(parts):
    s = [b"%d" % w[i % len(w)] for w, n in parts for i in range(n)]
    assert runs.text_runs(s) == all_runs(s, 24, 3)


def test_runs_of_documents(spark, docs, no_docs):
    from cartwheel.llm.queries import op13_periodic_runs  # noqa: F401 - importable
    phrase = "one two three four five six seven "
    more = [(30, "x " + phrase * 6 + "one two y", "a", "k"), (31, phrase * 3, "a", "k"),
            (32, (phrase * 5 + "eight ") * 4, "a", "k"), (33, "a " * 24 + "b " * 23, "a", "k")]
    rows = docs.select("doc_id", "text").union(
        spark.createDataFrame(more, DOCS).select("doc_id", "text"))
    for change in (None, lambda i, w: runs.periodic_tail(i, w) if len(w) < 3000 else w):
        want = []
        for r in rows.collect():
            words = (r.text or "").encode().split()
            words = change(r.doc_id, words) if change and len(words) < 3000 else words
            # the long text's one word has a single run
            found = all_runs(words, 24, 3) if len(words) < 3000 else [(2, 30_000, 1)]
            gone = {i for s, n, p in found for i in range(s + p, s + n)}
            want.append((r.doc_id, len(words), found, " ".join(
                w.decode() for i, w in enumerate(words) if i not in gone)))
        got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
               for r in runs.document_runs(rows, change=change).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert runs.document_runs(no_docs).count() == 0


def test_periodic_tail_and_best_run(spark):
    doc_id = next(i for i in range(100) if zlib.crc32(b"%d" % i) % 10 == 0)
    words = [b"%d" % i for i in range(100)]
    g = zlib.crc32(b"%d" % doc_id) // 10
    a, p = g % 100, 1 + (100 - g % 100) // (3 + g % 8)
    assert runs.periodic_tail(doc_id, words) == [words[i if i < a else a + (i - a) % p]
                                                 for i in range(100)]
    assert runs.periodic_tail(None, words) == words and runs.periodic_tail(doc_id, []) == []
    rows = spark.createDataFrame([([(0, 30, 7), (40, 60, 14), (99, 45, 10), (20, 90, 20)],), ([],)],
                                 "runs array<struct<start: long, length: long, period: long>>")
    best = rows.select(runs.greatest_exponent("runs").alias("b")).collect()
    assert tuple(best[0].b) == (20, 90, 20) and best[1].b is None
