"""Token counts, scores, pieces, quality rules and shards against brute force."""

import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from cartwheel.llm import lm_mixing, pieces_fst, quality, sharding, token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(alphabet=st.sampled_from(list(
    "abethin rosd ABC'st\n\t\x1c\x85\xa0éÉßİŸſ²½12_!?<|>　中Ж٠Σ▁\U0001f600")), max_size=40)


@given(TEXT, st.booleans())
@settings(max_examples=300, deadline=None)
def test_pre_token_pieces_equal_library(text, special):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD_BPE)
    cutter = token_counts.PreTokens(WORD_BPE)
    text = text[:9] + "<|endoftext|>" * special + text[9:]
    want = len(library.encode(text, add_special_tokens=False).ids)
    assert sum(n * cutter.pieces(t) for t, n in cutter.bag(text.encode()).items()) == want


def test_token_counts(docs, no_docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    for hot in (400_000, 3):  # with few hot tokens nearly all go through the join
        got = [tuple(r) for r in token_counts.token_counts(docs, WORD_BPE, hot=hot).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.token_counts(no_docs, WORD_BPE).count() == 0


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_pieces_equal_library(text):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    fst = pieces_fst.machine(PIECES)
    ids = fst.encode(text).tolist()
    assert ids == library.encode(text)
    assert fst.decode(ids) == library.decode(ids)


def test_shortest_path_of_weights():
    """The unigram search against all segmentations of a short string."""
    fst = pieces_fst.machine(PIECES)
    text = "▁theater"

    def ways(rest):
        if not rest:
            yield []
        for k in range(1, len(rest) + 1):
            if rest[:k] in fst.ids:
                yield from ([rest[:k], *w] for w in ways(rest[k:]))

    best = max(sum(fst.scores[p] for p in w) for w in ways(text))
    assert sum(fst.scores[p] for p in fst.lightest_path(text)) == best


def test_pieces_of_documents(docs, no_docs):
    got = pieces_fst.round_trip(docs, PIECES).collect()
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert len(got) == docs.count() and {(r.doc_id, r.text) for r in got} == texts
    again = pieces_fst.decode_documents(pieces_fst.encode_documents(docs, PIECES), PIECES)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    assert pieces_fst.round_trip(no_docs, PIECES).count() == 0


def test_scores(docs, no_docs):
    rows = docs.collect()
    held = [zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 10 == 0 for r in rows]
    bags = [(r.text or "").encode().lower().split() + [b"\n"] for r in rows]
    c = Counter(w for b, h in zip(bags, held) if not h for w in b)
    n, v = sum(c.values()), len(c)
    want = sorted(((r.doc_id, h, len(b), sum(w in c for w in b), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in b))
                   for r, h, b in zip(rows, held, bags)), key=str)
    for hot in (1000, 2):
        got = lm_mixing.score_documents(docs, hot=hot).collect()
        values = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                          r.base_score) for r in got), key=str)
        for a, b in zip(values, want, strict=True):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
        assert all(r.score < 0 and r.bits_per_byte >= 0 for r in got)
    assert lm_mixing.score_documents(no_docs).count() == 0


def test_token_probabilities_sum_below_one():
    """All one-byte tokens, in words or as ends, share at most probability 1."""
    import numpy as np
    table = np.zeros(2 * lm_mixing.SLOTS, np.float32)
    rng = np.random.default_rng(1)
    table += rng.integers(0, 9, len(table)).astype(np.float32)
    weights = np.full((lm_mixing.GATES, len(lm_mixing.PREDICTORS)), 0.3)
    refine = np.zeros(256 * lm_mixing.BUCKETS)
    mark = b"\0\0\0\1"
    tokens = [mark + bytes([b]) for b in range(256) if b not in b"\n "] + [mark + lm_mixing.END]
    total = (10 ** lm_mixing.token_log10(tokens, table, weights, refine)).sum()
    assert 0 < total <= 1


def test_scores_beat_the_base_on_held_out_rows(spark):
    """Accuracy on rows that were not learned from."""
    import random
    random.seed(4)
    tongues = {"en": (["the", "of", "and", "is", "to"], ["th", "er", "in", "on", "ble", "re", "ti"]),
               "xx": (["der", "und", "im", "zu", "wo"], ["sch", "ung", "keit", "ei", "pf", "ver"])}
    rows = []
    for i in range(1500):
        lang = "en" if i % 2 else "xx"
        common, parts = tongues[lang]
        words = [random.choice(common) if random.random() < 0.5 else
                 "".join(random.choices(parts, k=random.randint(2, 4))) for _ in range(60)]
        rows.append((i, " ".join(words), lang))
    got = lm_mixing.score_documents(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    held = [r for r in got.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_do_not_depend_on_the_layout(spark):
    """The same rows in other partitions and another order; shards of any size keep the sums right."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ways = [docs.coalesce(1), docs.repartition(7), docs.repartition(200).orderBy("text")]
    got = [{r.doc_id: r.score for r in lm_mixing.score_documents(d).collect()} for d in ways]
    assert len(got[0]) == docs.count()
    for other in got[1:]:
        assert other.keys() == got[0].keys()
        assert max(abs(other[k] - got[0][k]) for k in other) < 1e-6


def test_shards_hold_whole_subtrees(spark, monkeypatch):
    """Tokens that begin alike to their depth stand in one shard, no more than the limit of them."""
    import random
    random.seed(5)
    monkeypatch.setattr(lm_mixing, "LIMIT", 20)
    monkeypatch.setattr(lm_mixing, "HOT_SHARE", 1000)
    monkeypatch.setattr(lm_mixing, "SHARD", 50)
    words = {"".join(random.choices("ab", k=random.randint(1, 9))) for _ in range(900)}
    words |= {"q" * 70 + str(i) for i in range(100)} | {"é" * 5, ""}
    rows = [(b"\0\0\0\1" + (w.encode() or lm_mixing.END), 1, 1) for w in sorted(words)]
    got = lm_mixing.sharded(spark.createDataFrame(rows, "token binary, n long, c long")).collect()
    assert len(got) == len(rows)
    where, size = {}, Counter()
    for r in got:
        lead = bytes(r.token)[:4 + r.depth]
        if len(r.token) > 68:  # alike beyond the last level: dealt by hash
            assert r.depth == lm_mixing.LEVELS[-1]
            continue
        assert where.setdefault(lead, r.shard) == r.shard
        size[lead] += 1
    assert max(size.values()) <= 20 and len({r.depth for r in got}) > 2


def test_counts_of_a_shard_and_of_the_shared_tables(spark, monkeypatch):
    """Every context is counted once, in the shard or in the shared tables: against a plain count."""
    import numpy as np
    from collections import defaultdict
    monkeypatch.setattr(lm_mixing.Shard, "ROOM", 14)  # no two contexts meet in a slot
    mark = b"\0\0\0\1"
    words = ["ab", "abc", "abd", "b", "abcde", "x" * 30, ""]
    seen = [3, 1, 2, 5, 0, 4, 7]
    tokens = [mark + (w.encode() or lm_mixing.END) for w in words]
    frame = spark.createDataFrame([(t, c, 2) for t, c in zip(tokens, seen)],
                                  "token binary, c long, depth int")
    table = lm_mixing.bit_counts(frame)
    shard = lm_mixing.Shard(tokens, np.array(seen, np.float32), np.full(len(tokens), 2))
    brute = defaultdict(lambda: [0, 0])
    for w, c in zip(words, seen):
        data = w.encode() + b" "
        for i, byte in enumerate(data):
            for k in range(8):
                brute[data[:i], k, byte >> (8 - k)][byte >> (7 - k) & 1] += c
    for a, b, bits in shard.parts():
        for k, (_, _, pairs) in enumerate(lm_mixing.counted(bits, table, shard)):
            for at, (owner, place) in enumerate(zip(bits.owner, bits.place)):
                data = words[a + owner].encode() + b" "
                want = brute[data[:place], k, data[place] >> (8 - k)]
                assert [pairs[-1][0][at], pairs[-1][1][at]] == want


def brute_measures(text):
    words = text.encode().split()
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
                for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup,
            len(repeated))


@given(st.text(alphabet=st.sampled_from(list("ab \n\t#é\xa0\x1c")), max_size=60))
@settings(max_examples=200, deadline=None)
def test_measures(text):
    got = quality.measure(text.encode())
    assert (*got[:4], got[5]) == brute_measures(text)


def test_quality_verdicts(docs, no_docs):
    got = quality.quality_verdicts(docs).collect()
    want = sorted(((r.doc_id, *brute_measures(r.text or "")) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words) for r in got), key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality.quality_verdicts(no_docs).count() == 0 == quality.keep_good(no_docs).count()


def test_fences_follow_the_group(spark):
    """A value that is usual in one source is refused in another."""
    import random
    random.seed(2)

    def text(symbols):
        words = ["".join(random.choices("abcdefgh", k=5)) for _ in range(100)]
        return " ".join(words[:100 - symbols] + ["#"] * symbols)

    rows = [(i, text(random.randint(8, 24)), "en", "math") for i in range(300)]
    rows += [(1000 + i, text(0), "en", "news") for i in range(300)]
    rows += [(2000, text(20), "en", "news"), (2001, text(20), "en", "rare")]
    got = {r.doc_id: r.kept for r in quality.quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
        .collect()}
    assert all(got[i] for i in range(300)) and all(got[1000 + i] for i in range(300))
    assert not got[2000]


def test_verdicts_against_recomputed_fences(spark):
    """Groups so small that sketches are exact: fences of the own group, the language and all."""
    import random
    random.seed(9)

    def text():
        usual = random.random() < 0.8
        words = ["".join(random.choices("abcdefgh", k=random.randint(4, 5 if usual else 30)))
                 for _ in range(random.randint(40, 120))]
        words += ["#"] * random.choice([0, 1, 2, 2, 3] if usual else [5, 40, 90])
        random.shuffle(words)
        lines = [" ".join(words[i:i + 6]) for i in range(0, len(words), 6)]
        return "\n".join(lines + lines[:random.choice([0, 0, 1] if usual else [0, 4, 12])])

    groups = [("en", "a")] * 120 + [("en", "b")] * 25 + [("fr", "a")] * 12 + [(None, None)] * 9
    rows = [(i, text(), *g) for i, g in enumerate(groups)]
    values = {}
    for i, t, lang, source in rows:
        n, chars, symbols, dup, repeat = brute_measures(t)
        lines = sum(bool(x.split()) for x in t.encode().split(b"\n"))
        if n >= 50 and 100 * repeat <= 50 * n:
            values[i] = (lang, source, {"symbol_ratio": symbols / n, "repeat_ratio": repeat / n,
                                        "dup_line_ratio": dup / lines, "word_length": chars / n})

    def limits(lang, source, name):
        for rule in (lambda v: v[:2] == (lang, source), lambda v: v[0] == lang, lambda v: True):
            found = sorted(v[2][name] for v in values.values() if rule(v))
            if len(found) >= 100:
                break
        low, mid = (found[math.ceil(q * len(found)) - 1] for q in (0.25, 0.5))
        wide = quality.SPREAD * (mid - low) + quality.MARGINS[name]
        return (mid - wide if name in quality.TWO_SIDED else -math.inf), mid + wide

    assert sum(v[:2] == ("en", "a") for v in values.values()) >= 100 and len(values) < 200
    want = {}
    for i, (lang, source, ratios) in values.items():
        bounds = {k: limits(lang, source, k) for k in ratios}
        want[i] = all(bounds[k][0] <= x <= bounds[k][1] for k, x in ratios.items())
    got = quality.quality_verdicts(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id: r.kept for r in got} == {r[0]: want.get(r[0], False) for r in rows}
    assert 5 < sum(not k for k in want.values()) < len(want) / 2


def test_shards(spark, docs, no_docs):
    got = sharding.shard_documents(docs, shards=3, slots=64).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
                   for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for s in range(3):
        places = sorted(r.slot for r in got if r.shard == s)
        assert places == list(range(len(places)))
    assert sharding.shard_documents(no_docs).count() == 0


def test_slot_map_versions(spark):
    rows = [(i, "x" * (i % 97)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    totals = sharding.slot_totals(sharding.records(frame, 256)).collect()
    maps = sharding.SlotMap(spark)
    first = sharding.balanced_map(totals, 256, 4)
    assert maps.store(first) == 1
    second = sharding.rebalanced_map(first, totals, 5)
    assert maps.store(second) == 2 and maps.pairs(1) == first and maps.pairs() == second
    moved = [(a, b) for (_, a), (_, b) in zip(first, second) if a != b]
    assert len(moved) < 80
    load = Counter()
    for t in totals:
        load[dict(second)[t["vslot"]]] += t["bytes"]
    assert max(load.values()) < 1.05 * min(load.values()) and len(load) == 5
    got = sharding.shard_documents(frame, 5, 256, maps).collect()
    assert {(r.vslot, r.shard) for r in got} <= set(second)


def test_equal_rows_are_spread_by_bytes(spark):
    """The law on the result: no two shards are further apart than 1 % or one record."""
    rows = [(1, "the same text in very many rows", "k")] * 4000 + [
        (10 + i, "x" * (i % 57), "k") for i in range(100)] + [(None, None, "k")] * 9
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string")
    for block in (4096, 7):
        sharding.BLOCK = block
        got = sharding.shard_documents(frame).collect()
        assert Counter((r.doc_id, r.size) for r in got) == Counter(
            (d, len(t or "") + 1) for d, t, _ in rows)
        load = Counter()
        for r in got:
            load[r.shard] += r.size
        assert max(load.values()) - min(load.values()) <= max(
            max(r.size for r in got), 0.01 * sum(load.values()) / 8)
        for s in range(8):
            places = sorted(r.slot for r in got if r.shard == s)
            assert places == list(range(len(places)))
    sharding.BLOCK = 4096


def test_a_stored_map_is_opened_again(spark, tmp_path):
    frame = spark.createDataFrame([(i, "t" * (i % 90)) for i in range(600)],
                                  "doc_id long, text string")
    path = str(tmp_path / "map")
    first = {r.doc_id: r.shard for r in sharding.shard_documents(
        frame, 4, 256, sharding.SlotMap(spark, path)).collect()}
    again = sharding.SlotMap(spark, path)
    assert again.version == 1
    assert {r.doc_id: r.shard for r in sharding.shard_documents(
        frame, 4, 256, again).collect()} == first and again.version == 1
    grown = sharding.shard_documents(frame, 5, 256, sharding.SlotMap(spark, path)).collect()
    reopened = sharding.SlotMap(spark, path)
    assert reopened.version == 2 and {s for _, s in reopened.pairs()} == set(range(5))
    moved = [r for r in grown if r.shard != first[r.doc_id]]
    assert 0 < len(moved) < 0.3 * len(grown) and dict(reopened.pairs(1)) != dict(reopened.pairs())


def test_archive_folders_name_their_store(spark):
    from cartwheel.llm import warc
    assert warc.qualified(spark, "/shared/x") == "file:///shared/x"
    assert warc.file_uri("file:/a/b") == "file:///a/b"
    assert warc.file_uri("hdfs://host:8020/a") == "hdfs://host:8020/a"
    conf = spark._jsc.hadoopConfiguration()
    default = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://elsewhere/")
    conf.set("fs.viewfs.mounttable.elsewhere.link./shared", "file:///tmp")
    try:
        assert warc.qualified(spark, "/shared/x").startswith("viewfs://elsewhere/shared/x")
    finally:
        conf.set("fs.defaultFS", default)
