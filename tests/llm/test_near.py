"""The similarity join, decontamination and the pipeline against brute force."""

import random

import pytest

from cartwheel.llm import decontaminate, ngram_join
from cartwheel.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else (
        frozenset([tuple(w)]) if w else frozenset())


def brute_components(rows):
    """Least doc_id reachable for every doc_id; rows of one doc_id are one document."""
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in parent}


def families(seed):
    """Originals with copies of growing distance, chains, short texts and a passage most share."""
    random.seed(seed)
    passage = [f"shared{i}" for i in range(60)]
    rows, d = [], 0
    for f in range(12):
        base = [f"w{f}x{i}" for i in range(random.choice([6, 12, 40, 80, 200]))]
        if f % 3 == 0:
            base = passage + base
        for k in range(9):
            own = list(base)
            for _ in range(k * max(1, len(base) // 80)):
                own[random.randrange(len(own))] = f"e{random.randrange(10 ** 6)}"
            if k == 4:
                base = own  # the copies after it differ from it, not from the first
            if k == 7:
                own = own[:-max(1, len(own) // 7)]
            rows.append((d, " ".join(own)))
            d += random.randint(1, 3)
    return rows + [(d + 1, "a b"), (d + 2, "A  b"), (d + 3, ""), (d + 4, " "), (d + 5, "a b c d e")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = families(seed)
    want = brute_components(rows)
    got = ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(shingles(t)) for d, t in rows}


def test_matrix_alone_finds_every_link(spark, monkeypatch):
    """Without seeds, all links come from the token-group matrix."""
    monkeypatch.setattr(ngram_join, "AGREE", 99)
    rows = families(3)
    got = ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def growing(seed):
    """Isolated pairs and chains in which each text contains the one before, or is cut from it."""
    random.seed(seed)
    rows, d = [], 0
    for f, share in enumerate([0.75, 0.77, 0.8, 0.83, 0.86, 0.89] * 3):
        own = [f"g{f}x{i}" for i in range(random.choice([84, 104, 164]))]
        for k in range(2 + f % 3):
            rows.append((d, " ".join(own)))
            d += 1
            n = len(own) - 4
            if f % 2:
                own = own[:4 + -int(-n * share // 1)]
            else:
                own = own + [f"g{f}k{k}y{i}" for i in range(int(n / share) - n)]
    return rows


def test_matrix_alone_links_growing_and_truncated_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "AGREE", 99)
    rows = growing(4)
    got = ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def test_required_numbers_never_exceed_the_truth(spark):
    """Sets that link at the least possible overlap share at least the required cut tokens."""
    for a in range(1, 60):
        for b in range(-(-3 * a // 4), a + 1):
            overlap = -(-3 * (a + b) // 7)
            # the overlap may lie as late as possible in the set that ends first
            shared = overlap - max(ngram_join.needed(a), ngram_join.needed(b)) + 1
            cut = min(a - ngram_join.needed(a), b - ngram_join.needed(b)) + 1
            assert shared <= cut


def test_required_within_never_exceeds_the_least_over_all_sizes(spark):
    def exact(a, b):
        if 4 * min(a, b) < 3 * max(a, b):
            return None
        return max(1, -(-3 * (a + b) // 7) - ngram_join.needed(max(a, b)) + 1)

    ranges = [(41, 41, 42, 44)] + [(a, a + k, b, b + m) for a in range(1, 90, 3) for k in (0, 1, 4)
                                   for b in range(1, 90, 2) for m in (0, 2, 5)]
    frame = spark.createDataFrame(ranges, "a long, b long, c long, d long")
    got = frame.select("*", ngram_join.required_within(*map(frame.__getitem__, "abcd")).alias("n"))
    for a, b, c, d, n in got.collect():
        all_ = [exact(x, y) for x in range(a, b + 1) for y in range(c, d + 1)]
        found = [x for x in all_ if x is not None]
        assert not found or n is not None and min(found) - 1 <= n <= min(found), (a, b, c, d, n)


def test_rows_of_any_kind(docs, no_docs):
    got = ngram_join.near_components(docs).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.component_id)
    assert len(got) == docs.count()
    assert by_id[1] == by_id[2] == [1] and by_id[7] == by_id[8] == [7] and by_id[9] == [9, 9]
    assert by_id[5] == [5] and by_id[6] == [6]
    assert sorted(by_id[None], key=str) == [4, None]  # a copy of document 4, and one without text
    assert ngram_join.near_components(no_docs).count() == 0
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, 4, 5, 6, 7, 9, 10, 11, 12, None], key=str) or 3 not in ids


def test_contraction(spark):
    random.seed(5)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.label for r in components(frame).collect()}
    loops = {a for a, b in edges if a == b and sum(a in e for e in edges) == 1}
    assert got == {x: root(x) for x in parent if x in got}
    assert set(parent) - set(got) <= {x for x in parent if all(a == b for a, b in edges if x in (a, b))}
    assert loops.isdisjoint(got)


ITEMS = [(i, " ".join(f"b{i}w{k}" for k in range(n)))
         for i, n in enumerate([3, 5, 13, 20, 33, 45, 64])] + [(50, None), (51, "..."), (None, "one two")]


def test_items_in_documents(spark, docs):
    random.seed(6)
    bench = spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id long, text string, hits int")
    rows, want = [], set()
    for i, (item, text) in enumerate(ITEMS[:7]):
        words = text.split()
        filler = [f"f{random.randrange(500)}" for _ in range(300)]
        at = random.randrange(300)
        rows.append((10 * i, " ".join(filler[:at] + words + filler[at:])))
        rows.append((10 * i + 1, ", ".join(w.upper() for w in words) + "!"))
        want |= {(10 * i, item), (10 * i + 1, item)}
        if len(words) >= 33:
            edited = words[:10] + ["changed"] + words[11:]
            rows.append((10 * i + 2, " ".join(filler + edited + filler)))
            want |= {(10 * i + 2, item)} if len(words) - 4 >= 5 * 0.75 / 0.25 - 5 + 10 else set()
            rows.append((10 * i + 3, " ".join(filler + words[:len(words) // 2] + filler)))
        rows.append((10 * i + 4, " ".join(filler)))
    rows.append((99, " ".join(["pad"] * 30_000 + ITEMS[4][1].split() + ["pad"] * 9000)))
    rows.append((98, None))
    want.add((99, 4))
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    exact = {(d, i) for d, i in want}
    assert exact <= found | {(d, i) for d, i in want if d % 10 == 2 and i == 4}
    assert {d for d, _ in found} <= {d for d, _ in want}
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_every_exact_edited_and_truncated_item_is_found():
    """At random offsets, whatever brute force puts at 0.75 or more (no shingle is in two items)."""
    random.seed(8)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(n)))
             for i, n in enumerate([8, 21, 34, 40, 53, 59, 77, 96, 120])]
    texts, want = [], []
    for item, text in items * 24:
        words, kind = text.split(), len(texts) // 9 % 3
        if kind == 1:
            words[random.randrange(len(words))] = "edited"
        elif kind == 2:
            words = words[:4 + -int(-(len(words) - 4) * random.uniform(0.75, 0.9) // 1)]
        at = random.randrange(200)
        filler = [random.choice(["the", "of", "and", f"f{random.randrange(900)}"]) for _ in range(300)]
        # a stray passage of the item before must not take its shingles from the whole one
        texts.append(" ".join(text.split()[:6] + filler[:at] + words + filler[at:]).encode())
        s, t = shingles(text), shingles(" ".join(words))
        if len(s & t) >= 0.75 * len(s | t):
            want.append((len(texts) - 1, item, len(s & t) / len(s | t)))
    found = decontaminate.Screen(items).hits(texts, decontaminate.WordHash())
    got = {(d, x["item_id"]): x["similarity"] for d, own in enumerate(found) for x in own}
    assert len(want) > 150 and not [w for w in want if got.get(w[:2], 0) < w[2] - 1e-9]


def test_weights_count_the_whole_benchmark(spark, monkeypatch):
    """The same verdicts in one block and in many, and for items that are listed more than once."""
    common = [f"c{k}" for k in range(12)]
    texts = [" ".join(common + [f"i{i}w{k}" for k in range(40)]) for i in range(6)]
    items = [(i, t) for i, t in enumerate(texts)] + [(20, texts[0]), (21, texts[0].upper() + "!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(0, "f0 f1 " + texts[0].replace("i0w14", "other") + " f2"), (1, texts[1]),
            (2, " ".join(common)), (3, " ".join(texts[2].split()[:36]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def found():
        return sorted((r.doc_id, r.item_id, round(r.similarity, 9))
                      for r in decontaminate.contaminated(docs, bench).collect())

    whole = found()
    assert {(d, i) for d, i, _ in whole} >= {(0, 0), (0, 20), (0, 21), (1, 1)}
    assert all(d != 2 for d, _, _ in whole)
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 4)
    assert found() == whole


def test_radius_is_covered():
    """Every value within RADIUS bits agrees with some block's table."""
    import numpy as np
    screen = decontaminate.Screen(ITEMS)
    rng = np.random.default_rng(3)
    for size, (own, near) in screen.classes.items():
        for i in own:
            for _ in range(200):
                bits = rng.choice(64, decontaminate.RADIUS, replace=False)
                value = int(screen.prints[i]) ^ sum(1 << int(b) for b in bits)
                assert any(near[b, (value >> (16 * b)) & 0xFFFF] for b in range(4))


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    now = docs.drop("key", "h", "label")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, now, str(tmp_path))
        assert out.columns == now.columns, name
        again = step(spark, now.limit(0), str(tmp_path))
        assert again.columns == now.columns and again.count() == 0
        assert set(map(str, out.collect())) <= set(map(str, now.collect()))
        now = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.text for r in last.collect()} == {r.text or "" for r in docs.collect()}


def test_hits_come_from_windows(monkeypatch):
    """Without the windows' candidates nothing is found, and places of other items cost nothing."""
    items = [(0, " ".join(f"a{k}" for k in range(40))), (1, " ".join(f"b{k}" for k in range(70)))]
    text = ("x y z " + items[0][1] + " " + " ".join(items[1][1].split()[:56]) + " end").encode()
    screen = decontaminate.Screen(items)
    assert [h["item_id"] for h in screen.hits([text], decontaminate.WordHash())[0]] == [0, 1]
    assert screen.hits([b"a0 a1 a2 a3 c", b""], decontaminate.WordHash()) == [[], []]
    monkeypatch.setattr(decontaminate.Screen, "candidates", lambda *_: set())
    assert screen.hits([text], decontaminate.WordHash()) == [[]]


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    """All four stages in a row: rows rejected, copies, contaminated and clean ones, and their ids."""
    import corpus_pipeline
    import public_tokenizers
    import sentencepiece
    random.seed(12)

    def words(n):
        return ["".join(random.choices("abcdefghij", k=random.randint(4, 7))) for _ in range(n)]

    items = [(i, " ".join(words(random.randint(30, 60)))) for i in range(6)]
    rows = []
    for i in range(60):
        own = words(random.randint(60, 160))
        rows.append(own)
        if i % 4 == 0:  # a near copy, with a fraction of the words changed that may be too large
            edited = list(own)
            for at in random.sample(range(len(own)), random.choice([1, 2, 30])):
                edited[at] = "other"
            rows.append(edited)
        if i % 10 == 0:
            rows.append(own[:30] + items[i // 10][1].split() + own[30:90] + words(40))
        if i % 9 == 0:
            rows += [words(20), words(3) * 40]  # too short, repeated
    texts = list(enumerate(map(" ".join, rows))) + [(900, None), (901, ""), (902, "é ü\t" * 3)]
    docs = spark.createDataFrame([(d, t, "en", "web", len(t or "")) for d, t in texts],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")

    def good(text):
        w = (text or "").split()
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        again = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(i, i + 3)}
        return len(w) >= 50 and 100 * len(again) <= 50 * len(w)

    first = [(d, t) for d, t in texts if good(t)]
    group = brute_components(first)
    second = [(d, t) for d, t in first if group[d] == d]
    want = {d: t for d, t in second if not any(item in t for _, item in items)}
    assert len(texts) > len(first) > len(second) > len(want) > 50

    model = public_tokenizers.path(corpus_pipeline.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=str(model))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for d, r in got.items():
        assert r.text == want[d] and r.n_pieces == len(r.pieces)
        assert list(r.pieces) in (library.encode(want[d]), library.encode(want[d], out_type=str))

    none = tmp_path / "none"
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{none}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(none)).count() == 0
