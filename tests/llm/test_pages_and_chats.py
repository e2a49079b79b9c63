"""Page extraction, archives and chat formatting against what was put in."""

import base64
import hashlib
import io
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from cartwheel.llm import chat, html_hosts, warc

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu one</a></ul></nav>
<div id="cookie-notice">We use cookies</div><aside class="sidebar">Side</aside>
<article class="post"><h1>The &amp; title</h1><p>First <b>bold
 word</b>.<br>Second&nbsp;line<div class="share-buttons"><div>Share</div> it</div>
<p>Third<script>var a = "</p>";</script> &#233;nd</p><form>Name <input></form>
<section class="comments"><p>A reader wrote</p></section></article>
<footer>&copy; Site</footer></body></html>"""


def test_structure():
    kind, blocks = html_hosts.page_blocks(PAGE)
    assert kind == html_hosts.ARTICLE
    assert blocks == ["The & title", "First bold word.", "Second line", "Third énd"]


def test_broken_pages():
    assert html_hosts.page_blocks("")[1] == []
    assert html_hosts.page_blocks("a < b <p")[1] == ["a < b <p"]
    assert html_hosts.page_blocks("<article><p>one<p>two</nav><b>three")[1] == ["one", "two", "three"]
    assert html_hosts.page_blocks("<div class=ad>x<p>y</div>z<script>never closed")[1] == ["z"]
    assert html_hosts.page_blocks("<div class='wide has-sidebar'><p>x</p></div>")[1] == ["x"]
    assert html_hosts.page_blocks("<p " + "a='" * 3000 + ">x")[1] is not None


def brute_cover(pages, run):
    """For every token, pages of the most shared window of ``run`` tokens that covers it."""
    streams = []
    for blocks in pages:
        stream = []
        for b in blocks:
            stream += b.split(" ") + [None]
        streams.append(stream)
    where = {}
    for s in {tuple(s) for s in streams}:
        for i in range(len(s) - run + 1):
            where.setdefault(s[i:i + run], set()).add(s)
    return [[max((len(where[tuple(s[i:i + run])]) for i in range(max(0, t - run + 1), t + 1)
                  if i + run <= len(s)), default=1) for t in range(len(s))] for s in streams]


@given(st.lists(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=30)
                         .map(" ".join), max_size=3), min_size=1, max_size=5))
@settings(max_examples=120, deadline=None)
def test_suffix_array(pages):
    got, distinct = html_hosts.repeated_tokens(pages)
    assert distinct == len({tuple(p) for p in pages})
    for own, want in zip(got, brute_cover(pages, html_hosts.RUN)):
        assert [max(1, c) if n >= 1 else c for c, n in zip(own.tolist(), want)] == want


def test_boilerplate_of_a_host(spark):
    random.seed(1)
    fixed = "subscribe to our weekly letter and never miss a story again"
    rows, want = [], {}
    for i in range(40):
        text = " ".join("".join(random.choices("abcdefg", k=6)) for _ in range(30))
        body = f"<div>{fixed}</div><p>{text}</p>"
        rows.append((i, "http://a.example/x", f"<article>{body}</article>" if i % 2 else body))
        want[i] = text
    rows += [(100, None, None), (101, "::", ""), (102, "http://b.example", f"<p>{fixed}</p>")]
    want |= {100: "", 101: "", 102: fixed}
    frame = spark.createDataFrame([(*r, "u") for r in rows],
                                  "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html_hosts.main_texts(frame).collect()}
    assert got == want
    assert html_hosts.main_texts(frame.limit(0)).count() == 0


def test_shared_passages_of_articles_stay(spark):
    passage = " ".join(f"quoted{i}" for i in range(60))
    rows = [(i, "http://a.example", f"<article><p>own {i}</p><p>{passage}</p></article>" if i < 8
             else f"<article><p>alone {i}</p></article>") for i in range(30)]
    got = html_hosts.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert all(passage in r.text for r in got.collect() if r.page_id < 8)


def test_archives(spark):
    rows = [(1, "a", "x" * 5000), (2, "b", "x" * 5000), (2, "b", "x" * 5000), (3, None, None),
            (4, "c", ""), (None, "z", "y"), (7, "h\n%", "\x1f\x8b\x08é"), (9, "q", "x" * 5000),
            (9, "r", "x" * 5000), (10, "long", "é" * 400_000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows],
                                  "page_id long, url string, html string, payload long")
    for split in (97, 5000, warc.RANGE):
        got = warc.write_and_read(frame, split).collect()
        assert sorted((str(r.page_id), r.url or "") for r in got) == sorted(
            (str(a), u or "") for a, u, _ in rows)
        text = {(a, u): (h or "").encode() for a, u, h in rows}
        for r in got:
            data = text[r.page_id, r.url]
            assert r.payload_bytes == len(data)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert (r.record_type == "response") == (r.refers_to is None)
            assert r.payload == (data if r.record_type == "response" else None)
        kinds = sorted((r.page_id, r.record_type) for r in got if r.page_id in (1, 2, 3, 4, 9))
        assert kinds == [(1, "revisit"), (2, "revisit"), (2, "revisit"), (3, "revisit"),
                         (4, "response"), (9, "response"), (9, "revisit")]
        assert {r.refers_to for r in got if r.page_id in (1, 2)} == {9}
    assert warc.write_and_read(frame.limit(0)).count() == 0


def test_reader_passes_over_false_members():
    """Magic bytes in the data, members that hold no record, and garbage between members."""
    def packed(data):
        z = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so inner bytes stay visible
        return z.compress(data) + z.flush()

    good = [warc.record_bytes(i, "u", bytes([i]) * 10 + warc.MAGIC * 5, "D", 25, None)
            for i in range(4)]
    stored = packed(warc.VERSION + b"\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\n" + warc.MAGIC
                    + b"\r\n\r\n")
    data = (b"junk" + good[0] + warc.MAGIC + b"\0" * 9 + good[1] + packed(b"no record") + stored
            + good[2][:-5] + good[3])
    for split in (1, 7, 64, 10_000):
        found = [(at, head) for a in range(0, len(data), split) for at, head, _ in
                 warc.records_in_range(io.BytesIO(data), len(data), a, a + split)]
        assert [h["warc-type"] for _, h in found] == ["response", "response", "x", "response"]


PART = st.lists(st.sampled_from(["</s>", "[INST] ", " [/INST]", "\\", "<s>", "[ROLE=", "]", "[/ROLE]",
                                 "a", " ", "\n", "<<SYS>>", "<</SYS>>", "[", "<"]),
                max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "x]y"]), PART),
                max_size=5))
@settings(max_examples=300, deadline=None)
def test_formatted_text_reads_back(turns):
    fmt = chat.Formatter(chat.Template())
    text = "".join(s for role, t in turns for s, _ in fmt.segments(role, t))
    assert chat.parse_formatted(text) == turns


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s> é"), (2, 0, "assistant", None),
            (2, 0, "assistant", None), (2, None, "user", "q"), (None, 3, None, "x"),
            (4, 1, "tool]", "y"), (5, 0, "system", "s"), (5, 1, "user", "u"), (5, 2, "assistant", "a")]
    rows += [(6, i, "assistant" if i % 2 else "user", "t" * i) for i in range(3000)]
    frame = spark.createDataFrame([(*r, True) for r in rows],
                                  "conv_id long, turn long, role string, text string, loss boolean")
    got = {r.conv_id: r for r in chat.read_formatted(chat.format_conversations(frame)).collect()}
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(learned)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert {c: r.in_order for c, r in got.items()} == {
        1: True, 2: False, None: False, 4: False, 5: True, 6: True}
    assert chat.read_formatted(chat.format_conversations(frame.limit(0))).count() == 0


@pytest.mark.parametrize("role", ["user", "assistant"])
def test_loss_flags(role):
    flags = [loss for _, loss in chat.Formatter(chat.Template()).segments(role, "x")]
    assert flags == [False, role == "assistant", False]


@pytest.mark.parametrize("html", [
    '<article><p title="the hidden gem">TEXT</p></article>',
    '<article itemid="http://x.org/ad/1"><p>TEXT</p></article>',
    '<article><p data-id="share">TEXT</p></article>',
    '<article class="post comments-open"><p>TEXT</p></article>',
    '<div id="content-sidebar-wrap"><article><p>TEXT</p></article></div>',
    '<article><section class="related-work"><p>TEXT</p></section></article>',
    '<article><object><p>TEXT</p></object></article>',
    '<article><p>TEXT</p><p hidden>gone</p><div class=\'comments\'>gone</div></article>',
    '<article><p>TEXT</p></article><div class="comments"><article class="comment">no</article></div>'])
def test_attributes_are_read_by_name(html):
    from cartwheel.llm.html_hosts import page_blocks
    assert page_blocks(html)[1] == ["TEXT"]


def test_formula_stays_in_its_block():
    from cartwheel.llm.html_hosts import page_blocks
    assert page_blocks("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>")[1] == [
        "so x=1 holds"]


def test_two_versions_of_a_page_keep_their_text():
    from cartwheel.llm.html_hosts import BODY, unique_runs
    words = [f"w{i}" for i in range(60)]
    menu = [f"menu{i}" for i in range(12)]
    pages = [[" ".join(menu), " ".join(words)], [" ".join(menu), " ".join(words[:59] + ["changed"])],
             [" ".join(menu), " ".join(f"other{i}" for i in range(60))]]
    first, second, third = unique_runs([BODY] * 3, pages)
    assert " ".join(words) in first and "w58 changed" in second
    assert third == " ".join(f"other{i}" for i in range(60))


def test_repeats_across_the_chunks_of_a_host(spark):
    """Rare repeats and copies fall into different chunks: a host in chunks gives what it gives whole."""
    rng = random.Random(3)

    def words(k):
        return " ".join(f"w{rng.randrange(4000)}" for _ in range(k))

    passages = [(words(12), share) for share in (0.02, 0.03, 0.05, 0.3, 0.7, 0.9)]
    rows = []
    for i in range(120):
        body = [words(30) for _ in range(4)] + [p for p, share in passages if rng.random() < share]
        html = "".join(f"<p>{p}</p>" for p in rng.sample(body, len(body)))
        html = f"<article>{html}</article>" if i % 3 == 0 else html
        rows.append((i, f"https://{'a' if i % 40 else 'b'}.org/{i}", rows[-1][2] if i % 10 == 3 else html))
    rows += [(200, None, None), (201, "https://a.org/", ""), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    whole = sorted(map(str, html_hosts.main_texts(pages, 1000).collect()))
    assert passages[0][0] not in "".join(whole) and passages[2][0] in "".join(r[2] or "" for r in rows)
    for n in (2, 50):
        assert sorted(map(str, html_hosts.main_texts(pages, n).collect())) == whole
