from __future__ import annotations

import base64
import hashlib
import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import html_text as ht
from shelfguard.llm import token_shards as ts
from shelfguard.llm import warc
from shelfguard.session import scratch_path

PAGES = "page_id long, url string, html string"


def _pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


# -- archive ------------------------------------------------------------------------
ROWS = [(5, "http://a/", "<p>x</p>"), (3, "http://b/", "<p>x</p>"), (9, None, None), (4, "http://c/", ""), (7, "http://d/\r\nX: y", "ü" * 70_000), (8, "http://e/", "<p>y"), (8, "http://e/", "<p>y"), (11, "u", "<p>x</p>")]


def test_archive_digests_and_revisits(spark):
    got = sorted(tuple(r) for r in warc.op8_warc(_pages(spark, ROWS).withColumn("address", F.lit(1))).collect())
    wanted = []
    for i, _, html in ROWS:
        raw = (html or "").encode()
        first = min(k for k, _, h in ROWS if (h or "") == (html or ""))
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        wanted.append((i, len(raw), digest, "response" if i == first else "revisit", None if i == first else first))
    assert [r[:5] for r in got] == sorted(wanted)


def test_records_are_rebuilt_exactly_and_payloads_stored_once(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(_pages(spark, ROWS), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})
    records = warc.read_records(spark, path).collect()
    assert len(records) == len(ROWS)
    texts = {i: (h or "").encode() for i, _, h in ROWS}
    for r in records:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        fields = warc.parse_header(head.decode() + "\r\n")
        assert fields["version"] == "WARC/1.1" and fields["WARC-Type"] == r.record_type
        assert body == (texts[r.page_id] if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert int(fields["Content-Length"]) == len(body) - 4 and r.payload_bytes == len(texts[r.page_id])
        assert fields["WARC-Payload-Digest"] == "sha1:" + warc.sha1_base32(texts[r.page_id])
    digests = {(r.page_id, r.record_sha256) for r in warc.op8_warc(_pages(spark, ROWS)).collect()}
    assert digests == {(r.page_id, hashlib.sha256(bytes(r.record)).hexdigest()) for r in records}


def test_a_forged_length_or_digest_is_found(spark):
    path = scratch_path(spark, "warc-forged")
    warc.write_archive(_pages(spark, [(1, "u", "abc"), (2, "v", "abc"), (3, "w", "")]), path)
    for n, (field, forged, message) in enumerate([("Content-Length: 3", "Content-Length: 999", "Content-Length"), ("Content-Length: 0", "Content-Length: 3", "Content-Length"), ("Digest: sha1:", "Digest: sha1:A", "digest")]):
        spark.read.parquet(f"{path}/payloads").write.parquet(f"{path}/{n}/payloads")
        spark.read.parquet(f"{path}/headers").withColumn("header", F.replace("header", F.lit(field), F.lit(forged))).write.parquet(f"{path}/{n}/headers")
        with pytest.raises(Exception, match=message):
            warc.read_records(spark, f"{path}/{n}").collect()


def test_a_damaged_payload_is_found(spark):
    path = scratch_path(spark, "warc-bad")
    warc.write_archive(_pages(spark, ROWS), path)
    store = spark.read.parquet(f"{path}/payloads")
    swapped = store.withColumn("member", F.when(F.col("payload_bytes") == 8, F.lit(store.where("payload_bytes = 4").first()["member"])).otherwise(F.col("member")))
    swapped.write.parquet(f"{path}/2/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/2/headers")
    with pytest.raises(Exception, match="other content than its address"):
        warc.read_records(spark, f"{path}/2").collect()


def test_archive_of_nothing_and_rows_without_id(spark):
    assert warc.op8_warc(_pages(spark, [])).count() == 0
    got = sorted(str((r.page_id, r.record_type, r.refers_to)) for r in warc.op8_warc(_pages(spark, [(None, "u", "a"), (2, "u", "a"), (None, "u", "b")])).collect())
    assert got == sorted([str((None, "revisit", 2)), str((2, "response", None)), str((None, "response", None))])


# -- page text ----------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar">
<header class="site-header"><h1>Site</h1><p>The best site in the world, with news for all of you to read.</p></header>
<nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice">We use cookies to improve your experience, and by going on you agree to it.</div>
<div id="page"><div class="content"><h2>Title&nbsp;here</h2><!-- no <p>text</p> --><p>Long text of the <b>first</b> paragraph with many words,
 and commas, that goes on and on for a while.</p><p>Short.</p><div class="ad">Buy this thing now. It is really a very good thing, you know that.</div>
<p>Another para<i>graph</i> &lt;tag&gt; &amp with many words, a &lt; b, that goes on and on for a while.<p>Unclosed one, that is a little longer than the short one was.
<form><p>Your name and all of the other things we want to know from you, please.</p></form></div>
<aside><p>A sidebar has text also that is long enough to count as a paragraph of its own in here.</p></aside>
<section class="comments"><article class="comment"><p>I do not agree with this text at all, since it is wrong in every way.</p></article></section></div>
<p hidden>This is hidden from every reader, so nobody can see it on the page at all, never.</p><footer>&copy; 2020</footer></body></html>"""
TEXT = (
    "Title here Long text of the first paragraph with many words, and commas, that goes on and on for a while. Short. "
    "Another paragraph <tag> & with many words, a < b, that goes on and on for a while. Unclosed one, that is a little longer than the short one was."
)


def test_article_is_found():
    assert ht.extract(PAGE) == TEXT


@pytest.mark.parametrize("page", [None, "", " ", "<html>", "<p", "<!-- x", "<script>x", "<nav>a</nav>", "</p></div>", "<a href='x", "<<>>&&;&#xFFFFFFFF;"])
def test_pages_without_text_do_not_fail(page):
    assert isinstance(ht.extract(page), str)


def test_cut_off_pages_keep_what_came():
    whole = "<article><h1>Head of it</h1><p>" + "word " * 40 + "</p><p>tail"
    assert ht.extract(whole) == "Head of it " + "word " * 40 + "tail"
    assert ht.extract(whole + "</p></art").startswith("Head of it")


def test_short_pages_of_plain_paragraphs():
    body = "".join(f"<p>{'some words in a row, ' * n}.</p>" for n in (6, 1, 5))
    assert ht.extract(f"<body>{body}<ul><li><a>one</a></li><li><a>two</a></li></ul></body>").count("some words") == 12


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 8)
    terminal = [rng.choice([-3, -1, -0.5, 0, 0.4, 1, 2.5]) for _ in range(n)]
    edges = [(rng.randrange(n), rng.randrange(n), rng.choice([0.3, 0.6, 1, 2])) for _ in range(rng.randint(0, 14))]

    def cost(side):
        return sum(max(0, -t) if s else max(0, t) for t, s in zip(terminal, side, strict=True)) + sum(w for a, b, w in edges if side[a] != side[b])

    assert cost(ht.min_cut(terminal, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_page_frames(spark, small):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "x", ""), (3, "v", "<article><p>" + "ä " * 200_000 + "</p></article>")]
    got = ht.op10_html_text(_pages(spark, rows).withColumn("text", F.lit("mine"))).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", len(TEXT)), ("1", len(TEXT)), ("2", 0), ("3", 399_999), ("None", 0)]
    assert ht.op10_html_text(_pages(spark, [])).count() == 0


# -- token shards -------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    f = ts.Feistel(n)
    slots = f.slot_of(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n)) and f.sequence_of(slots).tolist() == list(range(n))
    if n > 100:
        assert (slots != ts.Feistel(n, key=1).slot_of(np.arange(n))).mean() > 0.9 and (slots == np.arange(n)).mean() < 0.05


def test_shards_hold_every_token_once(spark, docs_of):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta", "γ", "12"]) for _ in range(rng.randint(0, 400)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "<|endoftext|>"), (1, rows[1][1]), (None, "no id"), (103, "word " * 20_000)]
    path = scratch_path(spark, "shards")
    m = ts.write_shards(docs_of(rows), path, seq_len=64, shard_size=32)
    got = sorted((r.sequence, r.slot, r.shard, r.byte_offset, r.n_tokens, bytes(r.ids)) for r in ts.read_slots(spark, path).collect())
    assert [r[0] for r in got] == list(range(m["n_sequences"])) and sorted(r[1] for r in got) == list(range(m["n_sequences"]))
    assert all(s == slot // 32 and b == slot % 32 * 128 for _, slot, s, b, _, _ in got)
    assert all(n == 64 for *_, n, _ in got[:-1]) and sum(r[4] for r in got) == m["n_tokens"]
    stream = np.frombuffer(b"".join(r[5] for r in got), dtype="<u2")[: m["n_tokens"]]
    encoding, end = ts._encoding(ts.RANKS)
    found = sorted(tuple(x[:-1].tolist()) for x in np.split(stream, np.flatnonzero(stream == end) + 1)[:-1])
    assert found == sorted(tuple(encoding.encode_ordinary(t or "")) for _, t in rows)
    part = sorted((r.slot, bytes(r.ids)) for r in ts.read_slots(spark, path, 30, 70).collect())
    assert part == sorted((r[1], r[5]) for r in got if 30 <= r[1] < 70)
    assert ts.read_slots(spark, path, 70, 70).count() == 0


def test_same_input_gives_the_same_shards_and_none_gives_none(spark, docs_of):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("ids", F.lit(1)).withColumn("task", F.lit(2))
    a, b = (sorted(tuple(r) for r in ts.op7_token_shards(df).collect()) for _ in range(2))
    assert a == b and a
    assert ts.op7_token_shards(docs_of([])).count() == 0


LONG = "<p>" + "A paragraph with many words, and commas, that goes on and on for quite a while. " * 4 + "</p>"
ASIDE = "<div class='sidebar'><p>A sidebar has text also that is long enough to count as a paragraph of its own here.</p></div>"


@pytest.mark.parametrize(
    "start", [
        '<article class="post hentry category-social">', '<article class="post-12 post type-post status-publish tag-search tag-related">',
        '<div class="entry-content share-bar-on">', '<main id="alert-archive">', '<div class="category-news">', "<section id='discussion-paper'>",
        '<article class="has-sidebar">', '<div class="content widget-area-off">', '<article id="promo-week" class="article--teaser">', '<div class="page-with-comments">',
        "<section id='discussion'>", '<main class="search">', '<div class="notice">', '<div class="social">', '<article class="single alert">',
    ],
)
def test_names_of_articles_do_not_empty_them(start):
    page = f"<body><nav><a href='/'>Home</a> <a href='/x'>More</a></nav>{start}<h1>The title</h1>{LONG * 3}</{start[1:].split()[0]}>{ASIDE}<footer>Contact us</footer></body>"
    got = ht.extract(page)
    assert got.count("A paragraph with") == 12 and "sidebar" not in got and "Contact" not in got


@pytest.mark.parametrize(
    "start", [
        '<div class="comments">', '<div id="comment-list">', '<div class="sidebar-left">', '<div class="site-footer">', '<div class="cookie-banner">', '<div class="ad">',
        '<div class="nav-menu">', '<div class="newsletter-signup">', '<div role="complementary">', '<section class="related">', '<div class="social">', '<article class="comment">',
    ],
)
def test_names_of_boilerplate_go(start):
    page = f"<body><article><h1>The title</h1>{LONG * 3}</article>{start}<p>This stands beside the article, and no reader would miss any of it at all.</p></{start[1:].split()[0]}></body>"
    got = ht.extract(page)
    assert got.count("A paragraph with") == 12 and "beside the article" not in got


def test_long_comments_do_not_become_the_article():
    page = f"<body><article><p>A short note of some eight or nine words, nothing more.</p></article><div class='comments'>{LONG * 5}</div></body>"
    assert ht.extract(page) == "A short note of some eight or nine words, nothing more."


def test_formulas_are_text():
    page = f"<article>{LONG}<p>The sum of all such numbers is <math><mi>x</mi><mo>+</mo><mn>1</mn></math> and not any less than that.</p></article>"
    assert "numbers is x+1 and not" in ht.extract(page)


def _shortest_paths(terminal, near):
    """Minimum cut by one augmenting path at a time."""
    source = {v: c for v, c in terminal.items() if c > 0}
    sink = {v: -c for v, c in terminal.items() if c < 0}
    left = {v: dict(e) for v, e in near.items()}
    while True:
        came, queue, last = dict.fromkeys([v for v, c in source.items() if c > 1e-9]), [v for v, c in source.items() if c > 1e-9], None
        for v in queue:
            if sink.get(v, 0) > 1e-9:
                last = v
                break
            for u, c in left[v].items():
                if c > 1e-9 and u not in came:
                    came[u] = v
                    queue.append(u)
        if last is None:
            return set(came)
        path, v = [], last
        while came[v] is not None:
            path.append((came[v], v))
            v = came[v]
        push = min([source[v], sink[last], *(left[a][b] for a, b in path)])
        source[v] -= push
        sink[last] -= push
        for a, b in path:
            left[a][b] -= push
            left[b][a] += push


@pytest.mark.parametrize("seed", range(40))
def test_flow_equals_single_paths_on_random_graphs(seed):
    rng = random.Random(seed)
    n = rng.randint(2, 60)
    near = {v: {} for v in range(n)}
    for _ in range(rng.randint(0, 4 * n)):
        a, b = rng.randrange(n), rng.randrange(n)
        if a != b:
            near[a][b] = near[b][a] = rng.choice([0.25, 0.5, 1.0, 1.5])
    terminal = {v: rng.choice([-4, -1.5, -0.5, 0, 0.5, 1.25, 3.0]) for v in range(n)}
    assert ht.max_flow(dict(terminal), near) == _shortest_paths(terminal, near)


def test_long_pages_take_time_in_proportion():
    short = "".join(f"<div>{'word ' * (3 + i % 9)}<a href='x'>{'link ' * (i % 4)}</a></div>" for i in range(30_000))
    tags = "<b>" * 8000 + "x</i></u>" * 20_000 + "</b>" * 8000
    for page in (short, f"<article>{short}</article>", tags):
        began = time.perf_counter()
        ht.extract(page)
        assert time.perf_counter() - began < 20


def _brute_page(page):
    """The least-cost labelling of a small page by trying all."""
    found, elements = ht.blocks(page)
    texts = [" ".join("".join(b.parts).split()) for b in found]
    score = ht.scores(found, elements, texts)
    used = sorted({e for b in found for e in _chain(elements, b.element)})
    edges = [(("b", k), ("b", k + 1), ht.ADJACENT) for k in range(len(found) - 1)] + [(("b", k), ("e", b.element), ht.PARENT) for k, b in enumerate(found)]
    edges += [(("e", e), ("e", elements[e][1]), ht.PARENT) for e in used if elements[e][1] >= 0]
    nodes = [("b", k) for k in range(len(found))] + [("e", e) for e in used]
    best = None
    for labels in itertools.product([False, True], repeat=len(nodes)):
        side = dict(zip(nodes, labels, strict=True))
        cost = sum(max(0, -s) if side["b", k] else max(0, s) for k, s in enumerate(score)) + sum(w for a, b, w in edges if side[a] != side[b])
        if best is None or cost < best[0] - 1e-9:
            best = cost, [t for k, t in enumerate(texts) if side["b", k]]
    return " ".join(best[1])


def _chain(elements, e):
    while e >= 0:
        yield e
        e = elements[e][1]


@pytest.mark.parametrize(
    "page", [
        f"<body><nav><a>Home</a></nav><article>{LONG}<p>Short one.</p>{LONG}</article><footer>Bye</footer></body>",
        f"<div class='ad'>Buy this</div><div>{LONG}</div><aside>More of it</aside><p>And so on it goes</p>",
        "<ul><li><a>one</a></li><li><a>two</a></li></ul><p>Just a few words here</p>", f"<section id='discussion'>{LONG}</section><div class='comments'>No</div>",
    ],
)
def test_small_pages_equal_all_labellings(spark, page):
    got = ht.op10_html_text(_pages(spark, [(1, "u", page)])).first()
    assert got.text == _brute_page(page) and got.n_chars == len(got.text)
