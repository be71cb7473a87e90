"""Main text and WARC round trip."""

import base64
import hashlib
from collections import Counter

import pytest
import zstandard

from tidemark.llm import html_text, warc
from tidemark.llm.common import hash_sample

SCHEMA = "page_id long, url string, html string, text string"
TREE = html_text.fit_tree(html_text.LABELLED)
PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header class="site-header"><h1>Site name</h1></header>
<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><div id="cookie-notice">We use cookies.</div><aside>Some side words that go on and on</aside>
<main><article><header><h1>Title &amp; more</h1></header><p>First  para&#33; with\n<a href='x'>a link</a> inside.<p><b>Second &lt;para&gt;<br>line<div class="ad-box">Buy now</div>
<form><label>Name</label><input></form><p>Of.</p><!-- <p>gone</p> --><section class="comments"><h2>Comments</h2><article class="comment"><p>Nice post, I liked it very much indeed, all of it.</p></article></section>
</article></main><footer>&copy; x &middot; words</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE, TREE) == "Title & more\n\nFirst para! with a link inside.\n\nSecond <para> line\n\nOf."


def test_pages_without_an_article():
    page = """<body class="has-sidebar"><div class="wrap has-sidebar"><div id="menu"><a href="/">Home</a> <a href="/x">News</a></div><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>
    <div class="entry-header"><h1>The title</h1></div><p>A first paragraph that has enough words in it to be the text.<p><a href=x>open link<p>Short.</p><p>Another paragraph, with words enough to be taken as text of the page.</p>
    <div role="alert">Notice!</div><section id="reader-comments"><p>A long comment by a reader who has much to say about everything here.</p></section></div></body>"""
    assert html_text.main_text(page, TREE).split("\n\n") == [
        "The title", "A first paragraph that has enough words in it to be the text.", "Short.", "Another paragraph, with words enough to be taken as text of the page."]


def test_article_keeps_short_and_linked_blocks():
    page = "<nav><a href=x>A</a></nav><article>" + "".join(f"<p>{t}</p>" for t in ("Of.", "<a href=x>one link</a>", "<a href=y>x</a>", "Two words", "<a href=z>a b c d e f</a>", "x")) + "</article>"
    assert html_text.main_text(page, TREE).split("\n\n") == ["Of.", "one link", "x", "Two words", "a b c d e f", "x"]


TEXT = ["The title", "A first paragraph that has enough words in it to be taken as the text.", "A second one that is as long and says as much as the first paragraph did."]
AROUND = '<header><a href="/">Site</a></header><nav><a href=a>One</a> <a href=b>Two</a></nav>{}<div class="sidebar"><p>Some words beside the text, a few.</p></div><section class="comments"><p>{}</p></section><footer>Words below</footer>'


@pytest.mark.parametrize("wrap", [
    '<article class="post type-post tag-social">', '<article class="post comments-open">', '<main class="sidebar-right">', '<div id="content" class="right-sidebar">', '<div class="article-with-banner">',
    '<article class="format-banner category-ads">', '<main id="main" class="content-sidebar">', '<form id="aspnetForm">', '<div class="page-sidebar-left no-header">', '<div class="sidebar-layout"><div class="content">',
    '<section class="left-nav">', "<div hidden-x=1>", "<article class='story story-header'>",
])
@pytest.mark.parametrize("comment", ["Nice post.", "A comment that is much longer than the text of the page, and goes on. " * 20])
def test_a_layout_class_loses_no_text(wrap, comment):
    """Everyday template classes on the element around the text; a long discussion below changes nothing."""
    inner = f"<h1>{TEXT[0]}</h1><p>{TEXT[1]}</p><p>{TEXT[2]}</p>"
    page = AROUND.format(wrap + inner + "".join(f"</{t.split()[0].strip('>')}>" for t in wrap.split("<")[:0:-1]), comment)
    assert html_text.main_text(page, TREE).split("\n\n") == TEXT


def test_furniture_stays_furniture():
    inner = f"<h1>{TEXT[0]}</h1><p>{TEXT[1]}</p>"
    for tag in ('<article class="comment">', '<article class="comment-body odd">', '<div class="related-posts">', '<div class="cookie-consent">', '<div class="right-sidebar">', "<form>", '<div style="display: none">', "<div hidden>", "<header>"):
        page = f"<article>{inner}<p>{TEXT[2]}</p></article>{tag}<p>{TEXT[1]}</p>"
        assert html_text.main_text(page, TREE).split("\n\n") == TEXT, tag


def test_hidden_inline_text_goes():
    page = '<article><p>Seen <span style="display:none">not <span>seen</span> this</span>and <b hidden>gone</b>read.</p><p><i aria-hidden="true">open<p>Next paragraph.</p></article>'
    assert html_text.main_text(page, TREE) == "Seen and read.\n\nNext paragraph."


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<a href='", "<script>x", "</p></p>", "<p>" * 2000, "<div>" * 3000 + "x", "&#xZZ; &amp", "a < b > c", "<a href=\"x>y"])
def test_broken_markup(page):
    assert isinstance(html_text.main_text(page, TREE), str)


def test_long_page_is_whole():
    page = "<article>" + "".join(f"<p>paragraph {i} has words</p>" for i in range(20_000)) + "</article>"
    assert html_text.main_text(page, TREE).count("\n\n") == 19_999


def test_tree_agrees_with_its_table():
    assert all(html_text.classify(TREE, row) == bool(row[-1]) for row in html_text.LABELLED)


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "clash"), (1, "u", PAGE, "clash"), (2, None, None, None), (None, "v", "<p>only a paragraph of some words that has no article around it at all</p>", None)], SCHEMA)
    rows = html_text.extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 67), (1, 70), (1, 70), (2, 0)]
    assert all(len(r.text) == r.n_chars for r in rows)
    assert html_text.extract(df.limit(0)).count() == 0


ROWS = [(1, "u", "same", "x"), (2, "http://é.example/\r\nx", "same", "x"), (3, None, "same", "x"), (3, None, "same", "x"), (4, "u", None, None), (5, "u", "", None), (6, "u", "naïve 😀 " * 9000, None), (7, "u", "other", None)]


def test_warc_round_trip(spark):
    rows = warc.round_trip(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert len(rows) == len(ROWS)
    best = {}
    for i, _, h, _ in ROWS:
        best[h or ""] = max(best.get(h or "", 0), i)
    text = {i: h or "" for i, _, h, _ in ROWS}
    for r in rows:
        raw = text[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        again = best[text[r.page_id]] != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", best[text[r.page_id]]) if again else ("response", None))


def test_warc_payloads_and_dictionary(spark):
    pages = [(i, f"http://h/{i}", f"<html><body><p>page {i}</p>" + "common words of the site " * 20 + "</body></html>", None) for i in range(200)]
    archives = warc.write_archives(spark.createDataFrame(pages, SCHEMA), archive_bytes=20_000)
    data = archives.collect()
    assert len(data) > 2 and sum(a.n_records for a in data) == 200
    for a in data:
        assert a.data[:4] == bytes.fromhex("5d2a4d18")
        dictionary, at = warc.load_dictionary(a.data)
        assert dictionary is not None and at > 8
    got = {r.record_id: r.payload.decode() for r in warc.read_archives(archives).collect()}
    assert got == {str(i): h for i, _, h, _ in pages}


def test_warc_keys_of_any_form(spark):
    keys = [None, None, "None", "", "a\r\nb: c", "é 😀>", "50%25", "<urn:no-page>", " x "]
    df = spark.createDataFrame([(k, "u", f"payload {i}") for i, k in enumerate(keys)], "page_id string, url string, html string")
    assert Counter(r.page_id for r in warc.round_trip(df).collect()) == Counter(keys)


@pytest.mark.parametrize("n", [0, 5, 400])
def test_hash_sample(spark, n):
    """Distinct rows of smallest hash, the same for every layout; a byte limit leaves at least one."""
    df = spark.createDataFrame([(i, "x" * 10) for i in range(n)] + [(None, "hot")] * (2 * n), "k long, t string")
    some = [tuple(r) for r in hash_sample(df, 3 * n, 40, 10**6, ["k", "t"], "t").collect()]
    assert len(set(some)) == len(some) <= 40 and (len(some) == min(n + 1, 40) if n == 5 else True) and (n < 400 or len(some) > 10)
    assert some == [tuple(r) for r in hash_sample(df.repartition(7), 3 * n, 40, 10**6, ["k", "t"], "t").collect()]
    assert hash_sample(df, 3 * n, 40, 25, ["k", "t"], "t").count() in ((2, 3) if n else (0,))  # texts of 10 and 3 bytes
    assert hash_sample(df, 3 * n, 40, 1, ["k", "t"], "t").count() == min(n, 1)


def test_warc_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_reader_validates():
    raw = warc.page_record(1, "u", b"payload", None, "2024-01-01T00:00:00Z")
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(raw)
    assert [r["payload"] for r in warc.read_records(frame * 2)] == [b"payload"] * 2
    stream = zstandard.ZstdCompressor().compressobj()  # no content size, several blocks
    big = warc.page_record(2, "u", bytes(range(256)) * 4000, None, "2024-01-01T00:00:00Z")
    streamed = stream.compress(big) + stream.flush()
    assert warc.frame_end(streamed + b"tail", 0) == len(streamed)
    with pytest.raises(ValueError):
        list(warc.read_records(frame[:-5]))
    for bad in (raw.replace(b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"), raw.replace(b"payload\r\n", b"pavload\r\n"), raw.replace(b"WARC/1.1", b"WARX/1.1"), raw[:-2], raw.replace(b"WARC-Date", b"X-Date")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    compressed = zstandard.ZstdCompressor().compress(warc.train_dictionary([b"some text %d " % i * 50 for i in range(500)]))
    assert warc.load_dictionary((0x184D2A5D).to_bytes(4, "little") + len(compressed).to_bytes(4, "little") + compressed)[0] is not None


def test_read_files(spark, tmp_path):
    frame = zstandard.ZstdCompressor().compress(warc.page_record(9, "u", b"abc", None, "2024-01-01T00:00:00Z"))
    (tmp_path / "a.warc.zst").write_bytes(frame)
    assert [(r.record_id, bytes(r.payload)) for r in warc.read_files(spark, str(tmp_path)).collect()] == [("9", b"abc")]
