"""Operators over pages and vectors."""

import collections
import random

import numpy as np
import pytest
from cathlake.llm import mtree, warc, wrappers
from edge_docs import SF_SMALL

PAGE = ('<html><head><title>T</title><script>var x="<p>no</p>";</script></head><body><div id="cookie-notice">cookies</div>'
        '<header class="site"><a href="/">Home</a></header><nav><ul><li>menu</ul></nav><main><article><header><h1>Head &amp; '
        'line</h1></header><p>One <b>two</b>&nbsp;three<p>Next &#233; {0}<ul><li>a<li>b</ul><aside>side</aside>'
        '<div class="comments"><p>nice</p></div></article><section class="reader-comments">c</section></main>'
        '<form><input><p>mail</p></form><footer>foot</footer>')
TEXT = "Head & line\nOne two three\nNext é {0}\na\nb"


def test_html(spark):
    rows = [(i, f"http://h{i % 3}.example.org/{i}", PAGE.replace("{0}", f"text {i}"), "x") for i in range(12)]
    rows += [(20, None, None, "x"), (21, "no host", "", "x"), (22, "http://p.example.org/", "only <i>text</i> here", "x"),
             (23, "http://q.example.org/", "<p>" * 3000 + "deep", "x"), (23, "http://q.example.org/", "<p>" * 3000 + "deep", "x"),
             (None, "http://r.example.org", "<div class=menu>m</div><div class=content><h2>A title</h2><p>some words that matter here</p>"
                                            "<p>and more words that matter</p></div>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = wrappers.main_text(df)
    assert out.columns == ["page_id", "url", "text"]
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.page_id].append(r.text)
    for i in range(12):
        assert got[i] == [TEXT.replace("{0}", f"text {i}")]
    assert got[20] == [""] and got[21] == [""] and got[22] == ["only text here"] and got[23] == ["deep", "deep"]
    assert got[None] == ["A title\nsome words that matter here\nand more words that matter"]
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_html_attributes_and_layout():
    """Text in a value is no attribute; the only article is kept inside hinted layout or one form; headings are no template."""
    def text(page):
        return wrappers.extract(page, None)

    for inner in ('<a href="/hidden-lake">lake</a>', '<a href="/x?id=comment">lake</a>', '<span title="hidden">lake</span>',
                  '<b data-id="share" data-class=\'ad\'>lake</b>'):
        assert text(f"<article><p>the {inner} shore</p><p>more words</p></article>") == "the lake shore\nmore words"
    assert text('<article><p data-id="share">one</p><p>two <i hidden>x</i></p></article>') == "one\ntwo"
    body = "<article><h1>Head</h1><p>some words here</p><div class=ad>buy</div></article>"
    for page in (f'<p>stray words</p><div class="content has-sidebar">{body}<div class=sidebar>s</div></div>', f"<form action=/>{body}<input></form>",
                 f'<div class="page header-fixed"><main>{body}<section class="comments"><p>nice</p></section></main></div>'):
        assert text(page) == "Head\nsome words here"
    assert text("<main><p>main words of it</p><div class=related><article>teaser</article></div></main>") == "main words of it"
    assert text("<div><p>words of the body text</p></div><div class=comments><article>nice</article></div>") == "words of the body text"
    root = None
    pages = [f"<article><h2>Background</h2><p>{' '.join(f'w{i}_{k}' for k in range(40))}</p></article>" for i in range(5)]
    for page in pages:
        node, _ = wrappers.read(page)
        root = node if root is None else (wrappers.absorb(root, node, True), root)[1]
    rule = wrappers.rule_of(root)
    assert all(wrappers.extract(p, rule).startswith("Background\nw") for p in pages)


def test_wrapper_alignment():
    a, _ = wrappers.read("<body><h1>x</h1><p>1</p><p>2</p></body>")
    b, _ = wrappers.read("<body><h1>x</h1><table><tr><td>n</table><p>3</p></body>")
    wrappers.absorb(a, b, True)
    s = a.pattern()
    assert "p(#)+" in s and "table" in s and ")?" in s and a.pages == 2


def test_wrapper_template():
    """Text that all pages of a host share inside the article is template, text that differs is kept."""
    root, pages = None, []
    for i in range(5):
        page = f"<article><div class=lead>Share this page</div><p>{' '.join(f'w{i}_{k}' for k in range(40))}</p></article>"
        pages.append(page)
        node, _ = wrappers.read(page)
        if root is None:
            root = node
        else:
            wrappers.absorb(root, node, True)
    rule = wrappers.rule_of(root)
    assert [wrappers.extract(p, rule).startswith("w") for p in pages] == [True] * 5


def test_warc(spark):
    rows = [(1, "http://a.example.org/x/", '<html lang="en"><title>A &amp; B</title><a href="../y">l</a><p>text</p>', "z"),
            (2, None, None, "z"), (3, "http://b.example.org", "", "z"), (3, "http://b.example.org", "", "z"),
            (None, "::bad url[", "<a href='http://[x'>q</a>" + "long " * 50_000, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    source = {r.record_id: r for r in warc.responses(df).collect()}
    out = warc.derivatives(warc.responses(df)).collect()
    assert collections.Counter(r.record_type for r in out) == {"metadata": 5, "conversion": 5}
    for r in out:
        fields, block = warc.parse(bytes(r.record))
        assert block.decode() == r.block and fields["WARC-Refers-To"] == r.refers_to and r.refers_to in source
        assert fields.get("WARC-Target-URI") == r.target_uri == source[r.refers_to].target_uri
    one = {r.record_type: r for r in out if r.page_id == 1}
    assert one["conversion"].block == "l\ntext" or one["conversion"].block == "l text"
    assert "title: A & B" in one["metadata"].block and "outlink: http://a.example.org/y L a/@href" in one["metadata"].block
    assert "source-header-content-type: text/html; charset=utf-8" in one["metadata"].block
    assert one["metadata"].source_digest == one["conversion"].source_digest
    assert len({r.record_id for r in out}) == 8  # the repeated row makes the same records again
    assert warc.derivatives(warc.responses(df.limit(0))).count() == 0


def test_warc_fields_stay_one_line(spark):
    rows = [(1, "http://a.example.org/\r\nWARC-Type: warcinfo\n x", "<title>A\r\nB</title><a href='/\x01y'>l</a>")]
    out = warc.derivatives(warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    for r in out:
        fields, block = warc.parse(bytes(r.record))
        assert fields["WARC-Type"] == r.record_type and block.decode() == r.block
        assert fields["WARC-Target-URI"] == r.target_uri == "http://a.example.org/%0D%0AWARC-Type: warcinfo%0A x"
        assert bytes(r.record).count(b"WARC-Type:") == 1 + bytes(r.record).count(b"%0D%0AWARC-Type:")
    meta = next(r.block for r in out if r.record_type == "metadata")
    assert all(": " in line for line in meta.split("\r\n") if line) and "\n" not in meta.replace("\r\n", "")


def brute_top(rows, is_query, k):
    out = []
    for i, (q, v) in enumerate(rows):
        if is_query(q):
            s = sorted(((-int(np.dot(v, w)), c) for j, (c, w) in enumerate(rows) if j != i))[:k]
            out += [(q, n + 1, c, -x) for n, (x, c) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("node,page", [(2048, 64), (40, 8)])
def test_top_k(spark, monkeypatch, node, page):
    monkeypatch.setattr(mtree, "NODE_ROWS", node)
    monkeypatch.setattr(mtree, "PAGE", page)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 6))
    v[40:140] = v[40]  # one very common vector
    rows = [(i, [float(x) for x in v[i]], 0) for i in range(300)]
    rows += [(300, None, 0), (320, [1.0, None], 0), (340, [float("nan")] * 6, 0), (360, [float("inf")] * 6, 0), (None, [1.0] * 6, 0),
             (20, [0.5] * 6, 0), (380, [1.0, 2.0], 0), (400, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = mtree.top_k(mtree.prepared(df), mtree.F.col("vec_id") % 20 == 0, 7).collect()
    used = [(i, np.pad(np.floor(64 * np.array(x, np.float32).astype(float)), (0, 6 - len(x)))) for i, x, _ in rows
            if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    assert sorted(tuple(r) for r in got) == brute_top(used, lambda q: q % 20 == 0, 7)
    assert mtree.top_k(mtree.prepared(df.limit(0)), mtree.F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_avoids_distances():
    """On clustered vectors the stored bounds spare most of the computations."""
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(20, 8)) * 200
    x = np.floor(centers[rng.integers(20, size=2000)] + rng.normal(size=(2000, 8)) * 4)
    m = float((x * x).sum(axis=1).max())
    center = mtree._extended(x[:1], m)[0]
    import pandas as pd

    node = pd.Series(mtree.build_node(x, np.arange(2000), np.arange(2000), center, m))
    counted = {}
    q = x[:50]
    best = mtree.search_node(node, center, q, np.arange(50), np.full(50, -np.inf), 5, m, counted)
    want = np.sort(np.where(np.eye(50, 2000, dtype=bool), -np.inf, q @ x.T), axis=1)[:, ::-1][:, :5]
    assert (best.score == want).all() and counted["entries"] < 0.5 * 50 * 2000


def test_html_brute(spark):
    """The whole pages table against the article element read by the standard library's parser."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.on, self.run, self.out = False, [], []

        def flush(self):
            t = " ".join("".join(self.run).split())
            self.run = []
            if t:
                self.out.append(t)

        def handle_starttag(self, tag, attrs):
            if tag in ("p", "h1", "br", "article"):
                self.flush()
            self.on |= tag == "article"

        def handle_endtag(self, tag):
            if tag in ("p", "h1", "article"):
                self.flush()
            if tag == "article":
                self.on = False

        def handle_data(self, data):
            if self.on:
                self.run.append(data)

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    for r in pages.collect():
        p = Article()
        p.feed(r.html)
        p.close()
        p.flush()
        assert got[r.page_id] == "\n".join(p.out)
    random.seed(0)


@pytest.mark.parametrize("bits", [20, 29])
def test_top_k_wide(spark, bits):
    """Products beyond 2^53 are ranked as integers."""
    rng = np.random.default_rng(bits)
    v = rng.integers(-2 ** bits, 2 ** bits, size=(200, 6))
    v[50:80] = v[50]
    v[60:80, 0] += np.arange(20)  # scores that differ in their last digits
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mtree.top_k(mtree.prepared(df, scale=1), mtree.F.col("vec_id") % 20 == 0, 20)
    want = []
    for q in range(0, 200, 20):
        s = sorted((-sum(int(a) * int(b) for a, b in zip(v[q], v[j], strict=True)), j) for j in range(200) if j != q)[:20]
        want += [(q, n + 1, j, -x) for n, (x, j) in enumerate(s)]
    assert sorted(tuple(r) for r in got.collect()) == want
