import itertools

import pytest
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm.html_text import Page, Thresholds, extract_text, host_of, site_templates, surroundings

SF = "/root/testdata/sf0.001"


def text(html, *args):
    return Page(html, *args).main_text()


@pytest.mark.parametrize("html,want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"),
    ("<article><h1>T</h1><p><b>x<br><p> y\n\tz </p></article>", "T\nx\ny z"),
    ("<nav>menu</nav><article>in</article><footer>f</footer>", "in"),
    ("<article><p>keep</p><aside>side</aside><form>f<input></form><script>var a='</p>';</script><p>also</p></article>", "keep\nalso"),
    ("<article><p>a</p><div class='share-buttons'>s</div><section id='comments'><article>c</article></section></article>", "a"),
    ("<article class=comment>reader</article><article><p>x</article>", "x"),
    ("<body class='has-sidebar'><div class='entry-header'><p>a</div><div class='site-header'>b</div></body>", "a"),
    ("<article>1 &lt; 2 &#233;&nbsp;&copy; &notit;</article>", "1 < 2 é © ¬it;"),
    ("<!-- <p>no</p> --><article>a<!-- b -->c</article><!-- open", "ac"), ("<article><p>unclosed <i>x", "unclosed x"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\nb\nc d\ne"),
    ("<article><p title='a>b'>x</p><p title=\"unbalanced>y</p></article>", "x\ny"), ("<main><p>m</p></main><p>out</p>", "m"),
    ("a < b and c > d", "a < b and c > d"), ("<article></article><p>body</p>", "body"),
    ("<div hidden>h</div><div style='display: none'>n</div><p role=alert>r</p><p>v</p>", "v"),
    ("<header>site</header><article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
    ("<script>1", ""), ("<article>x<![CDATA[ y ]]></article>", "x y"), ("</p></article>z", "z")])
def test_structure(html, want):
    assert text(html) == want


def test_deep_and_long():
    assert text("<div>" * 50000 + "x" + "</div>" * 50000) == "x"
    assert len(text("<article><p>" + "word " * 400000 + "</article>")) == 5 * 400000 - 1
    assert text("<p " + '"' * 5000 + ">" * 3) is not None


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("host", "text", "outer", "n_chars")})


def site(n, host, body):
    return [(i, f"https://{host}/p/{i}", f"<body><div><ul><li>Home</li><li>About us</li></ul></div>{body(i)}<div><p>All rights of {host}</p></div></body>")
            for i in range(n)]


def test_templates_are_deleted_without_class_names(spark):
    rows = site(30, "a.example", lambda i: f"<div><p>Story {i} begins.</p><p>It ends {i}.</p></div>")
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert got == {i: f"Story {i} begins.\nIt ends {i}." for i in range(30)}


def test_templates_are_counted_by_host(spark):
    few = site(4, "b.example", lambda i: f"<p>Page {i}</p>")  # under min_pages: nothing is deleted
    got = {r.page_id: r.text for r in extract_text(pages(spark, few)).collect()}
    assert got == {i: f"Home\nAbout us\nPage {i}\nAll rights of b.example" for i in range(4)}


def test_copies_of_an_article_are_content(spark):
    rows = site(40, "c.example", lambda i: "<article><h1>Same</h1><p>Copied paragraph.</p></article>")
    assert {r.text for r in extract_text(pages(spark, rows)).collect()} == {"Same\nCopied paragraph."}


@pytest.mark.parametrize("body", ["<div><p>First copied.</p><p>Second copied.</p></div>",
                                  "<p>First copied.</p><p>Second copied.</p>",
                                  "<section><div><p>First copied.</p></div><ul><li>Second copied.</li></ul></section>"])
def test_copies_of_a_plain_page_are_content(spark, body):
    """A third of the host; the site's own blocks are still deleted."""
    rows = site(60, "e.example", lambda i: body if i % 3 == 0 else f"<div><p>Story {i}.</p></div>")
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert got == {i: "First copied.\nSecond copied." if i % 3 == 0 else f"Story {i}." for i in range(60)}


@pytest.mark.parametrize("wrap", ["<div><p>First copied.</p><p>Second copied.</p></div>",
                                  "<section><div><h2>First copied.</h2></div><div>Second copied.</div></section>",
                                  "<ul><li>First copied.</li><li>Second copied.</li></ul>",
                                  "<table><tr><td>First copied.</td></tr><tr><td>Second copied.</td></tr></table>"])
def test_copies_in_an_article_wrapper_are_content(spark, wrap):
    """Most of the host, dates differ outside the article; the box in every
    article is still deleted."""
    box = "<div>Read our other stories</div>"
    rows = site(60, "f.example", lambda i: f"<div>Day {i}</div><article>" + (wrap if i % 3 else f"<p>Text {i}</p>") + box + "</article>")
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert got == {i: "First copied.\nSecond copied." if i % 3 else f"Text {i}" for i in range(60)}


def test_near_copies_are_content(spark):
    """The same story with one line that differs; other pages beside it.  Every case is a host."""
    wraps = ["<div>{}</div>", "<article>{}</article>", "{}", "<main><section>{}</section></main>"]
    lines = ["<p>Read {0} times on day {0}</p>", "<div>{0}</div>",
             "<p>Updated {0}: a line that is longer than all of the blocks of the story it belongs to</p>"]
    story = ["<h1>The same story</h1>", "<p>It begins with this sentence.</p>", "<div>It goes on with another one.</div>",
             "<p>It ends with the last.</p>"]
    rows, want = [], {}
    for case, (wrap, line, (n, copies)) in enumerate(itertools.product(wraps, lines, [(20, 8), (300, 200)])):
        own = site(n, f"n{case}.example", lambda i: wrap.format(
            "".join(story[:3]) + line.format(i) + story[3] if i < copies else f"<h1>Title {i}</h1><p>Other text number {i}.</p>"))
        rows += [(1000 * case + i, url, html) for i, url, html in own]
        for i in range(n):
            want[1000 * case + i] = f"Title {i}\nOther text number {i}." if i >= copies else "\n".join(
                ["The same story", "It begins with this sentence.", "It goes on with another one.",
                 Page(line.format(i)).main_text(), "It ends with the last."])
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert got == want


@pytest.mark.parametrize("box", ["<p>Get our weekly letter by mail today.</p>", "<h2>More from us</h2>", "<blockquote>Write to us</blockquote>"])
def test_paragraphs_of_all_articles_are_templates(spark, box):
    rows = site(60, "g.example", lambda i: f"<article><h1>Title {i}</h1><p>Text of its own {i}.</p>{box}</article>")
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert got == {i: f"Title {i}\nText of its own {i}." for i in range(60)}


def test_surroundings_brute_force():
    import random
    rng = random.Random(3)
    for _ in range(300):
        blocks = [(rng.randrange(1, 40), rng.randrange(1, 9), rng.randrange(4)) for _ in range(rng.randrange(12))]
        blocks = list({h: (h, h % 7 + 1, bits) for h, _, bits in blocks}.values())
        common = {h for h, _, _ in blocks if rng.random() < 0.2}
        begin = rng.randrange(len(blocks) + 1)
        end, part = rng.randrange(begin, len(blocks) + 1), rng.randrange(3)
        left = sorted(((n, h) for k, (h, n, bits) in enumerate(blocks)
                       if not begin <= k < end and h not in common and (part == 0 or bits & part)), reverse=True)[:3]
        ids = [h for _, h in left]
        want = [sum(ids)] + (ids if len(ids) > 1 else [])
        assert surroundings(blocks, [(part, begin, end)], common) == [want]


def test_inner_boxes(spark):
    rows = site(40, "d.example", lambda i: f"<article><p>Text {i}</p><div>Read our other stories</div></article>")
    assert {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()} == {i: f"Text {i}" for i in range(40)}


def test_counts_against_brute_force(spark):
    rows = [r for k, h in enumerate(["x.example", "y.example"]) for r in
            [(100 * k + i, u, b) for i, u, b in site(12 + k, h, lambda i: f"<div><p>{i % 3}</p></div>")]]
    got = {r.host: set(r.outer) for r in site_templates(pages(spark, rows), Thresholds(5, 0.4)).collect()}
    want = {}
    for host in ("x.example", "y.example"):
        own = [Page(b).seen for _, u, b in rows if host in u]
        want[host] = {h for h, _ in set().union(*own)
                      if (n := sum((h, False) in s for s in own)) >= 5 and n >= 0.4 * len(own)}
    assert got == want


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "http://h/x", "<p>n"), (3, "http://h/x", "<p>r"), (3, "http://h/x", "<p>r")]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract_text(pages(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (None, "http://h/x", "n", 1), (3, "http://h/x", "r", 1),
                          (3, "http://h/x", "r", 1)], key=repr)
    assert extract_text(pages(spark, [])).collect() == []


def test_hosts(spark):
    df = spark.createDataFrame([("https://User:p@WWW.Example.com:80/a?b",), ("//h.org/x",), ("nonsense",), (None,)], "u string")
    assert [r[0] for r in df.select(host_of(F.col("u"))).collect()] == ["www.example.com", "h.org", "", ""]


def test_query_returns_article_paragraphs(spark):
    """The given pages wrap paragraphs in one article: compare with a plain reading."""
    import html
    import re
    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split())
                 for b in re.split(r"</?(?:p|h1)>|<br>", inner)]
        want[r.page_id] = "\n".join(p for p in parts if p)
    got = {r.page_id: r.text for r in queries.QUERIES["op1_html_text"](spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("piece", ["<a ", "<p '", '<a "\'>', "<a<", "<!", "</p ", "<p title=\"x>"])
def test_unclosed_markup_is_linear(piece):
    import time
    html = "<p>first</p>" + piece * (1_000_000 // len(piece))
    t = time.perf_counter()
    page = Page(html)
    assert time.perf_counter() - t < 10 and page is not None


def test_unfinished_tag_is_no_text(spark):
    df = spark.createDataFrame([(1, "http://a/x", "<p>hello <b"), (2, "http://a/y", "<p>a < b</p><p title='>'>c</p><p x=\">d</p>")],
                               "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    assert got == {1: "hello", 2: "a < b\nc\nd"}
