import html
import re
import time

from broadsheet.llm import html_template as h
from broadsheet.llm.queries import QUERIES


def slow_text(page):
    """What the pages of the test tables hold: everything between the article's tags."""
    inner = page[page.index("<article>") + 9: page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    plain = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks)
    return "\n".join(b for b in plain if b)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op5_html"](spark, folder).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert r.text == slow_text(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<form><p>Search</p><input value=">"></form><!-- <article>no</article> -->
<article class='post'><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text {n}<p>Second
 line<br>same&#8212;block<div class="ad-box">Buy</div><aside>Side</aside><p>Third <a href="x>y">link</a></p>
<section id="comments"><p>Nice!</p></section></article><footer>Foot {n}</footer></body>"""
EXPECTED = "Title & more\nFirst bold text {n}\nSecond line same—block\nThird link"


def test_semantic_page():
    assert h.main_text(PAGE.format(n=1)) == EXPECTED.format(n=1)
    for broken in ("", "no markup", "<p>a", "<article><p>a<b>c", "<<<>>", "<script>x", "<!-- x", "</p></div>a", "<p title='x"):
        h.main_text(broken)
    assert h.main_text("plain &lt;b&gt; text") == "plain <b> text"


PLAIN = """<html><body><div><span>My site</span><span>Sponsored by us</span></div><div><h2>Story {n}</h2><p>Body {n} of it</p>{more}</div>
<div><p>All our stories</p></div></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string, token long")


def test_template_removes_what_a_host_repeats(spark):
    rows = [(i, f"http://A.example.com/{i}", PLAIN.format(n=i, more="<p>Extra</p>" * (i % 3)), "h", "t", 1) for i in range(30)]
    found = {r.page_id: r.text for r in h.extract(pages(spark, rows)).select("row.page_id", "text").collect()}
    for i in range(30):
        assert found[i] == "\n".join([f"Story {i}", f"Body {i} of it", *["Extra"] * (i % 3)])


def test_template_by_brute_force(spark):
    rows = [(i, "http://a.example.com/x", PLAIN.format(n=i, more=""), "h", "t", 1) for i in range(5)]
    template = h.deduce(h.with_host(pages(spark, rows))).collect()
    assert len(template) == 1 and template[0].host == "a.example.com"
    streams = [[h._hash(t.key) for t in h.tokens(r[2])] for r in rows]
    once = [k for k in streams[0] if all(s.count(k) == 1 for s in streams)]
    assert template[0].frame == once


def test_an_article_is_not_taken_for_a_template(spark):
    rows = [(i, "http://a.example.com/x", PAGE.format(n=1), "h", "t", 1) for i in range(20)]
    assert {r.text for r in h.extract(pages(spark, rows)).collect()} == {EXPECTED.format(n=1)}


def test_edge_cases_and_both_joins(spark, monkeypatch):
    rows = [(1, None, None, "h", "t", 1), (2, "x", "", "h", "t", 1), (None, "http://a.example.com", "<p>a</p>", "h", "t", 1),
            (3, "http://b.example.com/", "<article>" + "<p>w x</p>" * 50_000, "h", "t", 1)]
    rows += [(10 + i, f"http://A.example.com/{i}", PLAIN.format(n=i, more=""), "h", "t", 1) for i in range(6)] * 2
    df = pages(spark, rows)

    def run():
        return sorted(((r.page_id, r.text) for r in h.extract(df).select("row.page_id", "text").collect()), key=str)

    first = run()
    assert len(first) == 16 and (1, "") in first and (2, "") in first and (3, "\n".join(["w x"] * 50_000)) in first
    monkeypatch.setattr(h, "broadcast_within", lambda *a: None)
    assert run() == first
    assert h.extract(df.limit(0)).count() == 0


ARTICLE = """<html><body class="has-sidebar"><div>Top</div><article class='post format-notice'><h1>Story {n}</h1><div>Read our terms</div>
<p>Body {n} of it</p>{more}<span>All rights reserved</span></article><div>Bottom</div></body></html>"""


def test_template_removes_repeated_blocks_of_articles(spark):
    rows = [(i, f"http://a.example.com/{i}", ARTICLE.format(n=i, more="<p>Extra</p>" * (i % 3)), "h", "t", 1) for i in range(30)]
    found = {r.page_id: r.text for r in h.extract(pages(spark, rows)).select("row.page_id", "text").collect()}
    for i in range(30):
        own = [f"Story {i}", f"Body {i} of it", *["Extra"] * (i % 3)]
        assert found[i] == "\n".join(own)
        # without the template the host's blocks stay
        assert h.main_text(rows[i][2]) == "\n".join([own[0], "Read our terms", *own[1:], "All rights reserved"])


def test_copies_of_an_article_stay_whole_in_changing_pages(spark):
    rows = [(i, f"http://a.example.com/{i}", ARTICLE.format(n=i % 2, more="").replace("Top", f"Top {i}"), "h", "t", 1) for i in range(30)]
    found = {r.page_id: r.text for r in h.extract(pages(spark, rows)).select("row.page_id", "text").collect()}
    assert all(found[i] == f"Story {i % 2}\nRead our terms\nBody {i % 2} of it\nAll rights reserved" for i in range(30))


def test_markup_of_hostile_pages():
    assert h.main_text('<body class="has-sidebar"><main><article><p>Real text here.</p>') == "Real text here."
    assert h.main_text("<article class='post format-notice'><p>Real text.</p></article>") == "Real text."
    assert h.main_text("<article><p>a</p></article><article class='comment odd'><p>no</p></article>") == "a"
    assert h.main_text("<p title=Bob's>One two.</p><p>It's three.</p><p>Four.</p>") == "One two.\nIt's three.\nFour."
    assert h.main_text('<p title=a="b>c</p><p x = "y>z" w=\'>\'>d</p><p "e">f</p>') == "c\nd\nf"
    assert h.main_text("<p title='x>y") == "y"
    assert h.main_text("<p>one<div>two<p>three<li>four<li>five</div>six") == "one\ntwo\nthree\nfour\nfive\nsix"


def test_work_grows_with_the_length():
    began = time.process_time()
    n = 100_000
    assert h.main_text("<b>" * n + "</i>" * n + "x") == "x"
    assert h.main_text("<p><div>" + "<b>" * n + "<p></p>" * n + "x") == "x"
    for unclosed in ("<p a='" * n, '<p a="' * n + "<p b='" * n, "<p a= " * n, "<p a=''" * n):
        h.main_text(unclosed + "x")
    assert time.process_time() - began < 30
