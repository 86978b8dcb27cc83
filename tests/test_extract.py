"""Pages, links, dates and charsets on hand-made input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import charset, dates, html
from broadsheet.operators import extract

DAY = dt.date(2015, 11, 2)
BODY = (
    "<p>A<b>B</b></p>no<div><p>C &amp; D&nbsp;&#65;</p></div>"
    "<P class=x>E<script>s</script>t</P><!-- <p>hidden</p> --><p>F</p>"
)


def page(container):
    return f"<html><div id=other><p>no</p></div>{container}{BODY}</div><p>no</p></html>"


PAGES = {
    "ZXW": page('<div class="left_zw" style="x">'),
    "163": page("<div id='endText'>"),
    "RMW": page("<DIV ID=p_content>"),
    "SINA": page('<div class=y id="artibody">'),
    "IFENG": page('<div id = "main_content">'),
}


@pytest.mark.parametrize("site", PAGES)
def test_article_body(spark, site):
    rows = spark.createDataFrame([(site, PAGES[site])], "site string, html string")
    body = rows.select(html.site_body(F.col("site"), F.col("html"))).first()[0]
    assert body == ("ABC & DAEF" if site == "ZXW" else "ABC & DAEstF")


def test_body_ends_with_its_container_and_wrong_value_does_not_match(spark):
    rows = spark.createDataFrame([
        (0, '<div class="left_zw2"><p>x</p></div>'),
        (1, '<div class="left_zw"><div><div><p>a</p></div></div><p>b</p></div><div><p>c</p></div>'),
        (2, '<div class="left_zw"><p>open</div> still <i>open</i></p><p>no</p>'),
        (3, "no tags"),
    ], "i int, html string")
    got = rows.orderBy("i").select(html.article_body("html", html.BODY_RULES["ZXW"])).collect()
    assert [r[0] for r in got] == ["", "ab", "open still open", ""]


ROLL = {
    "ZXW": '<div class="dd_bt"><a href="/gn/1.shtml">头条</a></div>'
           '<div class="dd_time">11-2 08:30</div>'
           '<div class="dd_bt"><a href="http://x.cn/2">B</a></div><div class="dd_time">11-2 09:00</div>',
    "RMW": "<a href='http://p.cn/1.html' target=_blank>人民</a>[11月02日&nbsp;08:30]<br>",
    "163": '{"t":"今天","l":"http://n.cn/1","p":"2015-11-02 08:30:15"},'
           '{"t":"昨天","l":"http://n.cn/2","p":"2015-11-01 08:30:15"}',
    "SINA": '{channel : {x},title : "新浪",url : "http://s.cn/1",time : 1446453000}',
    "IFENG": '<h4>11/02 08:30</h4><a href="http://news.ifeng.com/a/1" target="_blank">凤凰</a>'
             '<h4>11/02 08:31</h4><a href="http://news.ifeng.com/photo/2" target="_blank">图</a>',
}


def test_roll_links_of_every_site(spark):
    pages = spark.createDataFrame([(s, DAY, h) for s, h in ROLL.items()],
                                  "site string, day date, html string")
    empty = pages.filter("site = 'IFENG'").withColumn(
        "html", F.concat(F.lit('<div class="mat">none</div>'), "html"))
    links = extract.roll_links(pages.unionByName(empty))
    got = {(r.site, r.title, r.url, r.time) for r in links.collect()}
    assert got == {
        ("ZXW", "头条", "http://www.chinanews.com/gn/1.shtml", "2015-11-02 08:30:00"),
        ("ZXW", "B", "http://x.cn/2", "2015-11-02 09:00:00"),
        ("RMW", "人民", "http://p.cn/1.html", "2015-11-02"),
        ("163", "今天", "http://n.cn/1", "2015-11-02 08:30:15"),
        ("SINA", "新浪", "http://s.cn/1", "2015-11-02 08:30:00"),
        ("IFENG", "凤凰", "http://news.ifeng.com/a/1", "2015-11-02 08:30:00"),
    }
    assert {r.site for r in extract.allowed_sites(links).collect()} == {"ZXW"}


def test_malformed_entry_is_skipped(spark):
    pages = spark.createDataFrame([("163", DAY, '{"t":"broken"},' + ROLL["163"])],
                                  "site string, day date, html string")
    assert [r.title for r in extract.roll_links(pages).collect()] == ["今天"]


def test_articles_from_links(spark):
    links = spark.createDataFrame([
        ("163", DAY, 0, "http://n.cn/1.html", "paged", "2015-11-02 08:00:00"),
        ("RMW", DAY, 0, "http://p.cn/1", "clock", "2015-11-02"),
        ("RMW", DAY, 1, "http://p.cn/2", "no clock", "2015-11-02"),
        ("ZXW", DAY, 0, "http://z.cn/1", "missing page", "2015-11-02 08:00:00"),
    ], "site string, day date, pos int, url string, title string, time string")
    pages = spark.createDataFrame([
        ("http://n.cn/1.html", '<a href="x_all.html#p1">'),
        ("http://n.cn/1_all.html#p1", '<div id="endText"><p>whole</p></div>'),
        ("http://p.cn/1", '<b>09:15</b><div id="p_content"><p>body</p></div>'),
        ("http://p.cn/2", '<div id="p_content"><p>body</p></div>'),
    ], "url string, html string")
    got = {(r.url, r.time, r.content) for r in extract.articles_from_links(links, pages).collect()}
    assert got == {
        ("http://n.cn/1_all.html#p1", "2015-11-02 08:00:00", "whole"),
        ("http://p.cn/1", "2015-11-02 09:15:00", "body"),
    }


def test_every_entry_is_an_article_or_a_reject(spark):
    entry = '{{"t":"{}","l":"{}","p":"{}"}}'
    listed = [("one", "http://n.cn/1.html", "2015-11-02 08:00:00"), ("paged", "http://n.cn/2.html", "2015-11-02 09:00:00"),
              ("old", "http://n.cn/3.html", "2015-11-01 09:00:00"), ("gone", "http://n.cn/4.html", "2015-11-02 09:30:00"),
              ("half", "http://n.cn/5.html", "2015-11-02 10:00:00"), ("bare", "", "2015-11-02 10:30:00")]
    rolls = spark.createDataFrame([
        ("163", DAY, "".join(entry.format(*e) for e in listed)),
        ("RMW", DAY, "<a href='http://p.cn/1' target=_blank>clock</a>[11月02日&nbsp;09:15]<br>"
                     "<a href='http://p.cn/2' target=_blank>none</a>[11月02日&nbsp;09:15]<br>"),
        ("IFENG", DAY, '<h4>11/02 10:00</h4><a href="http://news.ifeng.com/photo/1" target="_blank">p</a>'),
        ("ZXW", DAY, None), ("SINA", DAY, ""),
    ], "site string, day date, html string")
    body = '<div id="endText"><p>text</p></div>'
    pages = spark.createDataFrame([
        ("http://n.cn/1.html", body), ("http://n.cn/2.html", '<a href="x_all.html#p1">'),
        ("http://n.cn/2_all.html#p1", body), ("http://n.cn/3.html", body), ("http://n.cn/5.html", "_all.html#p1"),
        ("http://p.cn/1", '<b>09:15</b><div id="p_content"><p>body</p></div>'), ("http://p.cn/2", "<p>x</p>"),
    ], "url string, html string")
    articles, rejects = extract.ingest(rolls, pages)
    assert {(r.url, r.time, r.content) for r in articles.collect()} == {
        ("http://n.cn/1.html", "2015-11-02 08:00:00", "text"), ("http://n.cn/2_all.html#p1", "2015-11-02 09:00:00", "text"),
        ("http://p.cn/1", "2015-11-02 09:15:00", "body")}
    assert {(r.title, r.reason) for r in rejects.collect()} == {
        ("old", "other day"), ("gone", "no page"), ("half", "no page"), ("bare", "no address"), ("none", "no time"),
        ("p", "photo news")}
    assert articles.count() + rejects.count() == extract.roll_entries(rolls).count() == 9
    assert [x.count() for x in extract.ingest(rolls.limit(0), pages)] == [0, 0]


@pytest.mark.parametrize("args, expected", [
    (("today",), ("2015-11-02", "2015-11-03")),
    (("last30",), ("2015-10-04", "2015-11-03")),
    (("day", "2015-11-01"), ("2015-11-01", "2015-11-02")),
    (("between", "2015-11-01", "2015-11-02"), ("2015-11-01", "2015-11-03")),
    (("days", "2015-11-01", "5"), ("2015-11-01", "2015-11-06")),
])
def test_date_windows(args, expected):
    assert tuple(map(str, dates.date_window(*args, today=DAY))) == expected


@pytest.mark.parametrize("args", [
    ("day", "2015-1-01"), ("between", "2015-11-01", "soon"), ("days", "2015-11-01", "x"), ("week",),
])
def test_bad_date_arguments(args):
    with pytest.raises(ValueError):
        dates.date_window(*args)


def test_date_range_is_half_open(spark):
    bounds = spark.createDataFrame(
        [(DAY, dt.date(2015, 11, 4)), (DAY, DAY), (DAY, dt.date(2015, 10, 1))],
        "start date, end date")
    assert [r.day for r in extract.date_range(bounds).orderBy("day").collect()] == [
        DAY, dt.date(2015, 11, 3)]


def test_default_site_and_page_number(spark):
    days = spark.createDataFrame([(DAY,)], "day date")
    assert extract.roll_page_urls(days).first().url == (
        "http://www.chinanews.com/scroll-news/2015/1102/news.shtml")
    paged = extract.roll_page_urls(days, ["IFENG"], page=7).first().url
    assert paged == "http://news.ifeng.com/rt-channel/rtlist_20151102/7.shtml"


def test_take_until_empty(spark):
    pages = spark.createDataFrame(
        [("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", 1, False), ("c", 1, True),
         (None, 1, False), (None, 2, True)],
        "site string, page int, none boolean")
    kept = extract.take_until_empty(pages, ["site"], "page", F.col("none")).collect()
    assert {(r.site, r.page) for r in kept} == {("a", 1), ("b", 1), (None, 1)}


def test_charset(spark):
    raw = spark.createDataFrame(
        [(1, bytearray("新闻".encode("gb2312"))), (2, bytearray(b"ok \xff bad")),
         (3, bytearray(b"ascii"))], "id int, data binary")
    got = {r.id: r.html for r in charset.decode_pages(raw).collect()}
    assert got == {1: "新闻", 3: "ascii"}
    texts = spark.createDataFrame([("a新€闻ñ𠀀z?",)], "text string")
    stored = charset.encode_text(texts, "text", "data").first().data
    assert bytes(stored).decode("gb2312") == "a新闻z?"
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
