"""Page expressions: title, links, link properties and the article body, one row in, one row out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import _column, bind

TAG_NAME = "[a-zA-Z][-_.a-zA-Z0-9]*"
COMMENT = r"(?s)<!--.*?--\s*>"
ANY_TAG = r"</?[a-zA-Z][^<>]*>|<[!?][^<>]*>"
TITLE = r"(?is)<title[^<>]*>(.*?)</title>"
ANCHOR = r'<a href="[^"]*">[^<]*</a>'
REFERENCE = r"&[a-zA-Z][-.a-zA-Z0-9]*;?|&#[0-9]+;?|[^&]+|&"


@dataclass(frozen=True)
class BodyRule:
    """Where an article body is: the container tag, an attribute it must carry, and whether a
    script inside a paragraph ends the paragraph."""

    tag: str = "div"
    attribute: str | None = None
    value: str | None = None
    stop_on_script: bool = False


BODY_RULES = {
    site: BodyRule("div", *fixed.BODY_CONTAINER[site], stop_on_script=site == "ZXW")
    for site in fixed.SITES
}
ARTICLE_RULE = BodyRule("article")


def decode_references(text: Column) -> Column:
    """Character references to text: the five basic names and ASCII numbers; others are dropped."""
    def decode(piece: Column) -> Column:
        name = F.regexp_replace(piece, "[&;]", "")
        number = F.regexp_extract(piece, "([0-9]+)", 1).try_cast("int")
        chain = F.when(
            piece.startswith("&#"),
            F.when(number.between(1, 127), F.char(number)).otherwise(F.lit("")),
        )
        for known, char in fixed.NAMED_REFERENCES.items():
            chain = chain.when(name == known, F.lit(char))
        return F.when(
            piece.startswith("&") & (F.length(piece) > 1), chain.otherwise(F.lit(""))
        ).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")
    ).otherwise(text)


def page_title(html: Column | str) -> Column:
    return decode_references(F.regexp_extract(_column(html), TITLE, 1))


def article_body(html: Column | str, rule: BodyRule = ARTICLE_RULE) -> Column:
    """Text of the paragraphs inside the container, inline tags removed, pieces joined unseparated.

    Nested containers are counted, so the body ends where the outer one closes. A paragraph ends
    at its end tag only. The page is cut at the tags that matter; a fold over those tags (not over
    the text) decides which pieces between them are kept.
    """
    html = F.regexp_replace(_column(html), COMMENT, "")
    mark = rf"(?i)</?(?:{rule.tag}|p|script)(?:[^-_.a-zA-Z0-9<>][^<>]*)?>"
    opens = F.lit(True)
    if rule.attribute:
        quoted = "|".join(rf"{q}\Q{rule.value}\E{q}" for q in ("\"", "'"))
        has = rf"\s(?i:{rule.attribute})\s*=\s*(?:{quoted}|\Q{rule.value}\E(?=[\s>]))"

    def step(state: Column, tag: Column) -> Column:
        name = F.lower(F.regexp_extract(tag, f"^</?({TAG_NAME})", 1))
        closing = tag.startswith("</")
        container = name == rule.tag
        matches = tag.rlike(has) if rule.attribute else opens
        level, grab = state["level"], state["grab"]
        new_level = (
            F.when(container & closing, F.greatest(level - 1, F.lit(0)))
            .when(container & ((level > 0) | matches), level + 1)
            .otherwise(level)
        )
        new_grab = F.when((name == "p") & closing, F.lit(False)).when(
            (name == "p") & (level > 0), F.lit(True)
        )
        if rule.stop_on_script:
            new_grab = new_grab.when((name == "script") & ~closing, F.lit(False))
        new_grab = new_grab.otherwise(grab)
        return bind(
            F.struct(new_level.alias("level"), new_grab.alias("grab")),
            lambda s: F.struct(
                s["level"].alias("level"),
                s["grab"].alias("grab"),
                F.concat(
                    state["kept"], F.when(s["grab"], F.lit("1")).otherwise(F.lit("0"))
                ).alias("kept"),
            ),
        )

    def keep(parts: Column) -> Column:
        folded = F.aggregate(
            parts["marks"],
            F.struct(
                F.lit(0).alias("level"), F.lit(False).alias("grab"), F.lit("0").alias("kept")
            ),
            step,
            lambda s: F.split(s["kept"], ""),
        )
        chosen = bind(
            folded, lambda kept: F.filter(parts["pieces"], lambda _, i: F.get(kept, i) == "1")
        )
        return F.array_join(
            F.transform(chosen, lambda p: decode_references(F.regexp_replace(p, ANY_TAG, ""))), ""
        )

    def cut(page: Column) -> Column:
        return F.struct(
            F.regexp_extract_all(page, F.lit(mark), F.lit(0)).alias("marks"),
            F.split(page, mark).alias("pieces"),
        )

    return bind(bind(html, cut), keep)


def site_body(site: Column, html: Column | str, rules: dict[str, BodyRule] = BODY_RULES) -> Column:
    """``article_body`` with the rule of the row's site; null for an unknown site."""
    chain = None
    for name, rule in rules.items():
        chain = (chain.when if chain is not None else F.when)(
            site == name, article_body(html, rule)
        )
    return chain


def links(html: Column | str, pattern: str = ANCHOR) -> Column:
    """Every match of a link pattern, in page order."""
    return F.regexp_extract_all(_column(html), F.lit(pattern), F.lit(0))


def site_links(site: Column, html: Column | str) -> Column:
    chain = None
    for name, pattern in fixed.LINK_PATTERN.items():
        chain = (chain.when if chain is not None else F.when)(site == name, links(html, pattern))
    return chain


def anchor_properties(anchor: Column) -> Column:
    """``struct<href, anchor>`` of a plain anchor element."""
    return F.struct(
        F.regexp_extract(anchor, 'href="([^"]*)"', 1).alias("href"),
        F.regexp_extract(anchor, ">([^<]*)<", 1).alias("anchor"),
    )


def absolute_url(href: Column, base: Column) -> Column:
    return F.when(F.substring(href, 1, 4) != "http", F.concat(base, href)).otherwise(href)


def link_properties(site: Column, match: Column, day: Column) -> Column:
    """``struct<title, url, time>`` of one roll-page match; ``day`` is the page's date.

    The time is text. RMW lists carry only the day; its clock time comes from the article page
    (``article_clock``).
    """
    date = F.date_format(day, "yyyy-MM-dd")
    quoted = F.split(match, '"')

    def take(pattern: str, group: int) -> Column:
        return F.regexp_extract(match, pattern, group)

    def fields(title: Column, url: Column, time: Column) -> Column:
        return F.struct(title.alias("title"), url.alias("url"), time.alias("time"))

    zxw = r'<a href=.([^<>]*).>([^<>]*)</a></div><div class="dd_time">\S+ (\d{2}:\d{2})<'
    rmw = r"^<a href=.([^\s<>]*).(?:\s[^<>]*)?>([^<>]*)</a>"
    ifeng = r'<h4>\S+ (\d{2}:\d{2})</h4><a [^<>"]*"([^<>"]*)"[^<>]*>([^<>]*)$'
    return (
        F.when(site == "ZXW", fields(
            take(zxw, 2), take(zxw, 1), F.concat(date, F.lit(" "), take(zxw, 3), F.lit(":00"))))
        .when(site == "RMW", fields(take(rmw, 2), take(rmw, 1), date))
        .when(site == "163", fields(F.get(quoted, 2), F.get(quoted, 6), F.get(quoted, 10)))
        .when(site == "SINA", fields(
            F.get(quoted, 1), F.get(quoted, 3),
            F.from_unixtime(F.right(F.get(quoted, 4), F.lit(10)).try_cast("bigint"),
                            "yyyy-MM-dd HH:mm:ss")))
        .when(site == "IFENG", fields(
            take(ifeng, 3), take(ifeng, 2),
            F.concat(date, F.lit(" "), take(ifeng, 1), F.lit(":00"))))
    )


def article_clock(html: Column | str) -> Column:
    """The first ``HH:MM`` standing before a tag in an article page, as ``HH:MM:00``."""
    clock = F.regexp_extract(_column(html), r"(\d{2}:\d{2})<", 1)
    return F.when(clock != "", F.concat(clock, F.lit(":00")))


def all_pages_url(url: Column, html: Column | str, mark: str = fixed.ALL_PAGES_MARK) -> Column:
    """Address of the one-page form when the page links to it, else the address itself."""
    return F.when(
        F.contains(_column(html), F.lit(mark)),
        F.concat(F.substring(url, F.lit(1), F.greatest(F.length(url) - 5, F.lit(0))), F.lit(mark)),
    ).otherwise(url)

