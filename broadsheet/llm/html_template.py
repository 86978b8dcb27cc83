"""Main text of pages by equivalence-class template deduction.

A page is a list of tokens: tags with their path of element names, and runs of text with theirs.
Tokens that occur equally often on each page of a host share an occurrence vector; vectors are
compared by a digest, so no host's pages are gathered. A group of tokens with one vector that at
least ``SUPPORT`` of the host's pages have is an equivalence class; it is valid if its tokens stand in
one order on all of them. The class that has each token once a page is the template's frame, valid
classes that always lie in one slot of the frame are nested in it. What lies between the frame's
tokens are slots. The main text is what remains in the slots inside article or main elements, or, on
a page without them, in all slots outside menus, adverts and the like: texts of the frame and of
nested classes that the host repeats on nearly all pages are the template's and go. Inside articles
they go only if nearly all the host's articles differ, so that copies of one article are not taken
for a template. Pages that miss the frame, and hosts with too few pages, are cut by element names alone.

Markup is read as the HTML standard reads it: quotes delimit a value only right after its equals sign,
and ``a <b and c> d`` holds a tag. The work on a page grows with its length, however deep it is nested.

Templates are small: a token of a class is on at least ``SUPPORT`` of the host's pages. They are
broadcast inside checked bounds and otherwise joined with salted hosts.

Edge cases: null pages are empty and have empty text; a null or strange url is the host ''; repeated
rows are pages of their own; unclosed elements end with the page.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import broadcast_within, written

SUPPORT, MIN_PAGES = 0.5, 3
#: A nested class's texts are template texts if it is on this share of the host's pages.
REPEATED = 0.9
SALTS = 32

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)*)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)""")
_PARTS = re.compile(r"[a-z0-9]+")

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that the start of another one ends: itself and those that may not hold it.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
MAIN = {"article", "main"}
#: Elements, roles and words in class or id that are not main text (fixed values).
ASIDE = set("aside button dialog footer form head header menu nav noscript script select style svg template textarea "
            "iframe title xmp noembed noframes".split())
ASIDE_ROLES = set("banner complementary contentinfo form menu navigation search".split())
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header menu modal nav navbar navigation newsletter notice notices popup promo respond share sharing "
    "sidebar social sponsor sponsored subscribe".split())
#: These are not aside for a word in a longer class name, articles only as a whole one of theirs.
WHOLE = {"html", "body", "main", "article"}
ARTICLE_WORDS = set("ad ads advert advertisement comment promo sponsored".split())


def _aside(name: str, attributes: str) -> bool:
    if name in ASIDE:
        return True
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.lower()
        if name in WHOLE:
            if name == "article" and key == "class" and set(value.strip("\"'").split()) & ARTICLE_WORDS:
                return True
            continue
        words = set(_PARTS.findall(value))
        if key in ("class", "id") and words & ASIDE_WORDS or key == "role" and words & ASIDE_ROLES:
            return True
    return False


class Token:
    """A tag or text: its key, whether it is text, its main and aside depth and its content."""

    __slots__ = ("key", "text", "main", "aside", "block")

    def __init__(self, key: str, text: str | None, main: bool, aside: bool, block: bool) -> None:
        self.key, self.text, self.main, self.aside, self.block = key, text, main, aside, block


def tokens(page: str) -> Iterator[Token]:
    """The tokens of a page in order; work grows with its length."""
    stack: list[tuple[str, bool, bool, int]] = []  # name, in main, aside, place of the nearest block
    open_at: defaultdict[str, list[int]] = defaultdict(list)  # places of the open elements of a name

    def state() -> tuple[bool, bool]:
        return stack[-1][1:3] if stack else (False, False)

    def path() -> str:
        return "/".join(name for name, *_ in stack[-6:])

    def close(place: int) -> None:
        while len(stack) > place:
            open_at[stack.pop()[0]].pop()

    def words(raw: str) -> Iterator[Token]:
        if text := html.unescape(raw):
            yield Token(f"{path()}|{' '.join(text.split())}", text, *state(), False)

    at = 0
    while m := _MARKUP.search(page, at):
        if m.start() > at:
            yield from words(page[at: m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if open_at[name]:
                close(open_at[name][-1] + 1)
                yield Token(f"{path()}>", None, *state(), name in BLOCKS)
                close(len(stack) - 1)
            elif name in BLOCKS:
                yield Token(f"{path()}/{name}>?", None, *state(), True)
            continue
        if ended := ENDS.get(name):
            place = max((open_at[n][-1] for n in ended if open_at[n]), default=-1)
            if place >= 0 and place >= stack[-1][3]:
                close(place)
        main, aside = state()
        block = len(stack) if name in BLOCKS else stack[-1][3] if stack else -1
        stack.append((name, main or name in MAIN, aside or _aside(name, m[3]), block))
        open_at[name].append(len(stack) - 1)
        yield Token(f"{path()}<", None, *state(), name in BLOCKS)
        if name in VOID or m[3].endswith("/"):
            close(len(stack) - 1)
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if stop > at:
                yield Token(f"{path()}|raw", "", *state(), False)
            at = stop
    if at < len(page):
        yield from words(page[at:])


def _hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "replace")) - (1 << 63)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            hosts, places, mains, keys, counts, firsts = [], [], [], [], [], []
            part = batch.slice(at, 256)
            for host, place, page in zip(*(part.column(k) for k in range(3))):
                host, place, page = host.as_py(), place.as_py(), page.as_py()
                seen: dict[int, list[int]] = {}
                found = list(tokens(page))
                for n, token in enumerate(found):
                    if (own := seen.get(key := _hash(token.key))) is None:
                        seen[key] = [1, n]
                    else:
                        own[0] += 1
                hosts += [host] * len(seen)
                places += [place] * len(seen)
                mains += [_hash(_joined(t for t in found if t.text is None or t.main and not t.aside))] * len(seen)
                keys += seen
                counts += [c for c, _ in seen.values()]
                firsts += [f for _, f in seen.values()]
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(places, pa.int64()), pa.array(mains, pa.int64()),
                                   pa.array(keys, pa.int64()), pa.array(counts, pa.int32()), pa.array(firsts, pa.int32())],
                                  ["host", "place", "main", "token", "n", "first"])


def with_host(pages: DataFrame) -> DataFrame:
    """``pages`` in a struct ``row``, beside it ``host``, ``html`` and a ``place`` to tell rows."""
    return pages.select(
        F.struct("*").alias("row"),
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)).alias("host"),
        F.coalesce("html", F.lit("")).alias("html"))


def deduce(pages: DataFrame) -> DataFrame:
    """Templates ``host, frame, repeated, varied`` of ``pages(host, html)``: token digests in order.

    ``varied`` says that nearly all main texts of the host differ.

    Writes the tokens' occurrences to the shared folder when called.
    """
    seen = written(
        pages.select("host", F.monotonically_increasing_id().alias("place"), "html")
        .mapInArrow(_occurrences, "host string, place long, main long, token long, n int, first int"), "tokens")
    # written first: its size is known when the vectors meet it, so a hot host isn't dealt to one task
    sizes = written(
        seen.groupBy("host", "place").agg(F.max("main").alias("main")).groupBy("host", "main")
        .agg(F.count("*").alias("pages")).groupBy("host")
        .agg(F.sum("pages").alias("pages"), F.count("*").alias("articles")), "hosts")
    vectors = seen.groupBy("host", "token").agg(
        F.count("*").alias("support"), F.max("n").alias("most"),
        F.bit_xor(F.xxhash64("place", "n")).alias("vector"))
    common = vectors.join(sizes, "host").where(
        (F.col("pages") >= MIN_PAGES) & (F.col("support") >= F.greatest(F.lit(MIN_PAGES), F.col("pages") * SUPPORT)))
    common = written(common, "classes")
    # order of the tokens of a class on each page that has it
    on_page = (
        seen.join(common.select("host", "token", "vector", "support", "most", "pages"), ["host", "token"])
        .groupBy("host", "place", "vector", "support", "pages").agg(
            F.max("most").alias("most"), F.array_sort(F.collect_list(F.struct("first", "token"))).alias("list"))
        .withColumn("order", F.col("list.token")))
    orders = on_page.groupBy("host", "vector").agg(
        F.first("support").alias("support"), F.first("pages").alias("pages"), F.max("most").alias("most"),
        F.min(F.xxhash64("order")).alias("one"), F.max(F.xxhash64("order")).alias("other"), F.max("order").alias("order"))
    valid = written(orders.where("one = other"), "valid-classes")
    frames = (
        valid.where("most = 1").groupBy("host")
        .agg(F.max_by(F.struct("vector", "order"), F.struct("support", F.size("order"), "vector")).alias("best"))
        .select("host", F.col("best.vector").alias("frame_vector"), F.col("best.order").alias("frame")))
    # a class is nested if its first token always follows the same token of the frame
    starts = on_page.select("host", "place", "vector", F.col("list")[0]["first"].alias("at"), F.col("list.first").alias("firsts"))
    frame_at = starts.join(frames.select("host", F.col("frame_vector").alias("vector")), ["host", "vector"]).select(
        "host", "place", F.col("firsts").alias("edges"))
    nested = (
        starts.join(frame_at, ["host", "place"]).select(
            "host", "vector", F.size(F.filter("edges", lambda e: e <= F.col("at"))).alias("slot"))
        .groupBy("host", "vector").agg(F.min("slot").alias("a"), F.max("slot").alias("b")).where("a = b")
        .join(valid.where(F.col("support") >= REPEATED * F.col("pages")).select("host", "vector", "order"), ["host", "vector"])
        .groupBy("host").agg(F.flatten(F.collect_list("order")).alias("repeated")))
    varied = sizes.select("host", (F.col("articles") >= REPEATED * F.col("pages")).alias("varied"))
    return frames.join(nested, "host", "left").join(varied, "host").select(
        "host", "frame", F.coalesce("repeated", F.array().cast("array<bigint>")).alias("repeated"), "varied")


def main_text(page: str, frame: list[int] | None = None, repeated: frozenset[int] | set[int] = frozenset(),
              varied: bool = False) -> str:
    """The blocks of the main slots of a page, joined by line breaks."""
    found = list(tokens(page))
    any_main = any(t.main for t in found)
    kept = [t for t in found if t.text is None or not t.aside and (t.main or not any_main)]
    if frame and (varied or not any_main):
        keys = map(_hash, (t.key for t in found))
        if all(wanted in keys for wanted in frame):  # in the frame's order
            kept = [t for t in kept if t.text is None or _hash(t.key) not in repeated]
    return _joined(kept)


def _joined(kept: Iterable[Token]) -> str:
    """Texts of tokens: one line a block, with single spaces."""
    blocks, words = [], []
    for token in kept:
        if token.text is not None:
            words.append(token.text)
        elif token.block and words:
            blocks.append(" ".join("".join(words).split()))
            words = []
        elif not token.block and token.key.endswith("br<") and words:
            words.append(" ")
    if words:
        blocks.append(" ".join("".join(words).split()))
    return "\n".join(b for b in blocks if b)


@F.arrow_udf(StringType())
def _extract(pages: pa.Array, frames: pa.Array, repeated: pa.Array, varied: pa.Array) -> pa.Array:
    return pa.array([
        main_text(page.as_py(), frame.as_py(), set(drop.as_py() or ()), bool(differ.as_py()))
        for page, frame, drop, differ in zip(pages, frames, repeated, varied)], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """``pages(url, html, ...)`` in a struct ``row``, beside it the main ``text``."""
    hosted = with_host(pages)
    templates = written(deduce(hosted), "templates")
    bounded = broadcast_within(templates, 50_000, 1 << 25, F.repeat(F.lit("12345678"), F.size("frame") + F.size("repeated")))
    if bounded is not None:
        joined = hosted.join(bounded, "host", "left")
    else:
        salt = F.pmod(F.xxhash64("html"), F.lit(SALTS))
        copies = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        joined = hosted.withColumn("salt", salt).join(copies, ["host", "salt"], "left")
    return joined.select("row", _extract("html", "frame", "repeated", "varied").alias("text"))
