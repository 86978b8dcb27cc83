"""Inverted index: field keywords, title tokens, inversion and posting lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_array, unescape
from ..session import written
from .keywords import extract_keywords

INDEX_KEYWORDS = 10
SHORT_TERM = (2, 4)
URLS_PER_LIST = 100_000


def field_cells(cells: DataFrame, *qualifiers: str) -> DataFrame:
    """Cells of the named fields that hold a value."""
    return cells.filter(F.col("qualifier").isin(*qualifiers) & F.col("value").isNotNull())


def field_texts(cells: DataFrame, *qualifiers: str, escaped: bool = False) -> DataFrame:
    """``(url, qualifier, text)``; ``escaped`` decodes values stored as ``\\xHH`` escapes."""
    value = unescape("value") if escaped else F.col("value")
    return field_cells(cells, *qualifiers).select(
        F.col("row").alias("url"), "qualifier", value.alias("text")
    )


def article_texts(articles: DataFrame) -> DataFrame:
    """``(url, qualifier, text)`` of the title and content, texts or ready tokens, of wide articles."""
    return articles.unpivot("url", ["title", "content"], "qualifier", "text").filter(
        F.col("text").isNotNull()
    )


def field_keywords(
    texts: DataFrame, idf: DataFrame | None = None, k: int = INDEX_KEYWORDS
) -> DataFrame:
    """The ``k`` best keywords of every field: ``(url, qualifier, term, weight, rank)``."""
    return extract_keywords(texts, ("url", "qualifier"), k=k, idf=idf)


def title_tokens(titles: DataFrame, text: str = "title") -> DataFrame:
    """Every token of every title: ``(url, term)``, duplicates and separators included."""
    return titles.select("url", F.explode(token_array(titles, text)).alias("term"))


def invert(terms: DataFrame) -> DataFrame:
    """``(url, term)`` rows to distinct postings ``(term, url)``."""
    return terms.select("term", "url").distinct()


def short_terms(postings: DataFrame) -> DataFrame:
    return postings.filter(F.length("term").between(*SHORT_TERM))


def long_terms(postings: DataFrame) -> DataFrame:
    return postings.filter(F.length("term") > SHORT_TERM[1])


def posting_lists(postings: DataFrame, max_urls: int = URLS_PER_LIST) -> DataFrame:
    """``(term, part, urls)`` from distinct postings, urls ascending inside a part.

    Nearly every term has the single part 0. A term with more than ``max_urls`` postings is hashed
    by url into as many parts as it needs, so no task and no row has to hold an unbounded list.
    The postings are written once, because they are counted before they are listed. The join on
    the counts is left to adaptive execution, which broadcasts the few frequent terms by measured
    size or splits the skewed partition.
    """
    postings = written(postings, "postings")
    frequent = (
        postings.groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_urls)
        .select("term", F.ceil(F.col("n") / max_urls).alias("parts"))
    )
    part = F.when(
        F.col("parts").isNotNull(), F.pmod(F.xxhash64("url"), F.col("parts"))
    ).otherwise(F.lit(0))
    return (
        postings.join(frequent, "term", "left")
        .groupBy("term", part.cast("int").alias("part"))
        .agg(F.sort_array(F.collect_list("url")).alias("urls"))
    )


def index_postings(
    articles: DataFrame, idf: DataFrame | None = None, k: int = INDEX_KEYWORDS
) -> DataFrame:
    """Postings of the whole index: short keywords of both fields and long title tokens.

    The two sets of terms differ in length, so together they form one index. The second reads the
    title column alone.
    """
    texts = article_texts(articles)
    keywords = short_terms(field_keywords(texts, idf, k).select("url", "term"))
    titles = long_terms(title_tokens(articles))
    return invert(keywords.unionByName(titles))


def full_index(articles: DataFrame, idf: DataFrame | None = None) -> DataFrame:
    return posting_lists(index_postings(articles, idf))
