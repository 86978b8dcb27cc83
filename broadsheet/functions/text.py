"""Text expressions. All of them work inside one row and compile to built-in Spark functions, so a
document is never shuffled to be tokenised or counted."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .fixed_values import CJK_FIRST, CJK_LAST, INVALID_TEXT, KEYWORD_STOP_WORDS

CJK = f"[{CJK_FIRST}-{CJK_LAST}]"
WORD = r"[\p{L}\p{N}]"
SPANS = "array<struct<term: string, startpos: bigint, endpos: bigint>>"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _bigrams(run: Column) -> Column:
    """Pairs of neighbouring characters; a single character stays."""
    return bind(F.split(run, ""), lambda chars: F.when(F.size(chars) < 2, chars).otherwise(
        F.zip_with(
            F.slice(chars, F.lit(1), F.size(chars) - 1),
            F.slice(chars, F.lit(2), F.size(chars) - 1),
            lambda a, b: F.concat(a, b),
        )
    ))


def _split_cjk(piece: Column) -> Column:
    """One token as an array: Chinese runs become character bigrams, the rest stays whole."""
    runs = F.regexp_extract_all(piece, F.lit(f"{CJK}+|[^{CJK_FIRST}-{CJK_LAST}]+"), F.lit(0))
    return F.flatten(
        F.transform(runs, lambda r: F.when(r.rlike(f"^{CJK}"), _bigrams(r)).otherwise(F.array(r)))
    )


def _expand_cjk(text: Column, pieces: Column) -> Column:
    expanded = F.flatten(
        F.transform(pieces, lambda p: F.when(p.rlike(CJK), _split_cjk(p)).otherwise(F.array(p)))
    )
    return F.when(text.rlike(CJK), expanded).otherwise(pieces)


def tokens(text: Column | str) -> Column:
    """Ordered tokens of the whole text: words, and every other character as its own token."""
    text = _column(text)
    return _expand_cjk(text, F.regexp_extract_all(text, F.lit(f"{WORD}+|(?s:.)"), F.lit(0)))


def is_keyword(term: Column, stop_words: Iterable[str] = KEYWORD_STOP_WORDS) -> Column:
    """At least two characters after trimming, and not a stop word when lower-cased."""
    return (F.length(F.trim(term)) >= 2) & ~F.lower(term).isin(*sorted(set(stop_words)))


def keyword_tokens(text: Column | str, stop_words: Iterable[str] = KEYWORD_STOP_WORDS) -> Column:
    """The tokens of the text that may become keywords, in order.

    Equal to filtering ``tokens`` with ``is_keyword``; single characters are already left out by
    the pattern.
    """
    text = _column(text)
    stop_words = tuple(stop_words)
    pieces = F.regexp_extract_all(text, F.lit(f"{WORD}{{2,}}"), F.lit(0))
    return F.filter(_expand_cjk(text, pieces), lambda t: is_keyword(t, stop_words))


def token_spans(text: Column | str) -> Column:
    """Search tokens with character offsets, ``array<struct<term, startpos, endpos>>``.

    A token is dropped when it does not start with a Chinese character and has one character.
    Word starts are read off a mask of the text, which keeps the work linear in its length.
    """
    text = _column(text)
    words = F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))
    mask = F.regexp_replace(
        F.regexp_replace(text, f"(?s)[^\\p{{L}}\\p{{N}}]", " "), WORD, "w"
    )

    def starts(marks: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(marks) - 1),
            lambda i: (F.get(marks, i) == "w")
            & ((i == 0) | (F.get(marks, F.greatest(i - 1, F.lit(0))) == " ")),
        )

    def span(term: Column, start: Column) -> Column:
        return F.struct(
            term.alias("term"),
            start.cast("bigint").alias("startpos"),
            (start + F.length(term)).cast("bigint").alias("endpos"),
        )

    def runs_of(word: Column, start: Column) -> Column:
        def at(pieces: Column) -> Column:
            return F.flatten(F.transform(pieces, lambda p, k: bigram_spans(
                p,
                start + F.length(F.array_join(F.slice(pieces, F.lit(1), k), "")),
            )))

        return bind(
            F.regexp_extract_all(word, F.lit(f"{CJK}+|[^{CJK_FIRST}-{CJK_LAST}]+"), F.lit(0)), at
        )

    def bigram_spans(run: Column, start: Column) -> Column:
        return F.when(
            run.rlike(f"^{CJK}"),
            F.transform(_bigrams(run), lambda pair, i: span(pair, start + i)),
        ).otherwise(F.array(span(run, start)))

    def spans(pair: Column) -> Column:
        plain = F.zip_with(pair["words"], pair["starts"], span)
        mixed = F.flatten(F.zip_with(
            pair["words"], pair["starts"],
            lambda w, s: F.when(w.rlike(CJK), runs_of(w, s)).otherwise(F.array(span(w, s))),
        ))
        return F.when(text.rlike(CJK), mixed).otherwise(plain)

    found = bind(
        F.struct(words.alias("words"), bind(F.split(mask, ""), starts).alias("starts")), spans
    )
    return F.filter(found, lambda t: _is_search_token(t["term"]))


def _ready(df: DataFrame, text: str) -> Column | None:
    """The column of ready tokens, ``array<struct<term, ...>>`` or ``array<string>``, if it is one."""
    kind = df.schema[text].dataType
    if not isinstance(kind, ArrayType):
        return None
    if isinstance(kind.elementType, StructType):
        return F.transform(F.col(text), lambda t: t["term"])
    return F.col(text)


def token_array(df: DataFrame, text: str) -> Column:
    """``tokens`` of a text column, or the ready tokens of an array column."""
    ready = _ready(df, text)
    return tokens(text) if ready is None else ready


def keyword_array(
    df: DataFrame, text: str, stop_words: Iterable[str] = KEYWORD_STOP_WORDS
) -> Column:
    """``keyword_tokens`` of a text column, or the ready tokens that may become keywords."""
    ready = _ready(df, text)
    if ready is None:
        return keyword_tokens(text, stop_words)
    stop_words = tuple(stop_words)
    return F.filter(ready, lambda t: is_keyword(t, stop_words))


def span_array(df: DataFrame, text: str) -> Column:
    """``token_spans`` of a text column, or the ready search tokens with their offsets."""
    kind = df.schema[text].dataType
    if not isinstance(kind, ArrayType):
        return token_spans(text)
    if not isinstance(kind.elementType, StructType):
        raise ValueError(f"{text}: ready search tokens need offsets, array<struct<term, startpos, endpos>>")
    return F.filter(F.col(text), lambda t: _is_search_token(t["term"]))


def _is_search_token(term: Column) -> Column:
    return term.rlike(f"^{CJK}") | (F.length(term) > 1)


def count_values(values: Column) -> Column:
    """Distinct values of an array with their counts, ``array<struct<value, n>>``, ascending.

    Sorting inside the row and measuring runs needs no shuffle and is linear after the sort.
    """

    def measure(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0)
            | (F.get(ordered, i) != F.get(ordered, F.greatest(i - 1, F.lit(0)))),
        )
        runs = bind(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("value"),
                    (F.coalesce(F.get(at, k + 1), size) - start).cast("bigint").alias("n"),
                ),
            ),
        )
        return F.when(size > 0, runs)

    return bind(F.sort_array(values), measure)


def unescape(value: Column | str) -> Column:
    r"""Decode ``\xHH`` escapes to UTF-8 text; what cannot be decoded becomes ``invalid``.

    Only ``\xHH`` is decoded and nothing is evaluated, so quotes are plain text.
    """
    value = _column(value)
    pieces = F.regexp_extract_all(
        value, F.lit(r"(?s)(?:\\x[0-9A-Fa-f]{2})+|[^\\]+|\\"), F.lit(0)
    )
    as_hex = F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(
                p.startswith("\\x"), F.replace(p, F.lit("\\x"), F.lit(""))
            ).otherwise(F.hex(p)),
        ),
        "",
    )
    decoded = F.coalesce(
        F.try_validate_utf8(F.unhex(as_hex).cast("string")), F.lit(INVALID_TEXT)
    )
    malformed = value.rlike(r"\\x(?![0-9A-Fa-f]{2})")
    return (
        F.when(~F.contains(value, F.lit("\\")), value)
        .when(malformed, F.lit(INVALID_TEXT))
        .otherwise(decoded)
    )
