"""Search analyzer: tokens with offsets, lower-cased, stop words removed, stemmed."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import ANALYZER_STOP_WORDS
from ..functions.porter import stem_word
from ..functions.text import span_array
from ..session import broadcast_within


# Stems that a task remembers, and the bounds of a stop-word table that is broadcast.
REMEMBERED_STEMS = 500_000
STOP_ROWS, STOP_BYTES = 100_000, 16 << 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tokens_with_offsets(docs: DataFrame, ids: Sequence[str], text: str = "text") -> DataFrame:
    """``(ids, term, startpos, endpos)`` of the search tokens."""
    return docs.select(*ids, F.inline(span_array(docs, text)))


def lower_case(token_rows: DataFrame) -> DataFrame:
    return token_rows.withColumn("term", F.lower("term"))


def stop_filter(
    token_rows: DataFrame, stop_words: Iterable[str] | DataFrame = ANALYZER_STOP_WORDS, min_size: int = 1
) -> DataFrame:
    """Drop stop words and terms shorter than ``min_size``.

    ``stop_words`` are words, or a table with the column ``term``; a table within the bounds is broadcast,
    a longer one joins by shuffle.
    """
    kept = token_rows.filter(F.length("term") >= min_size)
    if not isinstance(stop_words, DataFrame):
        return kept.filter(~F.col("term").isin(*stop_words))
    listed = stop_words.select("term").distinct()
    bounded = broadcast_within(listed, STOP_ROWS, STOP_BYTES, "term")
    return kept.join(listed if bounded is None else bounded, "term", "left_anti").select(*token_rows.columns)


def stem_filter(token_rows: DataFrame, stem: Callable[[str], str] = stem_word) -> DataFrame:
    """Replace each term by ``stem`` of it.

    ``stem`` may be any function of a word. It is called for the vocabulary only: the terms of a batch are
    coded by their distinct values, and a task remembers the stems that it has seen.
    """
    seen: dict[str, str] = {}

    def stems_of(column: pa.Array) -> pa.Array:
        coded = pc.dictionary_encode(column)
        words = coded.dictionary.to_pylist()
        if len(seen) > REMEMBERED_STEMS:
            seen.clear()
        for word in words:
            if word not in seen:
                seen[word] = stem(word)
        return pa.array([seen[w] for w in words], pa.string()).take(coded.indices)

    return token_rows.withColumn("term", F.arrow_udf(stems_of, "string")("term"))


def analyze(
    docs: DataFrame,
    ids: Sequence[str],
    text: str = "text",
    stop_words: Iterable[str] | DataFrame = ANALYZER_STOP_WORDS,
    min_size: int = 1,
    stem: Callable[[str], str] | bool | None = stem_word,
) -> DataFrame:
    """The whole chain, without a shuffle. Without ``stem`` (None or False) terms stay as they are."""
    rows = tokens_with_offsets(docs, ids, text).transform(lower_case)
    rows = stop_filter(rows, stop_words, min_size)
    return stem_filter(rows, stem_word if stem is True else stem) if stem else rows
