"""Porter stemming (M. F. Porter, 1980), as a column expression and as a function of one word.

In the expression the steps are bound one after the other inside the row, which needs no lookup table,
no vocabulary pass and no shuffle. Stems are measured only for words whose suffix matched. The function
``stem_word`` is for vocabularies, where each word is stemmed once.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import PORTER_STEP_2, PORTER_STEP_3, PORTER_STEP_4
from .text import bind

_VOWEL = "[aeiouy]"
_CONSONANTS = "[^aeiou][^aeiouy]*"
_VOWELS = "[aeiouy][aeiou]*"
HAS_VOWEL = f"^({_CONSONANTS})?{_VOWEL}"
MEASURE_OVER_0 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}"
MEASURE_IS_1 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}({_VOWELS})?$"
MEASURE_OVER_1 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}{_VOWELS}{_CONSONANTS}"
SHORT_SYLLABLE = f"^{_CONSONANTS}{_VOWEL}[^aeiouwxy]$"


def longest_first(suffixes: Iterable[str]) -> list[str]:
    return sorted(suffixes, key=lambda s: (-len(s), s))


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.greatest(F.length(word) - n, F.lit(0)))


def _on_suffix(
    word: Column, suffixes: Iterable[str], change: Callable[[Column], Column]
) -> Column:
    """``change(stem)`` for a word with one of the suffixes (the longest), else the word."""
    endings = sorted({s[-2:] for s in suffixes})
    suffixes = "|".join(suffixes)
    stem = F.regexp_extract(word, f"(?s)^(.*?)(?:{suffixes})$", 1)
    matches = F.right(word, F.lit(2)).isin(*endings) & word.rlike(f"(?:{suffixes})$")
    return F.when(matches, bind(stem, change)).otherwise(word)


def _rest(word: Column, stem: Column) -> Column:
    return F.substring(word, F.length(stem) + 1, F.lit(1 << 30))


def _plural(w: Column) -> Column:
    return F.when(w.endswith("s"), (
        F.when(w.endswith("sses") | (w.endswith("ies") & (F.length(w) > 3)), _cut(w, 2))
        .when(~w.endswith("ss") & (F.length(w) > 2), _cut(w, 1))
        .otherwise(w)
    )).otherwise(w)


def _past_or_gerund(w: Column) -> Column:
    eed = F.when(_cut(w, 3).rlike(MEASURE_OVER_0), _cut(w, 1)).otherwise(w)

    def strip(stem: Column) -> Column:
        return F.when(stem.rlike(HAS_VOWEL), _tidy(stem)).otherwise(w)

    return F.when(w.endswith("eed"), eed).otherwise(_on_suffix(w, ("ed", "ing"), strip))


def _tidy(stem: Column) -> Column:
    return (
        F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(stem.rlike(r"([^aeiouylsz])\1$"), _cut(stem, 1))
        .when(stem.rlike(SHORT_SYLLABLE), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def _final_y(w: Column) -> Column:
    return F.when(
        w.endswith("y") & _cut(w, 1).rlike(HAS_VOWEL), F.concat(_cut(w, 1), F.lit("i"))
    ).otherwise(w)


def _replace_suffix(w: Column, rules: dict[str, str]) -> Column:
    table = F.create_map(*(F.lit(x) for rule in rules.items() for x in rule))

    def change(stem: Column) -> Column:
        return F.when(
            stem.rlike(MEASURE_OVER_0), F.concat(stem, F.element_at(table, _rest(w, stem)))
        ).otherwise(w)

    return _on_suffix(w, rules, change)


def _drop_suffix(w: Column) -> Column:
    def change(stem: Column) -> Column:
        droppable = (_rest(w, stem) != "ion") | stem.rlike("[st]$")
        return F.when(droppable & stem.rlike(MEASURE_OVER_1), stem).otherwise(w)

    return _on_suffix(w, PORTER_STEP_4, change)


def _final_e(w: Column) -> Column:
    def change(stem: Column) -> Column:
        removable = stem.rlike(MEASURE_OVER_1) | (
            stem.rlike(MEASURE_IS_1) & ~stem.rlike(SHORT_SYLLABLE)
        )
        return F.when(removable, stem).otherwise(w)

    return F.when(w.endswith("e"), bind(_cut(w, 1), change)).otherwise(w)


def _double_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(MEASURE_OVER_1), _cut(w, 1)).otherwise(w)


# Inflections, then derivations; a word without one of the endings passes a group unchanged.
_INFLECTIONS = (_plural, _past_or_gerund, _final_y)
_DERIVATIONS = (
    lambda w: _replace_suffix(w, dict(PORTER_STEP_2)),
    lambda w: _replace_suffix(w, dict(PORTER_STEP_3)),
    _drop_suffix,
    _final_e,
    _double_l,
)
_DERIVED_ENDINGS = {s[-2:] for s in (*dict(PORTER_STEP_2), *dict(PORTER_STEP_3), *PORTER_STEP_4)}


def _apply(word: Column, steps: Iterable[Callable[[Column], Column]]) -> Column:
    for step in steps:
        word = bind(word, step)
    return word


def _inflected(w: Column) -> Column:
    return F.when(
        F.right(w, F.lit(1)).isin("s", "d", "g", "y"), _apply(w, _INFLECTIONS)
    ).otherwise(w)


def _derived(w: Column) -> Column:
    concerned = F.right(w, F.lit(2)).isin("ll", *sorted(_DERIVED_ENDINGS)) | w.endswith("e")
    return F.when(concerned, _apply(w, _DERIVATIONS)).otherwise(w)


def _with_first(word: Column, old: str, new: str) -> Column:
    return F.when(
        word.startswith(old), F.concat(F.lit(new), F.substring(word, 2, 1 << 30))
    ).otherwise(word)


def stem(word: Column) -> Column:
    """Stem of a lower-case word. Words under three characters stay; a first ``y`` is a consonant."""
    marked = _with_first(word, "y", "Y")
    unmark = lambda w: _with_first(w, "Y", "y")
    stemmed = _apply(marked, (_inflected, _derived, unmark))
    return F.when(F.length(word) < 3, word).otherwise(stemmed)


# The same steps for one word.

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_vowel, _over_0, _is_1, _over_1, _short = (
    re.compile(p).search for p in (HAS_VOWEL, MEASURE_OVER_0, MEASURE_IS_1, MEASURE_OVER_1, SHORT_SYLLABLE))


def _ending(word: str, suffixes: Iterable[str]) -> str | None:
    return next((s for s in longest_first(suffixes) if word.endswith(s)), None)


def _word_inflected(w: str) -> str:
    if w.endswith("sses") or (w.endswith("ies") and len(w) > 3):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss") and len(w) > 2:
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _over_0(w[:-3]) else w
    elif (suffix := _ending(w, ("ed", "ing"))) and _vowel(rest := w[: -len(suffix)]):
        w = rest
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and w[-1] not in "aeiouylsz":
            w = w[:-1]
        elif _short(w):
            w += "e"
    return w[:-1] + "i" if w.endswith("y") and _vowel(w[:-1]) else w


def _word_derived(w: str) -> str:
    for rules in (dict(PORTER_STEP_2), dict(PORTER_STEP_3)):
        suffix = _ending(w, rules)
        if suffix and _over_0(w[: -len(suffix)]):
            w = w[: -len(suffix)] + rules[suffix]
    suffix = _ending(w, PORTER_STEP_4)
    if suffix:
        rest = w[: -len(suffix)]
        if _over_1(rest) and (suffix != "ion" or rest.endswith(("s", "t"))):
            w = rest
    if w.endswith("e") and (_over_1(w[:-1]) or (_is_1(w[:-1]) and not _short(w[:-1]))):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _over_1(w) else w


def stem_word(word: str) -> str:
    """Stem of a lower-case word, as ``stem`` gives it."""
    if len(word) < 3:
        return word
    w = "Y" + word[1:] if word[0] == "y" else word
    w = _word_derived(_word_inflected(w))
    return "y" + w[1:] if w.startswith("Y") else w
