"""Parts of speech in context: the most probable flags of the words of a sentence.

A lexicon of the caller says how often a term has a flag, a table of transitions how often a flag follows
another inside a sentence (``""`` begins it). Both become costs, whole millionths of the negative
logarithm, and each sentence gets the cheapest sequence of flags, one flag a word. Ties go to the
alphabetically smaller flag, from the end of the sentence on. A term outside the lexicon has the flag
``UNKNOWN``; a transition that isn't listed costs more than any listed one.

Sentences lie in their document's row, so nothing is shuffled while the lexicon is within its checked
bounds. Of a larger one the most frequent terms, a bounded number, go to all tasks; only the other distinct
terms of each document are joined with it. Python holds the tokens of a bounded slice of rows at a time.
"""

from __future__ import annotations

import string
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import KEYWORD_STOP_WORDS, SENTENCE_ENDS
from ..functions.text import count_values, is_keyword, token_array
from ..session import broadcast_within, materialise, once, written
from .keywords import learn_idf, most_frequent, retotal, top_terms, weigh

LEXICON_ROWS = 1_000_000
LEXICON_BYTES = 32 << 20
#: Terms of a larger lexicon that go to all tasks.
HOT_TERMS = 100_000
#: Tokens that are Python objects at a time; a longer row is a slice of its own.
SLICE_TOKENS = 400_000
#: Sentences that advance together as long as there are so many; longer ones are tagged alone.
TOGETHER = 16
#: Cost of what is no option.
NEVER = 1 << 60
#: Distinct pairs of flags that a table of transitions may hold.
MOST_TRANSITIONS = 10_000
COST_UNIT = 1_000_000
UNKNOWN = "x"
#: Tokens that surely are no words.
NO_WORDS = sorted({*string.punctuation, *string.whitespace, *SENTENCE_ENDS})

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Options = list[tuple[str, int]]


def _costs(table: DataFrame, given: str, *others: str) -> DataFrame:
    """``(given, others..., cost)``: minus the logarithm of each row's share of the rows with the same ``given``."""
    counts = table.filter(F.col("freq") > 0).groupBy(given, *others).agg(F.sum("freq").alias("freq"))
    whole = counts.groupBy(given).agg(F.sum("freq").alias("whole"))
    cost = F.round(F.log(F.col("whole") / F.col("freq")) * COST_UNIT).cast("bigint")
    return counts.join(whole, given).select(given, *others, cost.alias("cost"))


def transition_costs(transitions: DataFrame) -> tuple[dict[tuple[str, str], int], int]:
    """Costs of ``transitions(prev, flag, freq)`` and of a transition that isn't listed."""
    rows = _costs(transitions, "prev", "flag").limit(MOST_TRANSITIONS + 1).collect()
    if len(rows) > MOST_TRANSITIONS:
        raise ValueError(f"more than {MOST_TRANSITIONS} transitions between flags")
    costs = {(r.prev, r.flag): r.cost for r in rows}
    return costs, max(costs.values(), default=0) + COST_UNIT


def best_flags(
    terms: Sequence[str], options: Callable[[str], Options | None],
    transitions: dict[tuple[str, str], int], unlisted: int,
) -> list[str]:
    """One flag a term of a sentence."""
    reached, steps, price = {"": 0}, [], transitions.get
    for term in terms:
        before, reached, came = reached, {}, {}
        for flag, cost in options(term) or [(UNKNOWN, 0)]:
            least = prev = None
            for p, c in before.items():
                c += price((p, flag), unlisted)
                if prev is None or c < least or (c == least and p < prev):
                    least, prev = c, p
            reached[flag], came[flag] = least + cost, prev
        steps.append(came)
    if not steps:
        return []
    flag, found = min((c, f) for f, c in reached.items())[1], []
    for came in reversed(steps):
        found.append(flag)
        flag = came[flag]
    return found[::-1]


def slices(lists: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """``(start, stop)`` of runs of rows that hold at most ``most`` values together, or one row."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))
    at = 0
    while at < len(lists):
        stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")), at + 1)
        yield at, stop
        at = stop


_ARROW_TAGS = pa.list_(pa.struct([("pos", pa.int32()), ("term", pa.string()), ("flag", pa.string())]))


def _flags_of(ends: np.ndarray, term: np.ndarray, options: list[Options], transitions, unlisted) -> np.ndarray:
    """One flag a word of many sentences that end at ``ends``, as ``best_flags`` gives it; ``options`` by term.

    All sentences advance together, word by word; the few longest go through ``best_flags`` alone.
    """
    names = sorted({f for x in options for f, _ in x} | {""})
    code, width = {f: k for k, f in enumerate(names)}, max(map(len, options), default=0)
    flag = np.full((len(options), width), -1, np.int64)
    cost = np.full((len(options), width), NEVER, np.int64)
    for k, x in enumerate(options):
        for j, (f, c) in enumerate(sorted(x)):
            flag[k, j], cost[k, j] = code[f], c
    move = np.full((len(names) + 1, len(names) + 1), unlisted, np.int64)  # the last is no flag
    for (prev, f), c in transitions.items():
        if prev in code and f in code:
            move[code[prev], code[f]] = c
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    found = np.zeros(len(term), np.int64)
    most = lengths[order[TOGETHER - 1]] if len(order) >= TOGETHER else 0
    alone = int((lengths[order] > most).sum())
    for k in order[:alone]:
        here = term[starts[k]: ends[k]]
        found[starts[k]: ends[k]] = [code[f] for f in best_flags(here, options.__getitem__, transitions, unlisted)]
    order = order[alone:]
    first, size = starts[order], lengths[order]
    came, reached, at = [], np.zeros((len(order), 1), np.int64), np.full((len(order), 1), code[""])
    going = [int(x) for x in np.searchsorted(-size, -np.arange(int(most)), "left")]  # sentences of more than so many words
    last = np.empty(len(order), np.int64)
    for step, n in enumerate(going):
        now = term[first[:n] + step]
        here = flag[now]
        price = reached[:n, :, None] + move[at[:n, :, None], here[:, None, :]]
        came.append(price.argmin(axis=1))  # flags ascend, so the first is the smallest
        reached, at = price.min(axis=1) + cost[now], here
        over = going[step + 1] if step + 1 < len(going) else 0
        last[over:n] = reached[over:n].argmin(axis=1)
    for step in range(len(going) - 1, -1, -1):
        n = going[step]
        place = first[:n] + step
        found[place] = flag[term[place], last[:n]]
        last[:n] = came[step][np.arange(n), last[:n]]
    return np.array(names, object)[found]


def _tagged(column: pa.Array, listed: pa.Array | None, often: dict[str, Options], transitions, unlisted) -> pa.Array:
    """The tagged words of each row of tokens; terms have their options from ``often`` or from the rows' ``listed``."""
    done = [pa.array([], _ARROW_TAGS)]
    for start, stop in slices(column, SLICE_TOKENS):
        part = column.slice(start, stop - start)
        rare: dict[str, Options] = {}
        if listed is not None:
            own = listed.slice(start, stop - start).flatten()
            for term, flag, cost in set(zip(*(own.field(c).to_pylist() for c in ("term", "flag", "cost")))):
                rare.setdefault(term, []).append((flag, cost))
        coded = pc.dictionary_encode(part.flatten(), null_encoding="encode")
        terms, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        word = np.array([t is not None and t not in SENTENCE_ENDS and t[:1].isalnum() for t in terms], bool)
        sizes = np.asarray(pc.fill_null(pc.list_value_length(part), 0), np.int64)
        stops = np.cumsum(sizes)
        place = np.flatnonzero(word[code]) if len(code) else code.astype(np.int64)
        limits = np.flatnonzero(np.array([t in SENTENCE_ENDS for t in terms], bool)[code]) if len(code) else place
        ends = np.searchsorted(place, np.unique(np.concatenate([limits, stops])))  # of sentences, also at the end of a row
        options = [often.get(t) or rare.get(t) or [(UNKNOWN, 0)] for t in terms]
        flags = _flags_of(ends, code[place].astype(np.int64), options, transitions, unlisted)
        pos = place - np.repeat(stops - sizes, np.diff(np.searchsorted(place, np.append(0, stops))))
        words = pa.StructArray.from_arrays(
            [pa.array(pos, pa.int32()), coded.dictionary.take(pa.array(code[place])), pa.array(flags, pa.string())],
            fields=list(_ARROW_TAGS.value_type))
        bounds = pa.array(np.searchsorted(place, np.append(0, stops)), pa.int32())
        done.append(pa.ListArray.from_arrays(bounds, words, _ARROW_TAGS, mask=part.is_null()))
    return pa.concat_arrays(done)


def tag_tokens(
    docs: DataFrame,
    ids: Sequence[str],
    lexicon: DataFrame,
    transitions: DataFrame,
    text: str = "text",
    max_rows: int = LEXICON_ROWS,
    max_bytes: int = LEXICON_BYTES,
    exploded: bool = True,
    hot_terms: int = HOT_TERMS,
) -> DataFrame:
    """``(ids, pos, term, flag)``: the words of a text, or of ready tokens, with one flag each.

    ``lexicon(term, flag, freq)`` and ``transitions(prev, flag, freq)`` are measured when this is called.
    ``pos`` counts all tokens. ``ids`` name a row. Without ``exploded`` the words of a row stay together,
    ``(ids, tagged)``.
    """
    known = written(_costs(lexicon, "flag", "term"), "lexicon")
    steps, unlisted = transition_costs(transitions)
    kind = "array<struct<pos: int, term: string, flag: string>>"
    tokens = token_array(docs, text)
    small = broadcast_within(known, max_rows, max_bytes, "term") is not None
    hot = known
    if not small:
        counts = written(lexicon.groupBy("term").agg(F.sum("freq").alias("n")), "lexicon-terms")
        often = materialise(most_frequent(counts, "n", hot_terms).select("term"))
        hot = known.join(F.broadcast(often), "term")
    options: dict[str, Options] = {}
    for row in hot.toLocalIterator():
        options.setdefault(row.term, []).append((row.flag, row.cost))
    shared = docs.sparkSession.sparkContext.broadcast(options)
    if small:
        @F.arrow_udf(kind)
        def tag(column: pa.Array) -> pa.Array:
            return _tagged(column, None, shared.value, steps, unlisted)

        found = docs.select(*ids, once(tag)(tokens).alias("tagged"))
    else:
        @F.arrow_udf(kind)
        def tag_with(column: pa.Array, listed: pa.Array) -> pa.Array:
            return _tagged(column, listed, shared.value, steps, unlisted)

        # ids may repeat or be null, so the text is part of the key
        ready = dict(docs.dtypes)[text].startswith("array")
        whole = F.array_join(tokens, "\u0000") if ready else F.col(text)
        key = F.unhex(F.md5(F.concat(F.to_json(F.struct(*ids)), F.lit("\u0000"), F.coalesce(whole, F.lit("")))))
        keyed = docs.withColumn("__key", key)
        words = F.filter(F.array_distinct(tokens), lambda t: ~t.isin(NO_WORDS))
        rare = known.join(F.broadcast(often), "term", "left_anti")
        held = keyed.select("__key", F.explode(words).alias("term")).join(F.broadcast(often), "term", "left_anti").join(rare, "term")
        own = held.groupBy("__key").agg(F.collect_set(F.struct("term", "flag", "cost")).alias("__own"))
        found = keyed.join(own, "__key", "left").select(*ids, once(tag_with)(tokens, F.col("__own")).alias("tagged"))
    return found.select(*ids, F.inline("tagged")) if exploded else found


def learn_tags(flagged: DataFrame, words: str = "words") -> tuple[DataFrame, DataFrame]:
    """Lexicon and transitions of flagged sentences, ``array<struct<term, flag>>``; both as counts.

    The sentences are read once, for the counts of both together, which are written.
    """
    def after(word: Column, i: Column) -> Column:
        prev = F.when(i > 0, F.get(F.col(words), F.greatest(i - 1, F.lit(0)))["flag"]).otherwise("")
        return F.struct(prev.alias("prev"), word["term"].alias("term"), word["flag"].alias("flag"))

    counts = written(
        flagged.select(F.inline(F.transform(words, after))).groupBy("prev", "term", "flag").agg(F.count(F.lit(1)).alias("freq")),
        "tags")
    return (counts.groupBy("term", "flag").agg(F.sum("freq").alias("freq")),
            counts.groupBy("prev", "flag").agg(F.sum("freq").alias("freq")))


def tagged_frequencies(
    tagged: DataFrame, ids: Sequence[str], allow_pos: Iterable[str] = (),
    stop_words: Iterable[str] = KEYWORD_STOP_WORDS, with_flag: bool = False,
) -> DataFrame:
    """``(ids, term[, flag], freq, total)`` of the tagged words that may become keywords.

    An empty ``allow_pos`` keeps all flags. With ``with_flag`` a term counts for each flag it has.
    ``tagged`` may hold words as rows or as arrays; arrays are counted inside their row, and only the
    counts are shuffled, once.
    """
    allow_pos = tuple(allow_pos)
    if "tagged" in tagged.columns:
        words = F.filter("tagged", lambda w: is_keyword(w["term"], stop_words) & (
            w["flag"].isin(*allow_pos) if allow_pos else F.lit(True)))
        key = ["term", "flag"] if with_flag else ["term"]
        counts = count_values(F.transform(words, lambda w: F.struct(*(w[c].alias(c) for c in key))))
        rows = tagged.select(*ids, counts.alias("__counts")).filter("__counts is not null").repartition(*ids)
        # an expression: of a plain column Spark would infer a filter that counts everything once more
        rows = rows.select(*ids, F.inline(F.slice("__counts", F.lit(1), F.size("__counts"))).alias("__value", "n"))
        rows = rows.select(*ids, *(F.col(f"__value.{c}").alias(c) for c in key), "n")
        return retotal(rows.groupBy(*ids, *key).agg(F.sum("n").alias("freq")), ids)
    kept = tagged.filter(is_keyword(F.col("term"), stop_words))
    if allow_pos:
        kept = kept.filter(F.col("flag").isin(*allow_pos))
    key = ["term", "flag"] if with_flag else ["term"]
    return retotal(kept.groupBy(*ids, *key).agg(F.count(F.lit(1)).alias("freq")), ids)


def tagged_keywords(
    docs: DataFrame, ids: Sequence[str], tagged: DataFrame, allow_pos: Iterable[str], text: str = "text",
    k: int | None = 20, idf: DataFrame | None = None, with_flag: bool = False,
) -> DataFrame:
    """TF-IDF keywords ``(ids, term[, flag], weight, rank)`` of the words whose flag in context is allowed."""
    terms = tagged_frequencies(tagged, ids, allow_pos, with_flag=with_flag)
    idf, learned = (learn_idf(docs, text), True) if idf is None else (idf, False)
    key = ("term", "flag") if with_flag else ("term",)
    best = top_terms(weigh(terms, idf, complete=learned), ids, k, key=key)
    return best.select(*ids, *key, "weight", "rank")
