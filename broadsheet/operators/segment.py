"""Segmentation of Chinese text by a dictionary of the caller.

The words of a run of Chinese characters form a lattice: every dictionary word between two places of the
run is an edge, and so is every single character. A word costs ``ln(total / freq)`` and an unlisted
character as much as a word seen once; the segmentation is the cheapest path, which is the most probable
one. Costs are whole millionths, so that ties are ties: of equally cheap paths the one whose first
different word is longer is taken. Characters that aren't in the dictionary and stand next to
each other become pairs, as they do without a dictionary.

The result is a column of ready tokens with offsets, which every function of the library takes in place
of the text. A dictionary within the checked bounds goes to all tasks as a trie in arrays and no row is
shuffled: all runs of a slice of the rows are walked and cut together in numpy, only a very long run by
itself. A larger one is joined with the distinct substrings of each document, and only the words that a document holds go
back to its row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import CJK_FIRST, CJK_LAST
from ..functions.text import CJK, SPANS
from ..session import broadcast_within, materialise, once

# Bounds of a dictionary that is sent to every task.
DICTIONARY_ROWS = 1_000_000
DICTIONARY_BYTES = 32 << 20
COST_UNIT = 1_000_000
#: Characters of text that Python works on at a time; a longer row is a slice of its own.
SLICE_CHARACTERS = 100_000
#: Nodes times letters of a trie whose keys are places of its table, unhashed.
FEW_KEYS = 1 << 22
#: Characters of a run beyond which it is cut by itself: the runs of a slice advance together, by their distance from the end.
LONG_RUN = 256
PIECE = f"{CJK}+|(?:[^\\P{{L}}{CJK_FIRST}-{CJK_LAST}]|\\p{{N}})+|(?s:.)"

# Ship this module's functions with the job, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def word_costs(dictionary: DataFrame) -> tuple[DataFrame, int, int]:
    """``(word, cost)`` of a table ``(word, freq)``, the cost of an unlisted character, the longest word.

    Only words of Chinese characters with a positive count matter; of a word listed twice the larger
    count. The table is materialised.
    """
    words = dictionary.filter(F.col("word").rlike(f"^{CJK}+$") & (F.col("freq") > 0)).groupBy("word").agg(
        F.max("freq").alias("freq"))
    words = materialise(words)
    total, longest = words.agg(F.sum("freq"), F.max(F.length("word"))).first()
    total = total or 1
    cost = F.round(F.log(F.lit(total) / F.col("freq")) * COST_UNIT).cast("bigint")
    unlisted = words.sparkSession.range(1).select(
        F.round(F.log(F.lit(total).cast("double")) * COST_UNIT).cast("bigint")).first()[0]
    return words.select("word", cost.alias("cost")), unlisted, longest or 1


def best_path(run: str, cost: Callable[[str], int | None], unlisted: int, longest: int) -> list[tuple[int, int, bool]]:
    """``(start, end, listed)`` of the words of the cheapest path, found from the right."""
    n = len(run)
    best, words = [0] * (n + 1), [(0, False)] * n
    for i in range(n - 1, -1, -1):
        single = cost(run[i])
        least, word = (unlisted if single is None else single) + best[i + 1], (1, single is not None)
        for length in range(2, min(longest, n - i) + 1):
            listed = cost(run[i:i + length])
            if listed is not None and listed + best[i + length] <= least:
                least, word = listed + best[i + length], (length, True)
        best[i], words[i] = least, word
    path, at = [], 0
    while at < n:
        length, listed = words[at]
        path.append((at, at + length, listed))
        at += length
    return path


def run_spans(path: list[tuple[int, int, bool]]) -> Iterator[tuple[int, int]]:
    """Tokens of a path: words as they are, neighbouring unlisted characters in pairs."""
    for k, (start, end, listed) in enumerate(path):
        if listed:
            yield start, end
        elif k + 1 < len(path) and not path[k + 1][2]:
            yield start, end + 1
        elif k == 0 or path[k - 1][2]:
            yield start, end


def spans_of(pieces: Iterable[str], cost, unlisted: int, longest: int) -> list[tuple[str, int, int]]:
    """Tokens with offsets of a text in pieces, each a Chinese run, a word or one other character."""
    found, at = [], 0
    for piece in pieces:
        if CJK_FIRST <= piece[0] <= CJK_LAST:
            path = best_path(piece, cost, unlisted, longest)
            found += [(piece[a:b], at + a, at + b) for a, b in run_spans(path)]
        else:
            found.append((piece, at, at + len(piece)))
        at += len(piece)
    return found


_ARROW_SPANS = pa.list_(pa.struct([("term", pa.string()), ("startpos", pa.int64()), ("endpos", pa.int64())]))


class Trie(NamedTuple):
    """A dictionary in arrays. Letters are numbered from 1; the edge with ``keys[n]``, made of a node and a letter, leads to node ``n``."""

    letters: np.ndarray  # number of each Chinese character, 0 if no word has it, with a 0 on either side
    size: int  # of the alphabet, with 0
    keys: np.ndarray
    table: np.ndarray  # nodes by their key if these are few, else by its hash, the next free place if it is taken
    costs: np.ndarray  # of the word that ends at a node, -1 if none does

    @classmethod
    def of(cls, costs: dict[str, int]) -> Trie:
        words = [w for w in costs if CJK_FIRST <= min(w) and max(w) <= CJK_LAST]
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64) - ord(CJK_FIRST) + 1
        letters = np.zeros(ord(CJK_LAST) - ord(CJK_FIRST) + 3, np.int64)
        letters[codes] = 1
        letters *= np.cumsum(letters)
        size = int(letters.max()) + 1
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts, node, keys = np.cumsum(sizes) - sizes, np.zeros(len(words), np.int64), [np.array([-1], np.int64)]
        nodes = 1
        for depth in range(sizes.max(initial=0)):
            on = np.flatnonzero(sizes > depth)
            found, place = np.unique(node[on] * size + letters[codes[starts[on] + depth]], return_inverse=True)
            node[on] = nodes + place
            nodes += len(found)
            keys.append(found)
        ends = np.full(nodes, -1, np.int64)
        ends[node] = np.fromiter((costs[w] for w in words), np.int64, len(words))
        places = nodes * size if nodes * size <= FEW_KEYS else 1 << (4 * nodes).bit_length()
        trie = cls(letters, size, np.concatenate(keys), np.zeros(places, np.int32), ends)
        rest = np.arange(1, nodes)
        at = trie._hashed(trie.keys[rest])
        while len(rest):
            free = trie.table[at] == 0
            trie.table[at[free]] = rest[free]
            left = trie.table[at] != rest
            rest, at = rest[left], (at[left] + 1) % len(trie.table)
        return trie

    def _hashed(self, keys: np.ndarray) -> np.ndarray:
        if len(self.table) == len(self.keys) * self.size:
            return keys
        shift = np.uint64(65 - len(self.table).bit_length())
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).view(np.int64)

    def numbered(self, codes: np.ndarray) -> np.ndarray:
        return self.letters[np.clip(codes.astype(np.int64) - ord(CJK_FIRST) + 1, 0, len(self.letters) - 1)]

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The nodes that the letters lead to, 0 where no word goes on so."""
        keys = nodes * np.int64(self.size) + letters
        at = self._hashed(keys)
        found = self.table[at]
        if at is keys:
            return found
        wrong = np.flatnonzero((found > 0) & (self.keys[found] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) % len(self.table)
            found[wrong] = self.table[at[wrong]]
            wrong = wrong[(found[wrong] > 0) & (self.keys[found[wrong]] != keys[wrong])]
        return found

    def words_in(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, length, cost)`` of every listed word in the letters; a 0 ends a run, and the last letter is one."""
        starts, lengths, costs = [], [], []
        at, length = np.flatnonzero(letters), 0
        nodes = np.zeros(len(at), np.int64)
        while len(at):
            nodes = self.step(nodes, letters[at + length])
            on = nodes > 0
            at, nodes, length = at[on], nodes[on], length + 1
            cost = self.costs[nodes]
            listed = cost >= 0
            starts.append(at[listed])
            lengths.append(np.full(len(starts[-1]), length))
            costs.append(cost[listed])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(starts or none), np.concatenate(lengths or none), np.concatenate(costs or none)


def _ends_of_runs(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray, trie: Trie, unlisted: int, ends: np.ndarray) -> None:
    """Puts the ends of the tokens of runs up to ``LONG_RUN`` at their starts in ``ends``, all runs together."""
    sizes = stops - starts + 1  # each run has one more place, its end
    last = np.cumsum(sizes) - 1
    left = np.repeat(last, sizes) - np.arange(sizes.sum())  # characters from a place to the end of its run
    place = np.repeat(stops, sizes) - left
    letters = np.where(left > 0, trie.numbered(codes[np.minimum(place, len(codes) - 1)]), 0)
    begin, length, cost = trie.words_in(letters)
    base = int(length.max(initial=1)) + 1
    single = np.zeros(len(left), bool)
    single[begin[length == 1]] = True
    # a choice is the cost times the base less the length, so that the longer of equally cheap words is the least
    choice, best = np.where(single, np.iinfo(np.int64).max, 0), np.zeros(len(left), np.int64)
    most = int(left.max(initial=0))
    near = left.astype(np.uint16)
    by_place, by_word = np.argsort(near, kind="stable"), np.argsort(near[begin], kind="stable")
    places, words = (np.cumsum(np.bincount(x, minlength=most + 1)) for x in (near, near[begin]))
    for k in range(most):
        here, w = by_place[places[k]:places[k + 1]], by_word[words[k]:words[k + 1]]
        alone = here[~single[here]]
        choice[alone] = (unlisted + best[alone + 1]) * base - 1
        np.minimum.at(choice, begin[w], (cost[w] + best[begin[w] + length[w]]) * base - length[w])
        best[here] = -(-choice[here] // base)
    step = best * base - choice
    reached = np.zeros(len(left), bool)
    reached[last + 1 - sizes] = True
    for k in range(most - 1, -1, -1):
        here = by_place[places[k]:places[k + 1]]
        here = here[reached[here]]
        reached[here + step[here]] = True
    word = np.flatnonzero(reached & (left > 0))
    listed, run = single[word] | (step[word] > 1), word + left[word]
    pair = ~listed[:-1] & ~listed[1:] & (run[:-1] == run[1:])  # neighbouring unlisted characters
    pairs, paired = np.append(pair, False)[:len(word)], np.append(False, pair)[:len(word)]
    kept = listed | pairs | ~paired
    at = place[word[kept]]
    ends[at] = at + step[word[kept]] + pairs[kept]


def word_characters(spark: SparkSession) -> np.ndarray:
    """What each character is to ``PIECE`` in Spark's regular expressions: 2 Chinese, 1 part of a word, 0 a piece of its own."""
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    found = spark.range(0x110000).where(~F.col("id").between(0xD800, 0xDFFF)).where(char.rlike(r"[\p{L}\p{N}]"))
    kinds = np.zeros(0x110000, np.uint8)
    kinds[found.agg(F.collect_list("id")).first()[0]] = 1
    kinds[ord(CJK_FIRST):ord(CJK_LAST) + 1] = 2
    return kinds


def _slice_spans(
    part: pa.Array, kinds: np.ndarray, trie: Trie, unlisted: int, longest: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens of the texts: starts and ends in their text, bytes of each term, all these bytes; tokens up to each text.

    Tokens are found by the place of their first character among all texts.
    """
    flat = pc.fill_null(part, "").cast(pa.large_string())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    edges = np.concatenate([[0], np.cumsum(np.asarray(pc.utf8_length(flat), np.int64))])
    kind = kinds[codes]
    new = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == 0))[:len(codes)]
    new[edges[edges < len(codes)]] = True
    starts = np.flatnonzero(new)
    stops = np.append(starts, len(codes))[1:]
    chinese = kind[starts] == 2
    long = chinese & (stops - starts > LONG_RUN)
    ends = np.zeros(len(codes), np.int64)  # of the token that starts at a character, 0 if none does
    ends[starts[~chinese]] = stops[~chinese]
    _ends_of_runs(codes, starts[chinese & ~long], stops[chinese & ~long], trie, unlisted, ends)
    for a, b in zip(starts[long].tolist(), stops[long].tolist()):
        run = codes[a:b].tobytes().decode("utf-32-le")
        begin, length, cost = trie.words_in(np.append(trie.numbered(codes[a:b]), 0))
        costs = {run[i:i + n]: c for i, n, c in zip(begin.tolist(), length.tolist(), cost.tolist())}
        found = np.array(list(run_spans(best_path(run, costs.get, unlisted, longest))), np.int64) + a
        ends[found[:, 0]] = found[:, 1]
    first = np.flatnonzero(ends)
    end = ends[first]
    sizes = byte_at[end] - byte_at[first]
    at = np.concatenate([[0], np.cumsum(sizes)])
    if at[-1] == len(data) and (end[:-1] == first[1:]).all():
        terms = data
    else:  # pairs overlap
        terms = data[np.repeat(byte_at[first] - at[:-1], sizes) + np.arange(at[-1])]
    held = np.searchsorted(first, edges)
    shift = np.repeat(edges[:-1], np.diff(held))
    return first - shift, end - shift, sizes, terms, held


def _cut_texts(column: pa.Array, kinds: np.ndarray, trie: Trie, unlisted: int, longest: int) -> pa.Array:
    """Tokens with offsets of each text, slice by slice, each put where the result has it: no slice is held twice."""
    texts = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64))
    most = pc.sum(pc.utf8_length(column)).as_py() or 0  # memory that no token reaches is never touched
    starts, ends, terms_at = np.empty(most, np.int64), np.empty(most, np.int64), np.zeros(most + 1, np.int32)
    terms, held = np.empty(2 * (texts[-1] if len(texts) else 0), np.uint8), np.zeros(len(column) + 1, np.int32)
    at = tokens = size = 0
    while at < len(column):
        stop = max(int(np.searchsorted(texts, (texts[at - 1] if at else 0) + 3 * SLICE_CHARACTERS, "right")), at + 1)
        start, end, sizes, term, upto = _slice_spans(column.slice(at, stop - at), kinds, trie, unlisted, longest)
        here = slice(tokens, tokens + len(start))
        starts[here], ends[here], terms_at[tokens + 1:tokens + len(start) + 1] = start, end, size + np.cumsum(sizes)
        terms[size:size + len(term)] = term
        held[at + 1:stop + 1] = tokens + upto[1:]
        at, tokens, size = stop, tokens + len(start), size + len(term)
    spans = pa.StructArray.from_arrays([
        pa.Array.from_buffers(pa.string(), tokens, [None, pa.py_buffer(terms_at[:tokens + 1]), pa.py_buffer(terms[:size])]),
        pa.array(starts[:tokens]), pa.array(ends[:tokens])], fields=list(_ARROW_SPANS.value_type))
    return pa.ListArray.from_arrays(pa.array(held), spans, _ARROW_SPANS, mask=column.is_null())


def _cut(column: pa.Array, cost_of: Callable[[int], Callable[[str], int | None]], unlisted: int, longest: int) -> pa.Array:
    """Tokens with offsets of each row of pieces, slice by slice; ``cost_of`` gives the costs of a row's words."""
    done, at = [pa.array([], _ARROW_SPANS)], 0
    pieces = pc.cumulative_sum(pc.binary_length(column.flatten())).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64))
    sizes = np.append(pieces, 0)[ends - 1] * (ends > 0) if len(pieces) else ends
    while at < len(column):
        stop = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 3 * SLICE_CHARACTERS, "right")), at + 1)
        part, ends_here, terms, starts, stops = column.slice(at, stop - at), [0], [], [], []
        for row, x in enumerate(part.to_pylist(), at):
            for term, start, end in spans_of(x or (), cost_of(row), unlisted, longest):
                terms.append(term)
                starts.append(start)
                stops.append(end)
            ends_here.append(len(terms))
        spans = pa.StructArray.from_arrays(
            [pa.array(terms, pa.string()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
            fields=list(_ARROW_SPANS.value_type))
        done.append(pa.ListArray.from_arrays(pa.array(ends_here, pa.int32()), spans, _ARROW_SPANS, mask=part.is_null()))
        at = stop
    return pa.concat_arrays(done)


def with_tokens(
    docs: DataFrame,
    ids: Sequence[str],
    dictionary: DataFrame,
    columns: dict[str, str] | None = None,
    max_rows: int = DICTIONARY_ROWS,
    max_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """``docs`` with the tokens of text columns, each as ``array<struct<term, startpos, endpos>>``.

    ``columns`` says which text goes to which column, ``{"text": "tokens"}`` if left out; all are cut in
    one step. ``ids`` name a row; they are only used beyond the bounds of the dictionary. A null text
    gives null. Measures and materialises the dictionary when called. The texts should be columns of a
    stored table: Spark can't always take a Python function apart from the lambdas of its argument.
    """
    columns = columns or {"text": "tokens"}
    words, unlisted, longest = word_costs(dictionary)
    kind = "struct<" + ", ".join(f"c{k}: {SPANS}" for k in range(len(columns))) + ">"

    def named(found: Iterable[pa.Array]) -> pa.Array:
        found = list(found)
        return pa.StructArray.from_arrays(found, [f"c{k}" for k in range(len(found))])

    if broadcast_within(words, max_rows, max_bytes, "word") is not None:
        trie = Trie.of({r.word: r.cost for r in words.toLocalIterator()})
        # plain arrays need no class of this package
        shared = docs.sparkSession.sparkContext.broadcast((word_characters(docs.sparkSession), *trie))

        @F.arrow_udf(kind)
        def cut(*texts: pa.Array) -> pa.Array:
            kinds, *trie = shared.value
            return named(_cut_texts(column, kinds, Trie(*trie), unlisted, longest) for column in texts)

        found = docs.withColumn("__found", once(cut)(*(F.make_valid_utf8(c) for c in columns)))
    else:
        pieces = [F.regexp_extract_all(F.col(c), F.lit(PIECE), F.lit(0)) for c in columns]

        @F.arrow_udf(kind)
        def cut_with(*texts: pa.Array) -> pa.Array:
            *texts, listed = texts
            return named(_cut(column, lambda row: {w["word"]: w["cost"] for w in listed[row].as_py() or ()}.get,
                              unlisted, longest) for column in texts)

        parts = F.array_distinct(F.concat(*(
            F.coalesce(_substrings(p, longest), F.array().cast("array<string>")) for p in pieces)))
        held = docs.select(*ids, F.explode(parts).alias("word")).join(words, "word")
        own = held.groupBy(*ids).agg(F.collect_list(F.struct("word", "cost")).alias("__words"))
        found = docs.join(own, list(ids), "left").withColumn("__found", once(cut_with)(*pieces, F.col("__words"))).drop("__words")
    return found.withColumns({to: F.col(f"__found.c{k}") for k, to in enumerate(columns.values())}).drop("__found")


def _substrings(pieces: Column, longest: int) -> Column:
    """The distinct parts of the Chinese runs that may be words."""
    runs = F.filter(pieces, lambda p: p.rlike(f"^{CJK}"))

    def parts(run: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(run))
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(longest), F.length(run) - i + 1)), lambda k: F.substring(run, i, k))))

    return F.array_distinct(F.flatten(F.transform(runs, parts)))
