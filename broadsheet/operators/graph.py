"""Graph ranking of terms: co-occurrence pairs, the undirected term graph and its ranks.

Pairs and graph are built inside the document's row. Ranking is an in-place iteration whose
result depends on the update order, so it cannot be a join per round; it runs in Arrow batches in
which all documents of a batch advance together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    KEYWORD_STOP_WORDS,
    RANK_DAMPING,
    RANK_POS,
    RANK_ROUNDS,
    RANK_SPAN,
)
from ..functions.text import bind, count_values, is_keyword, token_array
from .keywords import explode_tokens, join_allowed, keyword_rows, top_terms

TOKENS_PER_CHUNK = 2_000_000

# Ship this module's functions with the job, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def kept_tokens(
    docs: DataFrame,
    ids: Sequence[str],
    text: str = "text",
    stop_words: Iterable[str] = KEYWORD_STOP_WORDS,
    lexicon: DataFrame | None = None,
    allow_pos: Iterable[str] = RANK_POS,
    with_flag: bool = False,
) -> DataFrame:
    """``(ids, kept)``: the tokens that may be paired, with their positions among **all** tokens.

    With a lexicon only terms of an allowed part of speech stay (none if ``allow_pos`` is empty);
    the look-up needs token rows, which are then gathered again per document. With ``with_flag``
    a term is ``word/flag``.
    """
    if lexicon is None:
        kept = F.filter(
            F.transform(
                token_array(docs, text), lambda t, i: F.struct(i.alias("pos"), t.alias("term"))
            ),
            lambda t: is_keyword(t["term"], stop_words),
        )
        return docs.select(*ids, kept.alias("kept"))
    allow_pos = tuple(allow_pos)
    rows = keyword_rows(explode_tokens(docs, ids, text), stop_words)
    if allow_pos:
        rows = join_allowed(rows, lexicon, allow_pos)
    else:
        rows = rows.limit(0).withColumn("flag", F.lit(""))
    term = F.concat_ws("/", "term", "flag") if with_flag else F.col("term")
    gathered = F.sort_array(F.collect_list(F.struct("pos", term.alias("term"))))
    return rows.groupBy(*ids).agg(gathered.alias("kept"))


def _pairs(kept: Column, span: int) -> Column:
    """Ordered pairs ``struct<src, dst>`` of kept tokens at distance 1 to ``span - 1``."""

    def following(token: Column, i: Column, all_kept: Column) -> Column:
        near = F.filter(
            F.slice(all_kept, i + 2, F.lit(span - 1)),
            lambda other: other["pos"] - token["pos"] < span,
        )
        return F.transform(
            near, lambda other: F.struct(token["term"].alias("src"), other["term"].alias("dst"))
        )

    return F.flatten(F.transform(kept, lambda t, i: following(t, i, kept)))


def cooccurrence(kept: DataFrame, ids: Sequence[str], span: int = RANK_SPAN) -> DataFrame:
    """``(ids, src, dst, w)``: how often ``dst`` follows ``src`` within the span."""
    pairs = F.inline(count_values(_pairs(F.col("kept"), span))).alias("pair", "w")
    return kept.select(*ids, pairs).select(*ids, "pair.src", "pair.dst", "w")


def term_graph(kept: DataFrame, ids: Sequence[str], span: int = RANK_SPAN) -> DataFrame:
    """Both directions of every pair added up: ``(ids, src, dst, w)``; a self-pair counts twice."""

    def undirected(pairs: Column) -> Column:
        turned = F.transform(
            pairs, lambda p: F.struct(p["dst"].alias("src"), p["src"].alias("dst"))
        )
        return count_values(F.concat(pairs, turned))

    edges = F.inline(bind(_pairs(F.col("kept"), span), undirected)).alias("pair", "w")
    return kept.select(*ids, edges).select(*ids, "pair.src", "pair.dst", "w")


def node_strength(kept: DataFrame, ids: Sequence[str], span: int = RANK_SPAN) -> DataFrame:
    """``(ids, src, strength)``: the adjacent weights of a node, a self-pair counted twice.

    Every pair gives one unit to each of its ends, so the ends are counted directly.
    """
    ends = bind(
        _pairs(F.col("kept"), span),
        lambda p: count_values(F.concat(
            F.transform(p, lambda e: e["src"]), F.transform(p, lambda e: e["dst"])
        )),
    )
    return kept.select(*ids, F.inline(ends).alias("src", "strength"))


def _rank_chunk(doc: np.ndarray, pos: np.ndarray, term: np.ndarray, rounds: int, span: int):
    """Ranks of the term graphs of many documents; arrays are sorted by (doc, pos).

    Returns ``(doc, term, rank)`` arrays. Nodes update in place in ascending term order; step ``i``
    updates node ``i`` of every document, which is the same as going through each alone.
    """
    width = int(term.max(initial=0)) + 1
    key = doc * width + term
    head, tail = [], []
    for distance in range(1, span):
        a, b = slice(None, -distance), slice(distance, None)
        near = (doc[a] == doc[b]) & (pos[b] - pos[a] < span)
        head.append(key[a][near])
        tail.append(key[b][near])
    head, tail = np.concatenate(head), np.concatenate(tail)
    nodes, ends = np.unique(np.concatenate([head, tail]), return_inverse=True)
    if not len(nodes):
        return nodes, nodes, nodes.astype(float)
    src, dst = ends, np.roll(ends, len(head))
    edge, weight = np.unique(src.astype(np.int64) * len(nodes) + dst, return_counts=True)
    src, dst = edge // len(nodes), edge % len(nodes)

    node_doc = nodes // width
    first = np.flatnonzero(np.r_[True, node_doc[1:] != node_doc[:-1]])
    size = np.diff(np.r_[first, len(nodes)])
    local = np.arange(len(nodes)) - np.repeat(first, size)
    order = np.lexsort((dst, src, local[src]))
    src, dst, weight = src[order], dst[order], weight[order]
    strength = np.bincount(src, weights=weight, minlength=len(nodes))
    share = weight / strength[dst]
    starts = np.flatnonzero(np.r_[True, src[1:] != src[:-1]])
    stepped = src[starts]
    bounds = np.searchsorted(local[stepped], np.arange(size.max() + 1))
    edge_at = np.r_[starts, len(src)]

    rank = np.repeat(1.0 / size, size)
    for _ in range(rounds):
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            e0, e1 = edge_at[lo], edge_at[hi]
            flow = np.add.reduceat(share[e0:e1] * rank[dst[e0:e1]], starts[lo:hi] - e0)
            rank[stepped[lo:hi]] = (1 - RANK_DAMPING) + RANK_DAMPING * flow
    low = np.repeat(np.minimum.reduceat(rank, first), size) / 10.0
    high = np.repeat(np.maximum.reduceat(rank, first), size)
    return node_doc, nodes % width, (rank - low) / (high - low)


def _rank_batches(ids: Sequence[str], rounds: int, span: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("kept")
            lengths = np.asarray(pc.fill_null(pc.list_value_length(kept), 0))
            ends = np.cumsum(lengths)
            at = 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                upto = max(int(np.searchsorted(ends, before + TOKENS_PER_CHUNK, "right")), at + 1)
                part = batch.slice(at, upto - at)
                flat = part.column("kept").flatten()
                coded = pc.dictionary_encode(flat.field("term"))
                by_term = pc.array_sort_indices(coded.dictionary).to_numpy()
                code = np.empty(len(by_term), np.int64)
                code[by_term] = np.arange(len(by_term))
                term = code[coded.indices.to_numpy()] if len(by_term) else code
                doc, term, value = _rank_chunk(
                    np.repeat(np.arange(upto - at), lengths[at:upto]),
                    flat.field("pos").to_numpy(), term, rounds, span,
                )
                ranked = pa.StructArray.from_arrays(
                    [coded.dictionary.take(pa.array(by_term[term])), pa.array(value)], ["term", "rank"])
                ends_here = np.searchsorted(doc, np.arange(upto - at + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ids), pa.ListArray.from_arrays(pa.array(ends_here), ranked)],
                    names=[*ids, "ranked"],
                )
                at = upto

    return rank


def rank_arrays(
    kept: DataFrame, ids: Sequence[str], rounds: int = RANK_ROUNDS, span: int = RANK_SPAN
) -> DataFrame:
    """``(ids, ranked)``: the ranks of the terms of each row, ``array<struct<term, rank>>``."""
    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in ids) + ", ranked array<struct<term: string, rank: double>>"
    return kept.select(*ids, "kept").mapInArrow(_rank_batches(ids, rounds, span), schema)


def textrank(
    kept: DataFrame, ids: Sequence[str], rounds: int = RANK_ROUNDS, span: int = RANK_SPAN
) -> DataFrame:
    """``(ids, term, weight)``: rank of every term of the document's graph, scaled to at most 1.

    Ranks start at ``1/n`` and are updated in place, in term order, ``rounds`` times. Documents
    stay where they are: each row is ranked in the task that holds it, no shuffle.
    """
    ranked = rank_arrays(kept, ids, rounds, span)
    return ranked.select(*ids, F.inline("ranked").alias("term", "weight"))


def textrank_keywords(
    docs: DataFrame,
    ids: Sequence[str],
    text: str = "text",
    k: int | None = 20,
    stop_words: Iterable[str] = KEYWORD_STOP_WORDS,
    lexicon: DataFrame | None = None,
    allow_pos: Iterable[str] = RANK_POS,
    with_weight: bool = True,
    with_flag: bool = False,
) -> DataFrame:
    """The ``k`` best terms per document by graph rank: ``(ids, term[, flag], weight, rank)``."""
    kept = kept_tokens(docs, ids, text, stop_words, lexicon, allow_pos, with_flag)
    flagged = with_flag and lexicon is not None and bool(tuple(allow_pos))
    key = ["term", "flag"] if flagged else ["term"]

    def named(t: Column) -> Column:
        term = t["term"]
        parts = (
            [F.regexp_replace(term, "/[^/]*$", "").alias("term"), F.regexp_extract(term, "([^/]*)$", 1).alias("flag")]
            if flagged else [term.alias("term")])
        return F.struct((-F.round(t["rank"], 6)).alias("order"), *parts, t["rank"].alias("weight"))

    # a row gives at most k terms: the others are cut before anything is sorted by document
    terms = F.transform("ranked", named)
    terms = F.slice(F.sort_array(terms), 1, k) if k else terms
    ranked = rank_arrays(kept, ids).select(*ids, F.inline(terms)).drop("order")
    best = top_terms(ranked, ids, k, key=key)
    return best.select(*ids, *key, *(("weight",) if with_weight else ()), "rank")
