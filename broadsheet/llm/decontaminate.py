"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and underscores in lower case. Karp-Rabin hashes of five-word
seeds are joined with those of the benchmark items. Between a document and an item that share a
seed, the longest match of unmarked words is marked again and again until no match of five words is
left, so passages in another order are found as well. An item whose marked words reach ``COVERAGE``
of its words is contained in the document.

The items are a query set against all documents: they are sent to the tasks in blocks of at most
about ``BLOCK_CHARS`` characters, one pass over the documents for each block. Documents stay in
their rows; nothing is shuffled.

Edge cases: null texts are empty; an item with fewer than five words has no seed and is never found;
repeated items and documents are reported for each row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED, COVERAGE = 5, 0.8
BLOCK_CHARS = 1 << 23

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
TILES = "array<struct<item_id: bigint, matched: int, words: int, coverage: double, " \
        "tiles: array<struct<item_start: int, doc_start: int, length: int>>>>"
_TILE = pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())])
_FOUND = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("matched", pa.int32()), ("words", pa.int32()),
    ("coverage", pa.float64()), ("tiles", pa.list_(_TILE)),
]))


def rolling(ids: np.ndarray, size: int = SEED) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` numbers."""
    n = len(ids) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        total = total * _BASE + ids[k: k + n]
    return total


def tile(item_at: np.ndarray, doc_at: np.ndarray, size: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(item start, document start, length)`` from the places of equal seeds.

    The longest run of seeds on a diagonal is marked first, of equal ones the first in the item,
    then in the document; seeds that touch marked words are dropped before the next turn.
    """
    tiles = []
    order = np.lexsort((item_at, doc_at - item_at))
    i, j = item_at[order], doc_at[order]
    while len(i):
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)
        starts = np.flatnonzero(new)
        runs = np.diff(np.append(starts, len(i)))
        best = starts[np.lexsort((j[starts], i[starts], -runs))[0]]
        length = int(runs[np.searchsorted(starts, best)]) + size - 1
        a, b = int(i[best]), int(j[best])
        tiles.append((a, b, length))
        free = ((i + size <= a) | (i >= a + length)) & ((j + size <= b) | (j >= b + length))
        i, j = i[free], j[free]
    return tiles


class Items:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, rows: list[tuple[int | None, str | None]]) -> None:
        self.numbers: dict[str, int] = {}
        self.items = []
        hashes, owners, places = [], [], []
        for item_id, text in rows:
            words = _WORD.findall((text or "").lower())
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.uint64)
            seeds = rolling(ids)
            hashes.append(seeds)
            owners.append(np.full(len(seeds), len(self.items)))
            places.append(np.arange(len(seeds)))
            self.items.append((item_id, ids))
        joined = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.owners = np.concatenate([np.zeros(0, np.int64), *owners])[order]
        self.places = np.concatenate([np.zeros(0, np.int64), *places])[order]

    def search(self, text: str | None, coverage: float) -> list[dict]:
        if not text or not len(self.hashes):
            return []
        words = _WORD.findall(text.lower())
        ids = np.fromiter(map(self.numbers.get, words, [0] * len(words)), np.uint64, len(words))
        seeds = rolling(ids)
        low = np.searchsorted(self.hashes, seeds)
        at = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == seeds)
        if not len(at):
            return []
        low = low[at]
        count = np.searchsorted(self.hashes, seeds[at], "right") - low
        doc_at = np.repeat(at, count)
        hit = np.repeat(low, count) + np.arange(len(doc_at)) - np.repeat(np.cumsum(count) - count, count)
        owner, item_at = self.owners[hit], self.places[hit]
        found = []
        for k in np.unique(owner):
            item_id, item = self.items[k]
            i, j = item_at[owner == k], doc_at[owner == k]
            same = np.ones(len(i), bool)
            for s in range(SEED):
                same &= item[i + s] == ids[j + s]
            tiles = tile(i[same], j[same])
            matched = sum(length for *_, length in tiles)
            if matched >= coverage * len(item):
                found.append({
                    "item_id": item_id, "matched": matched, "words": len(item),
                    "coverage": matched / len(item),
                    "tiles": [dict(zip(("item_start", "doc_start", "length"), t)) for t in sorted(tiles)],
                })
        return found


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[list[tuple]]:
    """The items in blocks of bounded size. Runs a job for each block when called."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-chars // block_chars)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    return [[tuple(r) for r in items.where(part == b).collect()] for b in range(n)]


def contained(text: str, rows: list[tuple], coverage: float = COVERAGE, session=None) -> Column:
    """The items of one block that a text contains, as ``TILES``."""
    shared = session.sparkContext.broadcast(rows)
    ready: list[Items] = []

    @F.arrow_udf(TILES)
    def search(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Items(shared.value))
        return pa.array([ready[0].search(t.as_py(), coverage) for t in texts], _FOUND)

    return search(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id`` and a row for each item that the document contains."""
    session = docs.sparkSession
    texts = docs.select("doc_id", "text")
    out = session.createDataFrame([], f"doc_id bigint, found {TILES}")
    for rows in blocks(benchmark):
        out = out.unionByName(texts.select("doc_id", contained("text", rows, coverage, session).alias("found")))
    return out.select("doc_id", F.explode("found").alias("found")).select("doc_id", "found.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    rest = docs.select(F.struct("*").alias("row"))
    for rows in blocks(benchmark):
        found = contained("row.text", rows, coverage, docs.sparkSession)
        rest = rest.select("row", found.alias("found")).where(F.size("found") == 0).select("row")
    return rest.select("row.*")
