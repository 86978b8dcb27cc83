"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits, in three blocks of 22, 21 and 21 bits. If two fingerprints differ in at
most 4 bits, two of the three blocks together hold at most 2 of them. For each pair of blocks the
anchors are the words of the direct sum of two Golay codes: 2^24 anchors, each block has covering
radius 3. A pair within 2 bits has a midpoint within 1 bit of both, so it is enough to replicate
every fingerprint to all anchors within the covering radius plus this half of the threshold: at most
11 anchors for a pair of blocks, 33 in all. Fingerprints are compared only with those at the same
anchor. Every link is found; there is no cap.

Equal fingerprints are one node. At an anchor with many fingerprints a spanning forest is enough for
the classes, so pairs are not listed; anchors with more than ``HOT`` fingerprints are dealt out in
blocks over several tasks.

Edge cases: a null text is empty; a text without words has fingerprint zero and is linked like any
other. A row with a null id gets the smallest other id of its class, or null if there is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import broadcast_within, written

SHINGLE, MAX_BITS = 4, 4
#: Bits that count the blocks from the low end.
BLOCKS = (22, 21, 21)
#: Anchors with more fingerprints are split into blocks of about so many.
HOT = 32_768
#: Groups up to this size list their pairs; larger ones list a spanning forest.
SMALL = 12

_WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def text_fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned number; the work grows with the text's length."""
    if not text:
        return 0
    words = _WORDS.findall(text.encode("utf-8", "replace").translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = min(size, len(words))
    starts = np.concatenate(([0], ends[: len(words) - first] + 1)).tolist()
    stops = ends[first - 1:].tolist()
    hashed = xxhash.xxh64_intdigest
    values = np.array([hashed(joined[a:b], 42) for a, b in zip(starts, stops)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 14):
        part = values[at: at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    majority = (ones * 2 > len(values)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


@F.arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """The fingerprint as a signed long."""
    values = np.fromiter((text_fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
    return pa.array(values.view(np.int64))


#: A generator of the binary Golay code of length 23 (fixed value).
GOLAY = 0b101011100011


def _rest(words: np.ndarray) -> np.ndarray:
    """The remainder of each word by the generator: zero for words of the code."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GOLAY << (bit - 11)), words)
    return words


class Anchors:
    """The nearest word of the Golay code for words of 23 bits, by its 12 leading bits."""

    def __init__(self) -> None:
        errors = np.array([sum(1 << b for b in bits) for n in range(4)
                           for bits in combinations(range(23), n)], np.int64)
        self.high = _rest(np.arange(1 << 12, dtype=np.int64) << 11)
        self.error = np.zeros(1 << 11, np.int64)
        self.error[_rest(errors)] = errors

    def nearest(self, words: np.ndarray) -> np.ndarray:
        syndrome = self.high[words >> 11] ^ (words & 2047)
        return (words ^ self.error[syndrome]) >> 11


def anchor_keys(values: np.ndarray, anchors: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """All (key, position in ``values``) of the anchors to which the fingerprints go."""
    homes, moved, shift = [], [], 0
    for width in BLOCKS:
        words = (values >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
        homes.append(anchors.nearest(words))
        moved.append(anchors.nearest(words[:, None] ^ (1 << np.arange(width))))
        shift += width
    keys, rows = [], []
    for table, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        found = np.concatenate([
            (homes[a] << 12 | homes[b])[:, None],
            moved[a] << 12 | homes[b][:, None],
            homes[a][:, None] << 12 | moved[b],
        ], axis=1) | (table << 24)
        found.sort(axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        keys.append(found[new])
        rows.append(np.nonzero(new)[0])
    return np.concatenate(keys), np.concatenate(rows)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = Anchors()
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(values), 4096):
            part = values[at: at + 4096]
            keys, rows = anchor_keys(part.view(np.uint64), anchors)
            yield pa.record_batch([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def links_within(values: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among distinct ``values``.

    Reached fingerprints are compared with those not reached yet, a few at a time, so that a dense
    group is done after a few steps.
    """
    found, rest = [], values
    while len(rest) > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            front = queue.pop()
            if len(front) > 16:
                queue.append(front[16:])
                front = front[:16]
            near = _bits(front[:, None], rest[None, :]) <= max_bits
            hit = near.any(axis=0)
            if hit.any():
                found.append((front[near[:, hit].argmax(axis=0)], rest[hit]))
                queue.append(rest[hit])
                rest = rest[~hit]
    return found


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the rows of each (key, cell); they come sorted by key, cell and fp.

    Of a cell of two blocks all rows are here, so its links hold all links between the blocks.
    """
    def emit(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(keys)))
        pairs = []
        small = np.repeat(sizes <= SMALL, sizes)
        group = np.repeat(np.arange(len(starts)), sizes)
        for lag in range(1, min(SMALL, int(sizes.max(initial=0)))):
            at = np.flatnonzero(small[lag:] & (group[lag:] == group[:-lag]))
            if not len(at):
                break
            at = at[_bits(values[at], values[at + lag]) <= MAX_BITS]
            pairs.append((values[at], values[at + lag]))
        for g in np.flatnonzero(sizes > SMALL):
            pairs += links_within(values[starts[g]: starts[g] + sizes[g]])
        if pairs:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs))
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
        values = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
        if last or (held and (held[-1][0][-1] != keys[0]).any()):
            held.append((keys[:last], values[:last]))
            yield from emit(*(np.concatenate(x) for x in zip(*held)))
            held = []
        held.append((keys[last:], values[last:]))
    if held:
        yield from emit(*(np.concatenate(x) for x in zip(*held)))


def links(fingerprints: DataFrame, hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` as all pairs within 4 bits do.

    Writes the replicas to the shared folder and counts the rows of each anchor when called.
    """
    replicas = written(
        fingerprints.select("fp").where(F.col("fp").isNotNull()).distinct()
        .mapInArrow(_replicate, "key long, fp long"), "anchors")
    crowded = written(
        replicas.groupBy("key").count().where(F.col("count") > hot)
        .select("key", F.ceil(F.col("count") / hot).cast("int").alias("blocks")), "hot-anchors")
    bounded = broadcast_within(crowded, 100_000, 1 << 21, F.lit(""))
    dealt = replicas.join(crowded if bounded is None else bounded, "key", "left")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        other, lambda o: F.least(o, block) * F.col("blocks") + F.greatest(o, block)))
    return (
        dealt.select("key", F.explode(cells).alias("cell"), "fp")
        .repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
        .mapInArrow(_compare, "a long, b long").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Alternates large-star and small-star steps until the edges stay the same; each round is a table
    in the shared folder, so lineage stays short.
    """
    def marks(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())

    edges = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = marks(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if (now := marks(edges)) == seen:
            break
        seen = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def classes(table: DataFrame) -> DataFrame:
    """``(fp, component_id)`` for each fingerprint of ``table(fp, doc_id)``."""
    nodes = table.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(table))
    joined = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(ids, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs(doc_id, text)``."""
    table = written(docs.select("doc_id", fingerprint("text").alias("fp")), "fingerprints")
    return table.join(classes(table), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class: the one with the smallest ``doc_id`` (null ids last)."""
    table = written(docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"),
        fingerprint("text").alias("fp"), F.monotonically_increasing_id().alias("place"),
    ), "fingerprinted")
    places = table.select("doc_id", "fp", "place")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place"))
    nodes = places.groupBy("fp").agg(first.alias("first"))
    roots = components(links(places))
    kept = (
        nodes.join(roots, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
        .select(F.col("first.place").alias("place"))
    )
    return table.join(kept, "place", "left_semi").select("row.*")
