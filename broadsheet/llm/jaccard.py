"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and n-grams columns of a 0/1 matrix M; the off-diagonal counts of M x M' are the
overlaps. Two sets of sizes a <= b link at ``PERCENT`` only if 100 a >= PERCENT b and their overlap is
at least ``needed(a, b)``, so most of the product is never formed:

* Rows with equal sets are one row, and their documents are members of it.
* The columns of a row are in one global order, rare ones first. The first block of a row, its
  *prefix*, is so long that two rows that link share a column of it (n - needed + 1 columns). Only
  this block is multiplied column by column, in cells of the rows that hold a column. Which columns are
  frequent is counted over the prefixes of all rows in hash order; any order gives the same links, so
  the table of the most frequent ones may be bounded (``MAX_LEVELS``).
* In a cell, sizes bound the partners of a row to a range, and 256 parities of the columns of each row
  bound the overlap from above (each parity that differs is a column that only one row has).
* Two rows that share many columns meet in many cells, but only the first one in the order counts. There,
  the places of its column in both rows bound the overlap. Each entry has the last ``BEFORE`` shared columns
  before it, and rows with one of them in common have met already.
* What is left is counted, first over the prefixes, then over the other column blocks, ranges of the
  hash values, and a pair is discarded as soon as its count and the rest of its blocks can't reach
  the bound.

Classes need no more than a spanning forest. So each row of a larger cell first meets the nearest row
there, and the links found are contracted; only then are all other pairs of different classes in larger
cells counted. Groups of copies thus make about as many pairs as rows; rows that almost link with a whole
group still meet much of it.
Cells of more than ``HOT`` rows are dealt out as pairs of blocks. No link is lost and nothing is capped.

N-grams are compared by 64-bit hashes, sets by 128-bit digests of them. No matrix is stored and no text
is shuffled: columns are made from the texts where these lie, once for the frequent columns, once for
the prefixes and, of rows with candidates only, for the counts. The keys of such rows are broadcast
within a checked bound; beyond it texts are joined by shuffle.

Edge cases: a null text or one without words has the empty set, which links with nothing; a text of
fewer words than an n-gram has one column, all its words. A row with a null id gets the smallest other
id of its class, or null if there is none. Repeated rows are members of one class.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_within, written
from .simhash import components

SHINGLE, PERCENT = 3, 90
#: Prefix lengths of each row over which columns are counted.
COUNTED = 2
#: Columns of more rows than this get a level, by which rows are ordered.
FREQUENT = 16
#: Bound of the broadcast table of frequent columns: 2 x 8 bytes each.
MAX_LEVELS = 500_000
#: Bounds of the broadcast keys of rows that are counted.
WANTED_ROWS, WANTED_BYTES = 2_000_000, 32 << 20
#: Entries of prefixes that a task adds up before it passes them on.
ENTRIES_AT_ONCE = 1_000_000
#: Cells of more rows are dealt out as pairs of blocks of about so many.
HOT = 4096
#: Cells up to this size are compared all at once, larger ones row by row.
SMALL = 8
#: Shared columns before a column by which rows tell that they have met in an earlier cell.
BEFORE = 8
#: Blocks of columns in which overlaps are counted.
COLUMN_BLOCKS = 8
REMEMBERED = 400_000

_WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def needed(a, b, percent: int = PERCENT):
    """The least overlap of linked sets of ``a`` and ``b`` columns."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def columns(text: str | None, known: dict, size: int = SHINGLE) -> np.ndarray:
    """The distinct columns of a text, ascending."""
    words = _WORDS.findall(text.encode("utf-8", "replace").translate(_LOWER)) if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    rows = len(words) - size + 1
    value = np.full(rows, size, np.uint64)
    for k in range(size):
        value = (value ^ hashes[k: k + rows]) * _ODD[k % 3]
        value ^= value >> np.uint64(29)
    value *= _ODD[1]
    return np.unique(value ^ value >> np.uint64(32))


def parities(values: np.ndarray) -> np.ndarray:
    """For each of 256 classes of columns whether an odd number of them is there."""
    counts = np.bincount((values >> np.uint64(7) & np.uint64(255)).astype(np.int64), minlength=256)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.uint64)


class Order:
    """Columns in ascending (level, hash); a column that isn't listed has level 0."""

    def __init__(self, listed: np.ndarray = np.empty(0, np.uint64), levels: np.ndarray = np.empty(0, np.int64)) -> None:
        by = np.argsort(listed)
        self.listed, self.levels = listed[by], levels[by]

    def level(self, values: np.ndarray) -> np.ndarray:
        if not len(self.listed):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.listed, values), len(self.listed) - 1)
        return np.where(self.listed[at] == values, self.levels[at], 0)

    def prefix(self, values: np.ndarray, percent: int) -> np.ndarray:
        length = prefix_length(len(values), percent)
        if len(self.listed):
            values = values[np.argsort(self.level(values), kind="stable")]
        return values[:length]

    def missing(self, a: np.ndarray, b: np.ndarray) -> int:
        """How many columns of the prefix ``a`` surely aren't in the row that begins with ``b``."""
        level, last = self.level(a), self.level(b[-1:])[0]
        before = (level < last) | ((level == last) & (a <= b[-1]))
        return int(before.sum() - np.isin(a[before], b).sum())


def _key(text):
    """What stands for a text when it is looked up again."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def frequent(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, limit: int | None = None) -> Order:
    """The order of the columns, from their counts in the beginnings of all rows in hash order.

    The beginning is longer than the prefix, so that what follows a frequent column is counted too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, entries = _Words(), [], 0

        def added() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], ["col", "rows"])

        for batch in batches:
            for text in batch.column(0):
                values = columns(text.as_py(), known, size)
                held.append(values[: COUNTED * prefix_length(len(values), percent)])
                entries += len(held[-1])
                if entries > ENTRIES_AT_ONCE:
                    yield added()
                    held, entries = [], 0
        if held:
            yield added()

    counts = docs.select("text").mapInArrow(count, "col long, rows long").groupBy("col").agg(F.sum("rows").alias("rows"))
    most = counts.where(F.col("rows") > FREQUENT).orderBy(F.desc("rows"), "col").limit(limit or MAX_LEVELS).select(
        "col", F.floor(F.log2("rows")).cast("long").alias("level")).toPandas()
    return Order(most["col"].to_numpy(np.int64).view(np.uint64), most["level"].to_numpy(np.int64))


def describe(docs: DataFrame, order: Order = Order(), size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, key, n, digest, prefix, bits``: the row of each document."""
    shared = docs.sparkSession.sparkContext.broadcast((order.listed, order.levels))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order = _Words(), Order(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = []
                for text in batch.column(2):
                    values = columns(text.as_py(), known, size)
                    rows.append((len(values), hashlib.blake2b(values.tobytes(), digest_size=16).digest(),
                                 order.prefix(values, percent).tobytes(), parities(values).tobytes()))
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.record_batch(
                    [batch.column(0), batch.column(1), *(pa.array(x, t) for x, t in zip(zip(*rows), kinds))],
                    ["doc_id", "key", "n", "digest", "prefix", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("text")).alias("key"), "text").mapInArrow(
        read, "doc_id long, key binary, n long, digest binary, prefix binary, bits binary")


def whole_rows(docs: DataFrame, wanted: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``node, row``: all columns of each ``wanted(node, key)``, from its text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = [columns(text.as_py(), known, size).tobytes() for text in batch.column(1)]
                yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary())], ["node", "row"])

    bounded = broadcast_within(wanted, WANTED_ROWS, WANTED_BYTES, "key")
    texts = docs.select(_key(F.col("text")).alias("key"), "text").join(wanted if bounded is None else bounded, "key")
    # copies of a text give the same row
    return texts.select("node", "text").mapInArrow(read, "node long, row binary").groupBy("node").agg(F.min("row").alias("row"))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes to one row a column, with its place in the prefix."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            lists = [np.frombuffer(x.as_py(), np.int64) for x in part.column(1)]
            sizes = np.array([len(x) for x in lists])
            if sizes.sum():
                node = np.repeat(part.column(0).to_numpy(), sizes)
                place = np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes)
                yield pa.record_batch([pa.array(node), pa.array(np.concatenate(lists)), pa.array(place)], ["node", "col", "place"])


def entries(sets: DataFrame) -> DataFrame:
    """The first column block of the matrix: ``node, col, place``, places in the order of columns."""
    return sets.select("node", "prefix").mapInArrow(_unpack, "node long, col long, place long")


def _partners(keys: np.ndarray, n: np.ndarray, root: np.ndarray, place: np.ndarray, bits: np.ndarray, before: np.ndarray,
              nearest: bool, percent: int):
    """Positions of pairs that may link, of rows sorted by (cell, n) with whole cells.

    A pair counts where it meets first: there, the rows share no column before this one, so its places
    bound the overlap. Pairs that have surely met are left out.
    """
    def possible(a, b):
        bound = needed(n[a], n[b], percent)
        differ = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=-1, dtype=np.int64)
        reached = np.minimum(n[a] - place[a], n[b] - place[b]) >= bound
        ok = (root[a] != root[b]) & (100 * n[a] >= percent * n[b]) & reached & (differ <= n[a] + n[b] - 2 * bound)
        ok[ok] = ~met(a[ok], b[ok])
        return ok, differ

    def met(a, b):
        real = before[a] != keys[a, :1]
        return ((before[a][:, :, None] == before[b][:, None, :]) & real[:, :, None]).any(axis=(1, 2))

    starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    sizes = np.diff(np.append(starts, len(keys)))
    small, group = np.repeat(sizes <= SMALL, sizes), np.repeat(np.arange(len(starts)), sizes)
    for lag in range(1, min(SMALL, int(sizes.max(initial=0)))):
        at = np.flatnonzero(small[lag:] & (group[lag:] == group[:-lag]))
        if not len(at):
            break
        ok, _ = possible(at, at + lag)
        yield at[ok], at[ok] + lag
    for g in np.flatnonzero(sizes > SMALL):
        first, stop = starts[g], starts[g] + sizes[g]
        reach = first + np.searchsorted(n[first:stop], 100 * n[first:stop] // percent, "right")
        for i in range(first, stop - 1):
            others = np.arange(i + 1, reach[i - first])
            if len(others):
                ok, differ = possible(np.full(len(others), i), others)
                if ok.any():
                    others = others[ok][[differ[ok].argmin()]] if nearest else others[ok]
                    yield np.full(len(others), i), others


def _before(lists: pa.ListArray, cols: np.ndarray) -> np.ndarray:
    """``BEFORE`` columns a row; what is missing is the row's own column."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    table = np.repeat(cols[:, None], BEFORE, axis=1)
    table[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes)] = (
        lists.flatten().to_numpy(zero_copy_only=False))
    return table


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Arrays of the columns of sorted batches, cut between cells ``(col, cell)``."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1),
               *(batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)),
               np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint64).reshape(-1, 4)]
        now.append(_before(batch.column(7), now[0][:, 0]))
        differs = (now[0] != now[0][-1]).any(axis=1)
        last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if last or (held and (held[-1][0][-1] != now[0][0]).any()):
            held.append([x[:last] for x in now])
            yield [np.concatenate(x) for x in zip(*held)]
            held = []
        held.append([x[last:] for x in now])
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def candidates(cells: DataFrame, rows: DataFrame, nearest: bool, percent: int = PERCENT) -> DataFrame:
    """Distinct pairs ``a < b`` of nodes of different roots that may link.

    ``cells(col, cell, node, place, before)``, ``rows(node, n, root, bits)``. With ``nearest`` each row of a
    large cell gives its most similar partner only.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, node, root, *others in _whole_cells(batches):
            pairs = list(_partners(keys, n, root, *others, nearest, percent))
            if pairs:
                a, b = (node[np.concatenate(x)] for x in zip(*pairs))
                low, high = np.minimum(a, b), np.maximum(a, b)
                pair = np.unique(np.stack([low, high], axis=1), axis=0)
                yield pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    return (
        cells.join(rows, "node").select("col", "cell", "n", "node", "root", "place", "bits", "before")
        .repartition("col", "cell").sortWithinPartitions("col", "cell", "n", "node")
        .mapInArrow(compare, "a long, b long").distinct()
    )


def overlap_reaches(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two rows link: overlaps are added up over column blocks until the bound decides."""
    bound, count = needed(len(a), len(b), percent), 0
    if min(len(a), len(b)) < bound:
        return False
    limits = (np.arange(1, COLUMN_BLOCKS, dtype=np.uint64) * np.uint64((1 << 64) // COLUMN_BLOCKS))
    at, to = ([0, *np.searchsorted(x, limits).tolist(), len(x)] for x in (a, b))
    for k in range(COLUMN_BLOCKS):
        x, y = a[at[k]: at[k + 1]], b[to[k]: to[k + 1]]
        if len(x) and len(y):
            near = np.searchsorted(y, x)
            count += int((y[np.minimum(near, len(y) - 1)] == x).sum())
        if count >= bound:
            return True
        if count + min(len(a) - at[k + 1], len(b) - to[k + 1]) < bound:
            return False
    return False


def _joined(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b`` and the other columns of ``rows(node, ...)`` of both."""
    for c in "ab":
        pairs = pairs.join(rows.select(*(F.col(x).alias(c if x == "node" else f"{x}_{c}") for x in rows.columns)), c)
    return pairs


def _nodes(pairs: DataFrame) -> DataFrame:
    """The nodes of written pairs, written; broadcast within a bound."""
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    bounded = broadcast_within(nodes, WANTED_ROWS, WANTED_BYTES, F.lit("8 bytes."))
    return nodes if bounded is None else bounded


def count_pairs(docs: DataFrame, sets: DataFrame, pairs: DataFrame, order: Order, size: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """The ``pairs(a, b)`` that link, written."""
    shared = docs.sparkSession.sparkContext.broadcast((order.listed, order.levels))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(*shared.value)
        for batch in batches:
            kept = []
            for n, head, m, other in zip(*(batch.column(i) for i in range(2, 6))):
                n, m, head, other = n.as_py(), m.as_py(), *(np.frombuffer(x.as_py(), np.uint64) for x in (head, other))
                bound = needed(n, m, percent)
                kept.append(n - order.missing(head, other) >= bound and m - order.missing(other, head) >= bound)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = pa.array([
                overlap_reaches(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3))], pa.bool_())
            yield batch.select([0, 1]).filter(linked)

    pairs = written(pairs, "pairs")
    heads = sets.select("node", "n", "prefix").join(_nodes(pairs), "node")
    left = written(_joined(pairs, heads).select("a", "b", "n_a", "prefix_a", "n_b", "prefix_b")
                   .mapInArrow(begin, "a long, b long"), "pairs")
    wanted = written(sets.select("node", "key").join(_nodes(left), "node"), "wanted")
    rows = written(whole_rows(docs, wanted, size), "rows")
    return written(_joined(left, rows).select("a", "b", "row_a", "row_b").mapInArrow(count, "a long, b long"), "links")


def dealt(sets: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """``col, rows, cell, node, place, before`` of the shared columns; hot columns as pairs of blocks of rows.

    ``before`` holds the last shared columns of the row before this one.
    """
    blocks = F.when(F.col("rows") > hot, F.ceil(F.col("rows") / hot)).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                         lambda o: F.least(o, block) * F.col("blocks") + F.greatest(o, block))
    cell = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(spread)
    last = Window.partitionBy("node").orderBy("place").rowsBetween(-BEFORE, -1)
    shared = entries(sets).join(counts.withColumn("blocks", blocks), "col")
    return shared.withColumn("before", F.collect_list("col").over(last)).select(
        "col", "rows", F.explode(cell).alias("cell"), "node", "place", "before")


def roots_of(docs: DataFrame, sets: DataFrame, cells: DataFrame, order: Order, size: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """``node, root`` of the nodes that link with others."""
    rows = sets.select("node", "n", "bits")
    links, roots = None, rows.select("node", F.col("node").alias("root")).limit(0)
    for nearest in (True, False):
        # all pairs of small cells have been counted when the nearest rows have met
        left = cells if nearest else cells.where(F.col("rows") > SMALL)
        here = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        found = count_pairs(docs, sets, candidates(left, here, nearest, percent), order, size, percent)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = written(components(links), "roots")
    return roots


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    order = frequent(docs, size, percent)
    table = written(describe(docs, order, size, percent), "described")
    sets = written(
        table.where("n > 0").groupBy("digest").agg(
            F.min("key").alias("key"), F.min("doc_id").alias("least"), F.min("n").alias("n"),
            F.min("prefix").alias("prefix"), F.min("bits").alias("bits"))
        .withColumn("node", F.monotonically_increasing_id()), "sets")
    counts = entries(sets).groupBy("col").agg(F.count("*").alias("rows")).where("rows > 1")
    cells = written(dealt(sets, written(counts, "column-counts")), "cells")
    roots = roots_of(docs, sets, cells, order, size, percent)
    members = sets.select("node", "digest", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = members.join(least, "root").select("digest", "component_id")
    return table.select("doc_id", "n", "digest").join(classes, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
