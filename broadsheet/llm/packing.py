"""Best-fit-decreasing packing of token pieces into sequences of fixed capacity.

Texts are tokenised where they lie and cut into pieces only if they are longer than a sequence. Best
fit needs nothing but the lengths, and there are no more lengths than the capacity, so the plan is
made on the histogram: pieces of one length are placed many at a time, longest first, each into the
open sequences with the tightest remaining capacity, which a segment tree over the capacities finds
in logarithmic time. The result is what best fit decreasing gives piece by piece. The plan is a list
of runs - so many pieces of a length go to so many sequences from a number on - whose size depends
on the capacity, not on the data: a step either ends a length or empties a capacity.

Pieces are numbered within their length by the tasks that write them, and each task's first number comes
from the counts of all, so no length is gathered in one task, though most pieces of long texts have the
same one, and no ids are shuffled.

A tokenizer file whose splitting is the known one is used form by form: texts are cut here, and only forms
not seen before go to its model. With any other file every text goes to the tokenizer whole.

Edge cases: a null or empty text is its closing id alone; repeated rows are packed each.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_within, written

CAPACITY, CLOSING_ID = 2048, 0
#: Word forms that a task remembers.
REMEMBERED = 150_000
#: First ranks, of a length in a task, that are broadcast; more are joined by shuffle.
BROADCAST_STARTS = 1_000_000

#: The splitting of texts that is done here; a tokenizer that splits otherwise gets every text whole.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
          "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}

#: Texts of these characters only are cut into word forms here, as that splitting does; others go to the
#: tokenizer whole.
_PLAIN = re.compile("[\t\n\r -~¡-įı-ɏ‐-‧]*")
_FORMS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+"
                    "|[0-9²³¹¼-¾]"
                    "|[^\\sa-z0-9ª²³µ¹º¼-¾ß-öø-ɏ]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary, by rule: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def splits_as_here(described: dict) -> bool:
    """Whether a tokenizer, as its file describes it, cuts texts into forms that its model encodes one by one."""
    normalizer, pre, model = (described.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    steps = pre.get("pretokenizers", [])
    return (
        normalizer.get("normalizers") == _NORMALIZER and len(steps) == 2 and steps[0] == _SPLIT
        and all(steps[1].get(k) == v for k, v in _BYTES.items()) and model.get("type") == "BPE"
        and not model.get("dropout") and not model.get("unk_token") and not described.get("post_processor")
        and all(t["content"].startswith("<|") for t in described.get("added_tokens", [])))


class _Forms(dict):
    """Ids of word forms as bytes, remembered up to a bound; a new form is encoded by the model alone."""

    def __init__(self, model, remembered: int) -> None:
        self.model, self.remembered = model, remembered

    def __missing__(self, form: str) -> bytes:
        written = form if form.isascii() else form.encode().decode("latin-1").translate(_LETTERS)
        tokens = self.model.tokenize(written)
        ids = b"".join([t.id.to_bytes(4, "little") for t in tokens])
        if len(self) >= self.remembered:
            self.clear()
        self[form] = ids
        return ids


class Encoder:
    """Ids of a text as little-endian unsigned numbers of four bytes, the closing id included."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.quick = splits_as_here(json.load(file))
        self.forms = _Forms(self.tokenizer.model, remembered)
        self.closing = np.array([CLOSING_ID], "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if not self.quick or "<|" in text or not _PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.closing
        forms = _FORMS.findall(unicodedata.normalize("NFC", text).lower())
        return b"".join([*map(self.forms.__getitem__, forms), self.closing])


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids`` of ``docs(doc_id, text)``; ``ids`` is binary."""
    step = capacity * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encoder.encode(text.as_py())
                    rows += [(doc_id, k, a // 4, (min(a + step, len(ids)) - a) // 4, ids[a: a + step])
                             for k, a in enumerate(range(0, len(ids), step))]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch(
                    [pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                    ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary")


class Capacities:
    """A segment tree over the remaining capacities 0..n: how many sequences have each."""

    def __init__(self, n: int) -> None:
        self.leaves = 1 << max(n, 1).bit_length()
        self.total = [0] * (2 * self.leaves)

    def add(self, capacity: int, count: int) -> None:
        at = capacity + self.leaves
        while at:
            self.total[at] += count
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that a sequence has."""
        at = least + self.leaves
        if self.total[at]:
            return least
        while at > 1:
            if not at & 1 and self.total[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at + (not self.total[2 * at])
                return at - self.leaves
            at >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over ``{length: pieces}``.

    Runs ``(length, first rank, pieces, first sequence, offset)``: the pieces of a length with ranks
    from the first on go to the sequences from the first on, one each, at the offset.
    """
    tree = Capacities(capacity)
    open_at: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            each = (capacity if room is None else room) // length
            # best fit stays with a sequence while it fits: fill some, or begin a last one
            wanted, each = (left // each, each) if left >= each else (1, left)
            if room is None:
                room, taken = capacity, [(sequences, wanted)]
                sequences += wanted
            else:
                taken, stack, count = [], open_at[room], 0
                while stack and count < wanted:
                    first, n = stack.pop()
                    use = min(n, wanted - count)
                    taken.append((first, use))
                    if use < n:
                        stack.append((first + use, n - use))
                    count += use
                tree.add(room, -count)
                wanted = count
            for k in range(each):
                for first, n in taken:
                    runs.append((length, rank, n, first, capacity - room + k * length))
                    rank += n
            open_at.setdefault(room - each * length, []).extend(taken)
            tree.add(room - each * length, wanted)
            left -= wanted * each
    return runs


def ranks(lengths: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The number of rows of the same length before a row in its task."""
    seen: dict[int, int] = {}
    for batch in lengths:
        values = batch.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, group, n = np.unique(values, return_inverse=True, return_counts=True)
        order = np.argsort(group, kind="stable")
        rank = np.empty(len(values), np.int64)
        rank[order] = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
        yield pa.array(rank + np.array([seen.get(k, 0) for k in kinds.tolist()], np.int64)[group])
        for k, more in zip(kinds.tolist(), n.tolist()):
            seen[k] = seen.get(k, 0) + more


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every other column is passed on.

    Writes the pieces to the shared folder, with the task that wrote them and their rank among its
    pieces of the same length, and plans on their histogram when called. Ids are never shuffled or
    sorted: the first rank of each length and task is broadcast within a bound, and joined beyond it.
    """
    spark = pieces.sparkSession
    rank = F.arrow_udf(ranks, "bigint").asNondeterministic()
    numbered = pieces.select(F.struct("*").alias("row"), "length", rank("length").alias("rank"))
    table = written(numbered.withColumn("task", F.spark_partition_id()), "pieces")
    counts = written(table.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    runs = sorted(plan(histogram, capacity))
    shared = spark.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "piece-starts")
    few = broadcast_within(starts, BROADCAST_STARTS, 24 * BROADCAST_STARTS, F.lit(" " * 24))
    ranked = table.join(starts if few is None else few, ["length", "task"])

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        rows = shared.value
        length, rank = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (length, rank))
        # runs are sorted by length, then rank: the last one that begins at or before the piece
        shift = np.int64(1) << 48
        at = np.searchsorted(rows[:, 0] * shift + rows[:, 1], length * shift + rank, "right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(rows[at, 3] + rank - rows[at, 1]), pa.array(rows[at, 4])], ["sequence_id", "offset"])

    return ranked.select("row", place("length", F.col("first") + F.col("rank")).alias("at")).select("row.*", "at.*")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` with their ids, sequence and offset."""
    return assign(tokenize(docs, path, capacity), capacity)
