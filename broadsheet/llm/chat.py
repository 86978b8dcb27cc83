"""Chat formatting: conversations rendered by a compiled template, with marks of what is generated.

Turns are sorted by conversation and turn inside partitions, and the template reads them as they
come, so a conversation of any length is rendered in bounded memory. The result has one row per
piece: ``conv_id, part, text, loss``; the pieces of a conversation in order are its formatted text.

Control strings inside roles and texts are escaped: ``<|`` gets a backslash between, and one more
backslash where there are some, which is undone exactly.

Edge cases: null roles and texts are empty; rows with a null id are one conversation; turns with the
same number are ordered by role, then text; repeated rows are rendered each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from .templates import Template

CHAT = (
    "{% for turn in messages %}"
    "<|im_start|>{{ turn.role | escaped_line }}\n"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escaped }}{% endgeneration %}"
    "{% else %}{{ turn.text | escaped }}{% endif %}"
    "<|im_end|>\n"
    "{% endfor %}"
)

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_LINE = re.compile(r"\\(.)")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """The text without ``<|``."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_line(text: str) -> str:
    """The text without ``<|`` and line breaks."""
    return escape(text).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_line(text: str) -> str:
    return unescape(_LINE.sub(lambda m: "\n" if m[1] == "n" else m[1], text))


FILTERS = {"escaped": escape, "escaped_line": escape_line}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)


_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss", pa.bool_())])


def format_conversations(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """The pieces of all conversations; those of one are together and in order in a partition."""
    Template(template, FILTERS)  # a wrong template fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, FILTERS)

        def pieces() -> Iterator[tuple]:
            for conv_id, own in groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": role or "", "text": text or ""} for _, _, role, text in own)
                for part, (text, loss) in enumerate(compiled.pieces(messages=messages)):
                    yield conv_id, part, text, loss

        yield from _batches(pieces(), _PIECES)

    rows = turns.selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text")
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, "conv_id long, part long, text string, loss boolean")
    )


_DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests() -> Iterator[tuple]:
        for conv_id, own in groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            count = loss_chars = chars = 0
            waiting, masked = "", ""
            for _, _, text, in_loss in own:
                chars += len(text)
                waiting += text
                masked += text if in_loss else ""
                while m := _TURN.match(waiting):
                    role, said = unescape_line(m[1]), unescape(m[2])
                    turns.update(f"{role}\n{said}\n".encode())
                    count += 1
                    waiting = waiting[m.end():]
                    plain = unescape(masked)
                    loss.update(plain.encode())
                    loss_chars += len(plain)
                    masked = ""
            if waiting:
                raise ValueError(f"conversation {conv_id} doesn't end with a turn")
            yield conv_id, count, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    yield from _batches(digests(), _DIGESTS)


def read_back(pieces: DataFrame) -> DataFrame:
    """For each conversation what its formatted text in ``CHAT`` and its mask say, as digests.

    ``pieces`` is the result of ``format_conversations``, in its order.
    """
    return pieces.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
