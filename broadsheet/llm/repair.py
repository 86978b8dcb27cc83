"""Repair of conversations by the cheapest edits, found as a least integer.

An edit script is one integer: its high digits are the cost, its low digits, ``width`` of them, are the
letters of its audit by place, the first letter highest, with zeros behind the last one. Costs thus
decide first and the ASCII order of audits decides ties (a shorter audit that begins a longer one has
the zero), so the best script is the least integer of an ordinary shortest-path recursion over the
graph (rows left, state of the grammar). Putting a letter in front moves the others one digit down.

The audit is no longer than ``width``: deleting all rows costs ``DELETE`` a row, so no cheapest script
has more than that divided by ``INSERT`` inserts, and a few to end from any state.

Every conversation is one sorted run of rows of one task, which streams through twice: first the small
features of the rows (role, kind of fault, digest), on which the edits are decided, then the texts, which
are hashed as they come and never held. Memory grows with the features of a conversation only.

Edge cases: nulls in any column are one space, where they are text; null ids are one conversation. Rows
of one turn are ordered by role and digest, a repeated row follows its original. A role without
characters has no initial: keeping it leaves the grammar where it is. A conversation without rows after
the damage, or with none worth keeping, has the digest of the empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Digits of the letters, in ASCII order; zero is padding.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {v: k for k, v in DIGITS.items()}
BITS = 3
#: States of the role grammar (s?(ua)+)? and where an initial leads.
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ENDS = ("", "a")
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
WHITE = " \t\n\x0b\x0c\r"
#: Conversations that look alike are decided once; longer ones aren't remembered.
REMEMBERED, SHORT = 65_536, 64


def decide(rows: tuple[tuple[str, str], ...]) -> tuple[int, str]:
    """``(cost, audit)`` of the cheapest edits of ``(initial, fault)`` rows."""
    width = len(rows) + (DELETE * len(rows)) // INSERT + 4
    low = BITS * width
    mask, top = (1 << low) - 1, BITS * (width - 1)

    def ahead(letter: str, cost: int, rest: int) -> int:
        return ((rest >> low) + cost) << low | DIGITS[letter] << top | (rest & mask) >> BITS

    def with_inserts(best: dict[str, int]) -> dict[str, int]:
        # a run of more inserts returns to a state it has been in
        for _ in range(len(STEPS) - 1):
            best = {
                state: min([*([best[state]] if state in best else []),
                            *(ahead("I", INSERT, best[to]) for initial, to in STEPS[state].items()
                              if initial in ROLES and to in best)], default=None)
                for state in STEPS}
            best = {state: value for state, value in best.items() if value is not None}
        return best

    best = with_inserts({state: 0 for state in ENDS})
    for initial, fault in reversed(rows):
        extra, before = TRUNCATED if fault == "truncated" else 0, {}
        for state, steps in STEPS.items():
            found = [ahead("D", DELETE, best[state])] if state in best else []
            if fault not in ("blank", "duplicate"):
                kept = state if initial == "" else steps.get(initial)
                if kept in best:
                    found.append(ahead("K", KEEP + extra, best[kept]))
                found += [ahead("R", REROLE + extra, best[to]) for role, to in steps.items() if role in ROLES and to in best]
            if found:
                before[state] = min(found)
        best = with_inserts(before)
    least = best[""]
    code = least & mask
    digits = (code >> BITS * (width - 1 - k) & 7 for k in range(width))
    return least >> low, "".join(LETTERS[d] for d in digits if d)


_remembered = lru_cache(REMEMBERED)(decide)


def plan(rows: tuple[tuple[str, str], ...]) -> tuple[int, str]:
    return _remembered(rows) if len(rows) <= SHORT else decide(rows)


class Repairing:
    """The repaired lines of a conversation, from its audit and its rows as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.lines = audit, 0, "", 0
        self.hash = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "replace"))
        self.lines += 1

    def _next_role(self) -> str:
        """The one initial out of user and assistant that the grammar allows here."""
        initial = next(x for x in STEPS[self.state] if x in ROLES)
        self.state = STEPS[self.state][initial]
        return ROLES[initial]

    def inserts(self) -> None:
        while self.audit[self.at: self.at + 1] == "I":
            self._line(self._next_role(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEPS[self.state][role[0]] if role else self.state
            self._line(role, text)
        elif edit == "R":
            self._line(self._next_role(), text)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy`` after the damage; a dropped row stays with a null ``copy``.

    Which damage a row takes follows from the CRC of its conversation and turn.
    """
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, F.array(F.lit(None).cast("int"))).when(
        F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy"))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``conv_id, phase, turn, role, fault, digest, text`` to one row a conversation."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    conv, begun, found = None, False, []
    features, seen, turns, repairing, cost = [], set(), [], None, 0

    def settle() -> None:
        nonlocal repairing, cost
        cost, audit = plan(tuple((role[:1], fault) for role, fault in features))
        repairing = Repairing(audit)

    def close() -> tuple:
        if repairing is None:
            settle()
        repairing.inserts()
        known = {t for t in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        faults = [fault for _, fault in features]
        initials = [role[:1] for role, _ in features]
        illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
        return (conv, gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost,
                repairing.audit, repairing.hash.hexdigest())

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            new_conv, phase, turn, role, fault, digest, text = row
            if not begun or new_conv != conv:
                if begun:
                    found.append(close())
                conv, begun = new_conv, True
                features, seen, turns, repairing, cost = [], set(), [], None, 0
            if phase == 0:
                if digest in seen and fault != "blank":
                    fault = "duplicate"
                seen.add(digest)
                if not turns or turns[-1] != turn:
                    turns.append(turn)
                features.append((role, fault))
            elif phase == 1:
                if repairing is None:
                    settle()
                repairing.row(role, text)
        if found:
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found), kinds)], names)
            found = []
    if begun:
        yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*[close()]), kinds)], names)


def repair(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``rows(conv_id, turn, role, text, copy)``.

    A row with a null ``copy`` only says that the conversation is there.
    """
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    ends = F.substring(shown, -1, 1).isin(".", "!", "?")
    fault = F.when(shown == "", "blank").when(~ends, "truncated").otherwise("")
    known = rows.withColumns({"fault": fault, "digest": F.unhex(F.sha2(F.concat(
        F.octet_length("role"), F.lit(":"), "role", "text"), 256))})
    nothing = F.lit(None).cast("string")

    def part(phase: int, fault: Column, said: Column) -> Column:
        return F.struct(F.lit(phase).alias("phase"), fault.alias("fault"), said.alias("said"))

    parts = F.when(F.col("copy").isNotNull(), F.array(
        part(0, F.col("fault"), nothing), part(1, nothing, F.col("text")))).otherwise(F.array(part(-1, nothing, nothing)))
    twice = known.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "copy", "digest",
        F.explode(parts).alias("part"))
    ordered = twice.select("conv_id", "turn", "role", "copy", "digest", "part.phase", "part.fault", "part.said")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "phase", "turn", "role", "digest", "copy")
    return ordered.select("conv_id", "phase", "turn", "role", "fault", "digest", "said").mapInArrow(
        _stream, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                 "audit string, repaired_sha256 string")
