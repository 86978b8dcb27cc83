import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from broadsheet.llm import repair

STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def slow_decide(rows):
    """(cost, audit) by going through edit scripts, compared as pairs."""
    @functools.lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserts:
            for to in STEPS[state]:
                if to in "ua":
                    options.append(add(5, "I", best(i, STEPS[state][to], inserts - 1)))
        if i < len(rows):
            initial, fault = rows[i]
            options.append(add(2, "D", best(i + 1, state, inserts)))
            extra = 5 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                if initial == "" or initial in STEPS[state]:
                    options.append(add(extra, "K", best(i + 1, STEPS[state][initial] if initial else state, inserts)))
                for to in STEPS[state]:
                    if to in "ua":
                        options.append(add(1 + extra, "R", best(i + 1, STEPS[state][to], inserts)))
        return min(filter(None, options), default=None)

    def add(cost, letter, rest):
        return rest and (rest[0] + cost, letter + rest[1])

    return best(0, "", 4)


def slow_query(rows):
    """Result tuples of (conv_id, turn, role, text) rows."""
    found = []
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0)):
            conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            after += [(turn, role, text)] * (2 if kind == 3 else 1)
        faults, seen = [], set()
        for _, role, text in after:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                          else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in after if t is not None}
        initials = [role[:1] for _, role, _ in after]
        cost, audit = slow_decide(tuple(zip(initials, faults)))
        lines, state, at = [], "", 0
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            _, role, text = (None, None, "") if letter == "I" else after[at]
            at += letter != "I"
            if letter != "K":
                role = {"u": "user", "a": "assistant"}[next(x for x in STEPS[state] if x in "ua")]
            state = STEPS[state][role[0]] if role else state
            lines.append(f"{role}:{text}")
        found.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(found, key=str)


def test_least_integer_is_the_cheapest_script():
    chance = random.Random(1)
    kinds = list(itertools.product(("s", "u", "a", "t", ""), ("", "blank", "duplicate", "truncated")))
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n) if n < 3 else [[chance.choice(kinds) for _ in range(n)] for _ in range(2000)]:
            assert repair.decide(tuple(rows)) == slow_decide(tuple(rows))
    for _ in range(400):
        rows = tuple((chance.choice("suuaaaat"), chance.choice(("", "", "", "truncated", "blank"))) for _ in range(chance.randrange(4, 40)))
        assert repair.decide(rows) == slow_decide(rows)


def test_inserts_are_priced(monkeypatch):
    """Inserts never pay at the given prices; where they do, they are found."""
    monkeypatch.setattr(repair, "DELETE", 9)
    assert repair.decide((("u", ""), ("u", ""), ("a", ""))) == (5, "KIKK")
    assert repair.decide((("s", ""),)) == (6, "IR")
    assert repair.decide((("a", ""),)) == (5, "IK")


def test_long_conversation():
    rows = tuple(("ua"[k % 2], "truncated" if k % 1000 == 7 else "") for k in range(20_001))
    cost, audit = repair.decide(rows)
    # each of the 20 truncated rows goes with a neighbour, and the odd last row goes
    assert cost == 20 * 4 + 2 and len(audit) == 20_001 and audit.count("D") == 41


SCHEMA = "conv_id long, turn long, role string, text string, copy string, digest string, phase string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "d", "p") for r in rows], SCHEMA)


def run(spark, rows):
    return sorted(map(tuple, repair.repair(repair.damaged(frame(spark, rows))).collect()), key=str)


def test_edge_cases(spark):
    chance, rows = random.Random(2), []
    texts = ["Yes.", "no", "", " \n", None, "What? ", "a.b", "Ende!\t\n", "é…", "x " * 50_000 + ".", "."]
    for conv in [*range(300), None]:
        for turn in chance.sample([None, *range(12)], chance.randrange(1, 9)):
            rows.append((conv, turn, chance.choice(["user", "assistant", "system", "tool", "", None]), chance.choice(texts)))
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "All of this conversation is dropped."))
    found = run(spark, rows)
    assert found == slow_query(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found
    assert repair.repair(repair.damaged(frame(spark, rows).limit(0))).count() == 0


def test_repeated_rows_and_equal_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yo."), (2, 0, "user", "A."), (2, 0, "user", "A.")]
    found = {r[0]: r for r in run(spark, rows)}
    assert found == {r[0]: r for r in slow_query(rows)}


def test_one_large_conversation(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"Turn {k}.") for k in range(5000)] + [(2, 0, "user", "Hi.")]
    found = {r[0]: r for r in run(spark, rows)}
    assert found[1][5] > 0 and len(found[1][7]) >= 4700


def test_query_equals_slow_query(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, repair.repair(repair.damaged(turns)).collect()), key=str) == slow_query(rows)


@pytest.mark.parametrize("text, fault", [("a.", ""), ("a. \n", ""), ("a", "truncated"), ("\x0b", "blank"), ("\xa0", "truncated")])
def test_faults(spark, text, fault):
    row = spark.createDataFrame([(1, 0, "user", text, 0)], "conv_id long, turn long, role string, text string, copy int")
    got = repair.repair(row).first()
    assert [got.blank, got.duplicate, got.truncated] == [int(fault == x) for x in ("blank", "duplicate", "truncated")]
