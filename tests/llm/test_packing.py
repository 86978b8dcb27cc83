import json
import random
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from broadsheet.llm import packing
from broadsheet.llm.queries import QUERIES, tokenizer_path

PATH = tokenizer_path()


WHOLE = Tokenizer.from_file(PATH)


def slow_ids(text):
    found = WHOLE.encode(text or "", add_special_tokens=False).ids
    return [*found, 0]


def test_ids_equal_the_tokenizer():
    chance, encoder = random.Random(3), packing.Encoder(PATH, remembered=50)
    alphabet = "abzAZ019 \n\t.,'!#$%_-ÉßÿªºµÅ²¼ſʼıŸ‘’—×÷sStTdDmMrvl" + "ΣσЖ漢́İ\xa0\x0b\x85​💥<|>"
    texts = ["", None, "it's WE'LL i'd", "a<|endoftext|>b", "ΟΔΟΣ ΣΑΣ", "İstanbul", "é é", "don’t"]
    texts += ["".join(chance.choices(alphabet[:50] if n % 2 else alphabet, k=chance.randrange(60))) for n in range(3000)]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == slow_ids(t), t


def test_another_tokenizer_gets_whole_texts(tmp_path):
    """A file that splits otherwise must not be used form by form."""
    described = json.loads(open(PATH, encoding="utf-8").read())
    assert packing.splits_as_here(described)
    described["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
        {"type": "Digits", "individual_digits": False}, described["pre_tokenizer"]["pretokenizers"][1]]}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(described), encoding="utf-8")
    encoder, tokenizer = packing.Encoder(str(other)), Tokenizer.from_file(str(other))
    assert not encoder.quick
    for text in ("It's 12 o'clock", "été 2024", ""):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    for change in ({"normalizer": None}, {"post_processor": {"type": "ByteLevel"}}):
        assert not packing.splits_as_here(json.loads(open(PATH, encoding="utf-8").read()) | change)


def test_forms_are_bounded():
    encoder = packing.Encoder(PATH, remembered=10)
    for k in range(100):
        encoder.encode(f"word{k} and ‘é{k}’")
        assert len(encoder.forms) <= 10


def slow_packing(lengths, capacity):
    """Best fit decreasing piece by piece: how full the sequences are.

    Among sequences with the same room it doesn't say which one to take, so contents may differ.
    """
    room, held = [], []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if fits:
            _, k = min(fits)
        else:
            k = len(room)
            room.append(capacity)
            held.append([])
        room[k] -= n
        held[k].append(n)
    return sorted(map(sum, held))


def test_plan_is_best_fit_decreasing():
    chance = random.Random(4)
    for case in range(200):
        capacity = chance.choice([1, 7, 20, 64])
        lengths = [chance.randint(1, capacity) for _ in range(chance.randrange(0, 120))]
        held = {}
        for length, rank, n, first, offset in packing.plan(Counter(lengths), capacity):
            for k in range(n):
                held.setdefault(first + k, []).append((offset, length, rank + k))
        assert len({(length, r) for own in held.values() for _, length, r in own}) == len(lengths)
        for own in held.values():
            own.sort()
            assert all(a + n == b for (a, n, _), (b, *_) in zip(own, own[1:])) and own[0][0] == 0
        assert sorted(sum(n for _, n, _ in own) for own in held.values()) == slow_packing(lengths, capacity)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op8_packing"](spark, folder).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(slow_ids(text), "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [
            (k, a, min(2048, len(ids) - a)) for k, a in enumerate(range(0, len(ids), 2048))]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[r.start: r.start + r.length].tobytes()) for r in own]
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    assert sorted(sum(n for _, n in own) for own in held.values()) == slow_packing([r.length for r in rows], 2048)


def test_edge_cases(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (None, "hello"), (3, "word " * 5000), (3, "word " * 5000))
    rows = packing.pack(docs, PATH).collect()
    assert Counter(r.doc_id for r in rows) == {1: 1, 2: 1, None: 1, 3: 6}
    assert sum(r.length for r in rows) == 1 + 1 + 2 + 2 * 5001
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_first_ranks_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_STARTS", 0)
    pieces = spark.range(0, 30_000, 1, 7).selectExpr(
        "id as doc_id", "0 as piece", "cast(case when id % 3 = 0 then 2048 else 1 + id % 900 end as bigint) as length")
    rows = packing.assign(pieces).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 30_000
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
