import hashlib
import zlib

import pytest

from broadsheet.llm import merkle


def sha(*nodes):
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def slow_tree(nodes):
    """The root, and the siblings of each leaf, left to right, level by level."""
    proofs, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + 8, len(nodes))) for k in range(0, len(nodes), 8)]
        for run in runs:
            for k in run:
                for leaf in owners[k]:
                    proofs[leaf].append((k - run[0], [nodes[j] for j in run if j != k]))
        owners = [[leaf for k in run for leaf in owners[k]] for run in runs]
        nodes = [sha(*(nodes[k] for k in run)) for run in runs]
    return nodes[0], proofs


def slow_leaf(doc_id, source, lang, n_chars, text):
    parts = (None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text))
    return sha(*("-" if v is None else f"{len(v.encode())}:{v}" for v in parts))


def slow_manifest(rows):
    """Sorted result tuples of ``(doc_id, source, lang, n_chars, text)`` rows."""
    groups = {}
    for row in rows:
        groups.setdefault("" if row[2] is None else "=" + row[2], []).append(row)
    trees = {}
    for name, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, slow_leaf(*r)))
        trees[name] = (members, *slow_tree([slow_leaf(*r) for r in members]))
    names = sorted(trees, key=str.encode)
    root, tops = slow_tree([trees[n][1] for n in names])
    found = []
    for name, top in zip(names, tops):
        members, subroot, proofs = trees[name]
        for row, proof in zip(members, proofs):
            steps, (doc_id, source, lang, n_chars, text) = proof + top, row
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = slow_leaf(doc_id, source, lang, n_chars, text)
            for place, siblings in steps:
                node = sha(*siblings[:place], node, *siblings[place:])
            found.append((doc_id, slow_leaf(*row), subroot, root, sha(*(x for _, s in steps for x in s)), node, node == root))
    return sorted(found, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, at string, node string, size string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "a", "n", "s") for r in rows], SCHEMA)


def run(spark, rows):
    return sorted(map(tuple, merkle.document_manifest(frame(spark, rows)).collect()), key=str)


def test_edge_cases(spark):
    rows = [
        (5, "s", "en", 3, "Abc"), (None, None, None, None, None), (7, "s", None, 0, ""), (7, "s", None, 0, ""),
        (7, "s", None, None, "X"), (None, "s", "en", 1, "É-Z"), (2, "", "", 1, "Q"), (3, "s", "é", 1, "Long Text " * 50_000),
        (8, "s", "z", 1, "B"), *((k, "s", "de", k, f"Text {k}") for k in range(9)),
    ]
    assert run(spark, rows) == slow_manifest(rows)
    assert merkle.document_manifest(frame(spark, rows).limit(0)).count() == 0
    assert run(spark, rows[:1]) == slow_manifest(rows[:1])


def test_query_equals_slow_tree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = merkle.document_manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == slow_manifest(rows)


@pytest.mark.parametrize("sizes", [
    # full and ragged subtrees of several rounds: 80 blocks, 9 blocks, a block and a leaf, full ones, many groups
    {"a": 40_500, "b": 512 * 8 + 1, "c": 513, "d": 4096, "e": 512, "f": 1, "g": 64},
    {f"g{k:04}": 1 + k % 3 for k in range(1100)},
])
def test_exchange_over_many_blocks(spark, sizes):
    rows = [(i, "s", lang, 1, f"T{i}") for lang, n in sizes.items() for i in range(n)]
    assert run(spark, rows) == slow_manifest(rows)


def test_no_partition_holds_a_group(spark):
    """Places come from ranges: all rows of one group, and all of one id, are spread."""
    for ids in (range(20_000), [1] * 20_000):
        leaves = spark.createDataFrame([("x", i, f"{k:064}") for k, i in enumerate(ids)], "tree string, id long, leaf string")
        placed = merkle.places(leaves, "tree", "id", "leaf")
        found = placed.orderBy("at").collect()
        assert [r.at for r in found] == list(range(20_000)) and {r.size for r in found} == {20_000}
        assert [r.leaf for r in found] == sorted(r.leaf for r in found)
        assert len(placed.inputFiles()) > 2
