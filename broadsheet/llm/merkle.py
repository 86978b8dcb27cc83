"""Merkle manifest of a dataset by butterfly exchange.

A leaf is the digest of a row. The leaves of a group, in order, are one tree: every ``FANOUT``
consecutive nodes (the last run may be shorter, even one) become their digest, until one is left, the
group's root; the group roots in order are one more tree. Every row gets its proof, the siblings level
by level up to the root.

Leaves are dealt out to *blocks* of ``FANOUT ** BLOCK_LEVELS`` consecutive leaves, the partitions of the
exchange. A block hashes its own subtree. Then, round by round, aligned groups of up to ``FANOUT``
blocks swap the roots of the subtrees they have reached: block b meets the blocks that differ from it
in one digit only, the round's. Each hashes the parent itself, so after the last round every block holds
all siblings above it, and nothing is sent down. The last subtree of a level may have fewer blocks than
its full neighbours; its blocks then also speak for the places that are missing, so that all blocks of
the neighbours hear of it. A round is one shuffle of at most twice as many rows as there are blocks.

No group is sorted in one task: ranges of (group, order) are sorted in parallel and their counts give
the places. The group roots go through the same functions as one tree, so any number of groups will do.

Edge cases: null groups are one group and come first, null ids come first in it; rows with one id are
ordered by their leaf, repeated rows in any order, as their leaves are equal. A null value is ``-`` in
a leaf, an empty text isn't. A group of one row has its leaf as root, and a tree of one leaf an empty
proof. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_within, written

FANOUT, BLOCK_LEVELS = 8, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a row's number inside its partition.
ROW_BITS = 33


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def leaf_of(*values: Column) -> Column:
    """Digest of the values, each with its length, so that different rows can't look alike."""
    written_out = [
        F.coalesce(F.concat(F.octet_length(v.cast("string")), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*written_out), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text after the tampering that the manifest has to notice: A-Z become lower-case."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(text, UPPER, LOWER)).otherwise(text)


def places(leaves: DataFrame, tree: str, *order: str) -> DataFrame:
    """Written ``leaves`` with ``at``, the place of each in its ``tree``, and ``size``, that of the tree.

    Rows are sorted in ranges; the counts of a tree's earlier ranges shift its places in a range.
    """
    spark = leaves.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id()
    keys = [F.col(c) for c in (tree, *order)]
    ranged = written(
        leaves.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *keys, "_tie").sortWithinPartitions(*keys, "_tie")
        .withColumn("_row", row).drop("_tie"), "ranged")
    part = F.shiftright("_row", ROW_BITS)
    counts = ranged.groupBy(tree, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    counts = written(counts, "range-counts")
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col(tree).alias("_tree"), "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(tree)).alias("size"))
    # as many rows as ranges and trees together
    bounded = broadcast_within(shifts, 500_000, 16 << 20, "_tree")
    same = (F.col(tree) == F.col("_tree")) & (part == F.col("_part"))
    return ranged.join(shifts if bounded is None else bounded, same).withColumn(
        "at", F.col("_row") + F.col("_shift")).drop("_row", "_tree", "_part", "_shift")


def levels_of(size: int) -> int:
    """How often the nodes of a tree are folded."""
    found = 0
    while size > 1:
        size, found = -(-size // FANOUT), found + 1
    return found


def fold(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a block, level by level up from its leaves."""
    found = [nodes]
    for _ in range(levels):
        nodes = [digest(nodes[k: k + FANOUT]) for k in range(0, len(nodes), FANOUT)]
        found.append(nodes)
    return found


def block_roots(leaves: DataFrame, tree: str, node: str) -> DataFrame:
    """``tree, block, size, node``: every block hashes its subtree."""
    width = FANOUT ** BLOCK_LEVELS

    def hash_block(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        size = table.column("size")[0].as_py()
        top = fold(table.column(node).to_pylist(), min(levels_of(size), BLOCK_LEVELS))[-1]
        return pa.table({tree: table.column(tree)[:1], "block": table.column("block")[:1],
                         "size": table.column("size")[:1], "node": top})

    rows = leaves.select(tree, F.floor(F.col("at") / width).alias("block"), "size", "at", node)
    return rows.groupBy(tree, "block").applyInArrow(hash_block, f"{tree} string, block long, size long, node string")


def exchange(blocks: DataFrame, tree: str) -> DataFrame:
    """``tree, block, size, node, above``: the tree's root and, level by level, the siblings above a block."""
    width = FANOUT ** BLOCK_LEVELS
    state = blocks.withColumns({
        "blocks": F.ceil(F.col("size") / width),
        "above": F.array().cast("array<array<string>>")})
    most = state.agg(F.max("blocks")).first()[0] or 0
    step = 1
    for _ in range(levels_of(most)):
        span = F.lit(step).cast("long")
        place = F.col("block") % span
        held = F.least(span, F.col("blocks") - (F.col("block") - place))
        digit = F.floor(F.col("block") / step) % FANOUT
        # a subtree with fewer blocks than its neighbours speaks for the missing places too
        spoken = F.when((held < step) & (digit > 0), F.sequence(place, span - 1, held)).otherwise(F.array(place))
        told = state.select(
            tree, F.floor(F.col("block") / (step * FANOUT)).alias("_group"), F.explode(spoken).alias("_place"),
            F.struct(digit.alias("digit"), "node", "block", "size", "blocks", "above").alias("member"))
        met = told.groupBy(tree, "_group", "_place").agg(F.sort_array(F.collect_list("member")).alias("met"))
        parent = F.sha2(F.array_join(F.col("met.node"), ""), 256)
        real = F.filter("met", lambda m: m["block"] % step == F.col("_place"))
        met = met.select(tree, "met", parent.alias("parent"), F.explode(real).alias("m"))
        siblings = F.transform(F.filter("met", lambda o: o["digit"] != F.col("m.digit")), lambda o: o["node"])
        rises = F.col("m.blocks") > step
        state = met.select(
            tree, "m.block", "m.size", "m.blocks",
            F.when(rises, F.col("parent")).otherwise(F.col("m.node")).alias("node"),
            F.when(rises, F.concat("m.above", F.array(siblings))).otherwise(F.col("m.above")).alias("above"))
        step *= FANOUT
    return state.drop("blocks")


def upper_proofs(placed: DataFrame, tree: str, node: str) -> DataFrame:
    """Per block of every tree ``tree, block, size, node, above``, written."""
    return written(exchange(block_roots(placed, tree, node), tree), "exchanged")


def steps_up(inside: list[list[str]], k: int, first: int, above: list[list[str]]) -> list[tuple[int, list[str]]]:
    """The (own place, siblings) of every level over leaf ``k`` of a block, whose levels are ``inside``."""
    steps, at = [], k
    for level in inside[:-1]:
        run = at - at % FANOUT
        steps.append((at - run, level[run:at] + level[at + 1: run + FANOUT]))
        at //= FANOUT
    at = (first + k) // FANOUT ** (len(inside) - 1)
    for siblings in above:
        steps.append((at % FANOUT, siblings))
        at //= FANOUT
    return steps


def climb(node: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, siblings in steps:
        node = digest([*siblings[:place], node, *siblings[place:]])
    return node


def manifest(leaves: DataFrame, group: str, order: str, leaf: str = "leaf", shown: str = "shown") -> DataFrame:
    """``order, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``leaves``.

    ``leaf`` is the recorded digest of a row, ``shown`` that of the row as it is now; ``folded_root`` is
    what the latter gives with the recorded siblings. Groups ascend as strings, nulls first.
    """
    width = FANOUT ** BLOCK_LEVELS
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    base = written(leaves.select(
        key.alias("tree"), F.col(order).alias("id"), F.col(leaf).alias("leaf"), F.col(shown).alias("shown")), "leaves")
    placed = written(places(base, "tree", "id", "leaf"), "placed")
    lower = upper_proofs(placed, "tree", "leaf")
    roots = lower.where("block = 0").select(F.lit("").alias("forest"), F.col("tree").alias("name"), "node")
    tops = written(places(roots, "forest", "name"), "subroots")
    upper = upper_proofs(tops, "forest", "node").select(
        F.col("forest"), F.col("block"), F.col("node").alias("root"), F.col("above").alias("top_above"))
    tops = tops.withColumn("block", F.floor(F.col("at") / width))
    inside = tops.groupBy("forest", "block").agg(F.sort_array(F.collect_list(F.struct("at", "node"))).alias("nodes"))
    tops = tops.join(inside, ["forest", "block"]).join(upper, ["forest", "block"]).select(
        F.col("name").alias("tree"), F.col("at").alias("top_at"), F.col("size").alias("top_size"),
        F.col("nodes.node").alias("top_nodes"), "top_above", "root")
    carried = lower.select("tree", "block", "above", F.col("node").alias("subroot")).join(tops, "tree")

    def prove(table: pa.Table, proof: pa.Table) -> pa.Table:
        table, known = table.sort_by("at"), proof.to_pylist()[0]
        nodes, shown_now = table.column("leaf").to_pylist(), table.column("shown").to_pylist()
        first, size = table.column("at")[0].as_py(), table.column("size")[0].as_py()
        top = known["top_at"] % width
        top = steps_up(fold(known["top_nodes"], min(levels_of(known["top_size"]), BLOCK_LEVELS)),
                       top, known["top_at"] - top, known["top_above"])
        inside, found = fold(nodes, min(levels_of(size), BLOCK_LEVELS)), []
        for k, leaf_now in enumerate(shown_now):
            steps = steps_up(inside, k, first, known["above"]) + top
            folded = climb(leaf_now, steps)
            found.append((nodes[k], known["subroot"], known["root"], digest([x for _, s in steps for x in s]),
                          folded, folded == known["root"]))
        return pa.table([table.column("id"), *map(pa.array, zip(*found))],
                        [order, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    rows = placed.withColumn("block", F.floor(F.col("at") / width)).groupBy("tree", "block")
    kind = base.schema["id"].dataType.simpleString()
    return rows.cogroup(carried.groupBy("tree", "block")).applyInArrow(
        prove, f"{order} {kind}, leaf string, subroot string, root string, proof_sha256 string, "
               "folded_root string, verified boolean")


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs(doc_id, source, lang, n_chars, text)`` by ``lang``, with tampered texts shown."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        "doc_id", "lang", leaf_of(*fields, F.col("text")).alias("leaf"),
        leaf_of(*fields, tampered_text(F.col("doc_id"), F.col("text"))).alias("shown"))
    return manifest(leaves, "lang", "doc_id")
