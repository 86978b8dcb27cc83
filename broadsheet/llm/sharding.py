"""Sharding of indivisible groups by best fit decreasing.

Rows with equal keys are a group and stay together. Group sizes are summed with partial sums per
task. Groups of at least one ``FINE``-th of a shard are items of their own; smaller ones are glued
into cells by a hash, ``FINE`` cells for each shard, which are items too. There are at most a few
``FINE`` items for each shard, however many rows there are, so they are sorted by size and packed on
the driver: each goes into the open shard with the tightest sufficient remaining capacity, which a
balanced tree finds, or opens a new one. For a fixed number of shards the capacity is the smallest
at which they suffice, found by bisection. Groups larger than an equal share have a shard each.

Rows are dealt by broadcasting the items' shards, bounded as said. Places within shards come from
counts of salted parts, so no shard is gathered in one task.

Edge cases: null keys are one group; there are as many shards as asked for, some empty if there are
fewer items; an empty table gives no rows; repeated rows have a slot each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written

#: Items of a shard are no larger than its part of so many, unless they are one group.
FINE = 256


class _Node:
    __slots__ = ("key", "height", "left", "right")

    def __init__(self, key: tuple[int, int]) -> None:
        self.key, self.height, self.left, self.right = key, 1, None, None


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _lift(node: _Node, side: str, other: str) -> _Node:
    top = getattr(node, side)
    setattr(node, side, getattr(top, other))
    setattr(top, other, node)
    for n in (node, top):
        n.height = 1 + max(_height(n.left), _height(n.right))
    return top


def _balanced(node: _Node) -> _Node:
    node.height = 1 + max(_height(node.left), _height(node.right))
    lean = _height(node.left) - _height(node.right)
    if abs(lean) < 2:
        return node
    side, other = ("left", "right") if lean > 0 else ("right", "left")
    child = getattr(node, side)
    if _height(getattr(child, other)) > _height(getattr(child, side)):
        setattr(node, side, _lift(child, other, side))
    return _lift(node, side, other)


class Room:
    """The open shards in a height-balanced tree by ``(remaining capacity, shard)``."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def add(self, key: tuple[int, int]) -> None:
        def into(node: _Node | None) -> _Node:
            if node is None:
                return _Node(key)
            if key < node.key:
                node.left = into(node.left)
            else:
                node.right = into(node.right)
            return _balanced(node)

        self.root = into(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def without(node: _Node, key: tuple[int, int]) -> _Node | None:
            if key < node.key:
                node.left = without(node.left, key)
            elif key > node.key:
                node.right = without(node.right, key)
            elif node.left is None or node.right is None:
                return node.left or node.right
            else:
                least = node.right
                while least.left:
                    least = least.left
                node.key = least.key
                node.right = without(node.right, least.key)
            return _balanced(node)

        self.root = without(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The shard with the least remaining capacity of at least ``size``."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                best, node = node.key, node.left
            else:
                node = node.right
        return best


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The shard of each of ``sizes``, which decrease; ``None`` if more than ``most`` are needed."""
    room, shards, used = Room(), [], 0
    for size in sizes:
        key = room.tightest(size)
        if key is None:
            if used == most:
                return None
            key, used = (capacity, used), used + 1
        else:
            room.remove(key)
        room.add((key[0] - size, key[1]))
        shards.append(key[1])
    return shards


def even(sizes: list[int], count: int) -> list[int]:
    """The shard of each of ``sizes``, which decrease, in ``count`` shards of near equal size."""
    total, alone = sum(sizes), 0
    while alone < min(count - 1, len(sizes)) and sizes[alone] * (count - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest = sizes[alone:]
    left = count - alone
    low = max([-(-total // left), *rest[:1]])
    high = low + (rest[0] if rest else 0)
    while (shards := best_fit(rest, high, left)) is None:
        low, high = high, 2 * high
    while low < high and high - low > high // 20_000:
        middle = (low + high) // 2
        if (tried := best_fit(rest, middle, left)) is None:
            low = middle + 1
        else:
            high, shards = middle, tried
    return list(range(alone)) + [alone + s for s in shards]


def _items(rows: DataFrame, total: int, target: int) -> tuple[DataFrame, DataFrame]:
    """The items ``(item, bytes, hot)`` and the rule that gives each group one."""
    fine = max(1, total // (target * FINE))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    large = written(groups.where(F.col("bytes") >= fine).select("group", "bytes"), "large-groups")
    small = (
        groups.where(F.col("bytes") < fine)
        .groupBy(F.pmod("group", F.lit(target * FINE)).alias("group")).agg(F.sum("bytes").alias("bytes"))
    )
    return large, written(small, "cells")


def shard(docs: DataFrame, key, size, *, count: int | None = None, capacity: int | None = None) -> DataFrame:
    """``docs`` in a struct ``row``, beside it ``size``, ``shard`` and ``slot``.

    Give ``count`` for so many shards of near equal size, or ``capacity`` for as few shards of that
    size as best fit decreasing needs (a larger group has a shard of its own). ``key`` and ``size``
    are columns. Writes keys and sizes and plans on the items when called.
    """
    spark = docs.sparkSession
    table = written(docs.select(
        F.struct("*").alias("row"), F.coalesce(F.xxhash64(key), F.lit(0)).alias("group"),
        size.cast("long").alias("size"), F.monotonically_increasing_id().alias("place")), "sized")
    rows = table.select("group", "size", "place")
    total = rows.agg(F.sum("size")).first()[0] or 0
    target = count or max(1, -(-total // capacity))
    large, small = _items(rows, total, target)
    items = sorted(((r["bytes"], hot, r["group"]) for hot, df in ((True, large), (False, small))
                    for r in df.toLocalIterator()), key=lambda x: (-x[0], x[1], x[2]))
    sizes = [x[0] for x in items]
    if count:
        shards = even(sizes, count)
    else:
        alone = sum(s > capacity for s in sizes)
        shards = list(range(alone)) + [alone + s for s in best_fit(sizes[alone:], capacity)]
    placed = spark.createDataFrame(
        [(hot, group, s) for (_, hot, group), s in zip(items, shards)], "hot boolean, item long, shard int")
    # at most FINE items of either kind for each shard
    hot = F.broadcast(placed.where("hot").select(F.col("item").alias("group"), F.col("shard").alias("own")))
    cell = F.broadcast(placed.where("not hot").select(F.col("item").alias("cell"), F.col("shard").alias("shared")))
    dealt = (
        table.join(hot, "group", "left").withColumn("cell", F.pmod("group", F.lit(target * FINE)))
        .join(cell, "cell", "left").withColumn("shard", F.coalesce("own", "shared"))
    )
    salts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("row", "size", "shard", "place", F.pmod(F.xxhash64("place"), F.lit(salts)).alias("salt"))
    counts = dealt.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "salt").orderBy("place")
    return dealt.withColumn("rank", F.row_number().over(within) - 1).join(starts, ["shard", "salt"]).select(
        "row", "size", "shard", (F.col("first") + F.col("rank")).alias("slot"))
