"""Best-fit-decreasing packing of indivisible groups into shards of one fixed capacity.

Groups are dealt by hash to cells. Inside a cell they enter blocks, largest first, each into the
fullest block that still takes it; a balanced tree over the blocks' free room finds that block.
The blocks, a number fixed by ``BLOCKS_PER_SHARD`` and the cells, then enter the shards in the
same way. A group larger than a block is a block of its own. A group above the mean of a shard is a
shard of its own; blocks and capacity are then measured by what is left.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.session import cut_lineage

BLOCKS_PER_SHARD = 512
SALTS = 64


class RoomTree:
    """Free rooms of bins in an AVL tree ordered by (room, bin)."""

    __slots__ = ("left", "right", "high", "keys", "root", "free")

    def __init__(self) -> None:
        self.left, self.right, self.high, self.keys = [0], [0], [0], [(0, 0)]
        self.root, self.free = 0, []

    def _fix(self, n: int) -> int:
        left, right, high = self.left, self.right, self.high
        tilt = high[left[n]] - high[right[n]]
        if tilt > 1:
            if high[left[left[n]]] < high[right[left[n]]]:
                left[n] = self._turn(left[n], right, left)
            return self._turn(n, left, right)
        if tilt < -1:
            if high[right[right[n]]] < high[left[right[n]]]:
                right[n] = self._turn(right[n], left, right)
            return self._turn(n, right, left)
        high[n] = 1 + max(high[left[n]], high[right[n]])
        return n

    def _turn(self, n: int, near: list[int], far: list[int]) -> int:
        up, high = near[n], self.high
        near[n], far[up] = far[up], n
        high[n] = 1 + max(high[near[n]], high[far[n]])
        high[up] = 1 + max(high[near[up]], high[far[up]])
        return up

    def add(self, room: int, name: int) -> None:
        key, path, n = (room, name), [], self.root
        while n:
            path.append(n)
            n = self.left[n] if key < self.keys[n] else self.right[n]
        if self.free:
            n = self.free.pop()
            self.keys[n], self.left[n], self.right[n], self.high[n] = key, 0, 0, 1
        else:
            n = len(self.keys)
            self.keys.append(key)
            self.left.append(0)
            self.right.append(0)
            self.high.append(1)
        self._climb(path, n)

    def _climb(self, path: list[int], child: int) -> None:
        for i in range(len(path) - 1, -1, -1):
            n = path[i]
            key = self.keys[child] if child else None
            if child and key < self.keys[n]:
                self.left[n] = child
            elif child:
                self.right[n] = child
            child = self._fix(n)
        self.root = child

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest (room, bin) with room for ``size``."""
        path, n, found = [], self.root, 0
        while n:
            path.append(n)
            if self.keys[n][0] >= size:
                found = len(path)
                n = self.left[n]
            else:
                n = self.right[n]
        if not found:
            return None
        path = path[:found]
        n = path.pop()
        key, child = self.keys[n], self.right[n]  # the smallest that fits: nothing that fits is to its left
        if self.left[n] and child:
            spot, down = child, [n]
            while self.left[spot]:
                down.append(spot)
                spot = self.left[spot]
            self.keys[n] = self.keys[spot]
            self._relink(path + down, spot, self.right[spot])
            self.free.append(spot)
        else:
            self._relink(path, n, child or self.left[n])
            self.free.append(n)
        return key

    def _relink(self, path: list[int], old: int, new: int) -> None:
        for n in reversed(path):
            if self.left[n] == old:
                self.left[n] = new
            else:
                self.right[n] = new
            old, new = n, self._fix(n)
        self.root = new


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each size and the number of bins; a size over ``capacity`` has a bin of its own."""
    sizes = list(sizes)
    tree, bins, used = RoomTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        spot = tree.take(sizes[i]) if sizes[i] <= capacity else None
        if spot is None:
            spot = (max(capacity, sizes[i]), used)
            used += 1
        bins[i] = spot[1]
        if spot[0] > sizes[i]:
            tree.add(spot[0] - sizes[i], spot[1])
    return bins, used


def alone(largest: Iterable[int], total: int, shards: int) -> tuple[int, int]:
    """How many of the sizes, largest first, are above the mean of what they leave, and the sum of the others."""
    count = 0
    for size in largest:
        if size * (shards - count) <= total:
            break
        count, total = count + 1, total - size
    return count, total


def fit_bins(sizes: list[int], shards: int) -> list[int]:
    """Bins for a given number of shards: the smallest capacity on a fine scale that suffices.

    Sizes above the mean have a bin each, and the capacity is that of the others over the bins
    left. A bin that best fit leaves empty takes half of the fullest one that can be halved.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    own, rest = alone((sizes[i] for i in order), sum(sizes), shards)
    bins = [0] * len(sizes)
    for k, i in enumerate(order[:own]):
        bins[i] = k
    order = order[own:]
    if not order:
        return bins
    others = [sizes[i] for i in order]
    least = max(1, -(-rest // (shards - own)), others[0])
    for step in range(1_000_000):
        found, used = best_fit_decreasing(others, least + step * max(1, least // 4096))
        if used <= shards - own:
            break
    held: list[list[int]] = [[] for _ in range(used)]
    for i, k in zip(order, found):
        held[k].append(i)
    while len(held) < shards - own:
        full = max((h for h in held if len(h) > 1), key=lambda h: sum(sizes[i] for i in h), default=None)
        if full is None:
            break
        moved, room = [], sum(sizes[i] for i in full) // 2
        for i in full:
            if sizes[i] <= room:
                moved.append(i)
                room -= sizes[i]
        if not moved:
            moved = full[1:]
        gone = set(moved)
        full[:] = [i for i in full if i not in gone]
        held.append(moved)
    for k, names in enumerate(held):
        for i in names:
            bins[i] = own + k
    return bins


def pack(groups: DataFrame, shards: int | None = None, capacity: int | None = None,
         cells: int | None = None) -> DataFrame:
    """``group_key``, ``shard`` for one row per group with ``group_key`` and ``bytes``.

    Give ``shards`` for near equal sizes, or ``capacity`` for as few shards as best fit needs. A
    group over the capacity, or above the mean of what the larger ones leave, is a shard of its
    own. Without groups the result is empty.
    """
    session = groups.sparkSession
    cells = cells or int(session.conf.get("spark.sql.shuffle.partitions"))
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    left = shards or max(1, math.ceil(total / capacity))
    if shards:
        largest = groups.select("bytes").orderBy(F.desc("bytes")).limit(shards).collect()
        own, total = alone((r["bytes"] for r in largest), total, shards)
        left -= own
    block = max(1, math.ceil(total / left / BLOCKS_PER_SHARD))

    def blocks_of(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("group_key", "ascending")])
        bins, _ = best_fit_decreasing(table["bytes"].to_pylist(), block)
        return table.append_column("block", pa.array(bins, pa.int32()))

    def shards_of(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("cell", "ascending"), ("block", "ascending")])
        sizes = table["bytes"].to_pylist()
        bins = fit_bins(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)[0]
        return table.select(["cell", "block"]).append_column("shard", pa.array(bins, pa.int32()))

    dealt = groups.select("group_key", "bytes", F.pmod(F.xxhash64("group_key", F.lit(1)), F.lit(cells)).cast("int").alias("cell"))
    blocks = cut_lineage(dealt.groupBy("cell").applyInArrow(blocks_of, "group_key long, bytes long, cell int, block int"))
    sums = blocks.groupBy("cell", "block").agg(F.sum("bytes").alias("bytes")).withColumn("all", F.lit(0))
    packed = sums.groupBy("all").applyInArrow(shards_of, "cell int, block int, shard int")
    return blocks.join(packed, ["cell", "block"]).select("group_key", "shard")


def shard(docs: DataFrame, shards: int | None = 24, capacity: int | None = None, text: str = "text",
          doc_id: str = "doc_id", size: Column | None = None) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``; equal texts share a shard.

    A row's size is its text's UTF-8 bytes plus 8. Null and empty texts are one group. Slots
    count from 0 in each shard without gaps; rows equal in id and text are interchangeable.
    Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("size", "shard", "slot")
    size = size if size is not None else F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    keyed = docs.withColumns({
        "size": size, "_group": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
        "_salt": F.pmod(F.xxhash64(doc_id), F.lit(SALTS)).cast("int"),
    })
    # A large group of copies is many salted rows here and in every later join.
    salted = cut_lineage(keyed.groupBy("_group", "_salt").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    groups = salted.groupBy(F.col("_group").alias("group_key")).agg(F.sum("bytes").alias("bytes"))
    packed = pack(groups, shards, capacity)
    salted = salted.join(packed, F.col("_group") == F.col("group_key")).select(
        "_group", "_salt", "n", "shard", F.pmod(F.xxhash64("_group", "_salt"), F.lit(1024)).cast("int").alias("_part"))
    parts = salted.groupBy("shard", "_part").agg(F.sum("n").alias("_n"))
    ahead = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("shard", "_part").orderBy("_group", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    places = salted.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, ["shard", "_part"])
    places = places.select("_group", "_salt", "shard", (F.col("_ahead") + F.col("_inside")).alias("_place"))
    number = F.row_number().over(Window.partitionBy("_group", "_salt").orderBy(doc_id))
    placed = keyed.join(places, ["_group", "_salt"]).withColumn("slot", (F.col("_place") + number - 1).cast("long"))
    return placed.drop("_group", "_salt", "_place")
