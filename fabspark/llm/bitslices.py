"""Exact top-k by integer inner product over a bit-sliced index.

Components become whole numbers (``floor(scale * x)``). Rows in ascending id order are cut into
blocks, and a block holds, for each component, one bitmap over its rows per binary digit. A query's
score for all rows of a block is one sum of bitmaps: a digit of the row times a digit of the query
is the row's bitmap at the sum of both places, negative factors take the complement, and carry-save
adders turn all bitmaps of a place into one and carries to the next. The best ``k`` rows are read
off the sum from its highest slice down; rows that still tie at the border are settled by id, which
is the order of their bits. Blocks and groups of queries meet in the cells of a grid, so memory
depends on neither's number, and a window keeps the best of all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabspark.llm.storage import saved
from fabspark.session import broadcast_if_small

SCALE = 64
BLOCK = 1 << 14
GROUP = 512
LARGEST = 1 << 24  # scores of up to 8,192 such components fit 64 bits
WIDEST = 1 << 13
INDEX = "block long, width int, ids array<long>, low array<long>, digits array<int>, slices binary"


# ---- bitmaps ------------------------------------------------------------------------------
def slice_rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value and number of digits per column of whole numbers, and the bitmaps in column order."""
    low = values.min(axis=0)
    above = (values - low).T
    digits = np.array([int(x).bit_length() for x in above.max(axis=1)], np.int32)
    room = -(-values.shape[0] // 64) * 64
    maps = np.zeros((int(digits.sum()), room), bool)
    column, place = layout(digits)
    for p in range(int(digits.max(initial=0))):
        rows = np.flatnonzero(place == p)
        maps[rows, :values.shape[0]] = above[column[rows]] >> p & 1
    return low, digits, np.packbits(maps, axis=1, bitorder="little").view(np.uint64)


def layout(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column and binary place of each bitmap."""
    column = np.repeat(np.arange(len(digits)), digits)
    return column, np.arange(len(column)) - np.repeat(np.cumsum(digits) - digits, digits)


def row_values(low: np.ndarray, digits: np.ndarray, maps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole numbers of some rows, read back from the bitmaps."""
    column, place = layout(digits)
    out = np.tile(low, (len(rows), 1)).astype(np.int64)
    if len(column) and len(rows):
        bits = (maps[:, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
        np.add.at(out.T, column, bits << place[:, None])
    return out


def add_maps(places: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Digits of the row-wise sum of bitmaps, ``places[p]`` holding stacks of weight ``2 ** p``."""
    out, p = [], 0
    while p < len(places):
        stack = np.concatenate(places[p]) if places[p] else np.zeros((0, words), np.uint64)
        carries = []
        while len(stack) > 2:  # full adders, all threes at once
            third = len(stack) // 3
            a, b, c = stack[:third], stack[third:2 * third], stack[2 * third:3 * third]
            half = a ^ b
            carries.append(a & b | half & c)
            stack = np.concatenate([half ^ c, stack[3 * third:]])
        if len(stack) == 2:
            carries.append((stack[0] & stack[1])[None])
            stack = (stack[0] ^ stack[1])[None]
        if carries:
            if p + 1 == len(places):
                places.append([])
            places[p + 1] += carries
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        p += 1
    return out


def scores(low: np.ndarray, digits: np.ndarray, maps: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of the inner product of every row with ``query``, above a constant."""
    column, place = layout(digits)
    factor, sign = np.abs(query)[column], query[column] < 0
    base = int((query * low).sum()) - int((np.abs(query) * ((1 << digits.astype(np.int64)) - 1))[query < 0].sum())
    places: list[list[np.ndarray]] = [[] for _ in range(int(place.max(initial=-1)) + int(factor.max(initial=0)).bit_length())]
    for q in range(int(factor.max(initial=0)).bit_length()):
        used = (factor >> q & 1).astype(bool)
        for p in np.unique(place[used]):
            rows = np.flatnonzero(used & (place == p))
            flip = np.where(sign[rows], ~np.uint64(0), np.uint64(0))
            places[q + p].append(maps[rows] ^ flip[:, None])
    return add_maps(places, maps.shape[1]), base


def best(slices: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` largest sums in ``among`` (all, if fewer); of equal ones the first."""
    sure, open_ = np.zeros_like(among), among
    for s in reversed(slices):
        if not open_.any():
            break
        high = open_ & s
        n = int(np.bitwise_count(sure | high).sum())
        if n > k:
            open_ = high
        else:
            sure, open_ = sure | high, open_ & ~s
            if n == k:
                open_ = np.zeros_like(among)
    rows = members(sure)
    return np.concatenate([rows, members(open_)[:k - len(rows)]])


def members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


# ---- Spark --------------------------------------------------------------------------------
def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE,
                block: int = BLOCK) -> DataFrame:
    """One row per block of up to ``block`` vectors in ascending id order, written as a table.

    Null and empty vectors, and those with null or non-finite components, are left out; so are
    those beyond ``LARGEST`` or ``WIDEST``, whose scores may not fit 64 bits. Vectors of different
    lengths are in different blocks. Null ids come last; repeated rows and ids are all kept. Other
    columns are ignored.
    """
    values = F.transform(F.col(embedding).cast("array<double>"), lambda x: F.floor(x * scale))
    sane = F.forall(F.col(embedding).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < LARGEST))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(sane, values).cast("array<int>").alias("v"))
    rows = rows.filter("v IS NOT NULL").withColumn("width", F.size("v")).filter(f"width BETWEEN 1 AND {WIDEST}")
    rows = rows.repartitionByRange("width", F.col("vec_id").asc_nulls_last())
    rows = rows.sortWithinPartitions("width", F.col("vec_id").asc_nulls_last()).select(
        "vec_id", "v", "width", F.spark_partition_id().alias("part"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        number = 0

        def flush(part: int) -> pa.RecordBatch:
            low, digits, maps = slice_rows(np.concatenate([v for _, v in held]).astype(np.int64))
            ids = pa.concat_arrays([i for i, _ in held])
            held.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + number], pa.int64()), pa.array([len(low)], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([low], pa.list_(pa.int64())), pa.array([digits], pa.list_(pa.int32())), pa.array([maps.tobytes()], pa.binary()),
            ], ["block", "width", "ids", "low", "digits", "slices"])

        part = 0
        for batch in batches:
            width, start = np.asarray(batch.column("width")), 0
            while start < batch.num_rows:
                part = batch.column("part")[start].as_py()
                if held and (held[0][1].shape[1] != width[start] or sum(len(i) for i, _ in held) == block):
                    yield flush(part)
                    number += 1
                end = min(int(np.searchsorted(width, width[start], "right")), start + block - sum(len(i) for i, _ in held))
                some = batch.slice(start, end - start)
                held.append((some.column("vec_id"), np.asarray(some.column("v").flatten()).reshape(end - start, -1)))
                start = end
        if held:
            yield flush(part)

    return saved(rows.mapInArrow(blocks, INDEX), "bit-slices")


def index_queries(index: DataFrame, every: int) -> DataFrame:
    """The index's own rows whose id is divisible by ``every``: ``query_id``, place (``block``, ``slot``), ``width``, ``v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.array([1 if i is None else i for i in r["ids"]], np.int64)
                named = np.array([i is not None for i in r["ids"]])
                rows = np.flatnonzero(named & (ids % every == 0))
                maps = np.frombuffer(r["slices"], np.uint64).reshape(sum(r["digits"]), -(-len(ids) // 64))
                values = row_values(np.array(r["low"]), np.array(r["digits"], np.int32), maps, rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[rows]), pa.array(np.full(len(rows), r["block"])), pa.array(rows.astype(np.int32)),
                    pa.array(np.full(len(rows), r["width"], np.int32)), pa.array(list(values.astype(np.int32)), pa.list_(pa.int32())),
                ], ["query_id", "block", "slot", "width", "v"])

    return index.mapInArrow(run, "query_id long, block long, slot int, width int, v array<int>")


def search(index: DataFrame, queries: DataFrame, k: int, group: int = GROUP, cell: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best rows of ``index`` for each row of ``queries``.

    ``queries`` has the columns of :func:`index_queries`; a query's own place (null: none) is no
    candidate, every other row of its length is, repeated ids included. Ties go to the smaller id,
    null ids last. A query without candidates has no rows.
    """
    queries = saved(queries, "bit-slice-queries")
    groups = max(1, -(-queries.count() // group))
    dealt = queries.withColumn("group", F.pmod(F.xxhash64("block", "slot", "query_id"), F.lit(groups)).cast("int"))
    # Neighbouring blocks of few rows share a cell, up to ``cell`` rows.
    upto = Window.partitionBy("width").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    cells = index.select("block", "width", F.floor((F.sum(F.size("ids")).over(upto) - 1) / cell).alias("cell"))
    places = broadcast_if_small(cells.select("width", "cell").distinct())
    visits = dealt.join(places, "width").select("width", "cell", "group", "query_id", "block", "slot", "v")
    residents = index.join(broadcast_if_small(cells.select("block", "cell")), "block").withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        out = {c: [] for c in ("query_id", "block", "slot", "vec_id", "score")}
        if blocks.num_rows and asked.num_rows:
            first, at, parts = {}, 0, []
            for r in np.argsort(np.asarray(blocks["block"].combine_chunks())).tolist():
                ids, low, digits = (blocks[c][r].values for c in ("ids", "low", "digits"))
                low, digits = np.asarray(low), np.asarray(digits)
                maps = np.frombuffer(blocks["slices"][r].as_buffer(), np.uint64).reshape(int(digits.sum()), -(-len(ids) // 64))
                parts.append((ids, low, digits, maps))
                first[blocks["block"][r].as_py()] = at
                at += len(ids)
            ids = pa.concat_arrays([p[0] for p in parts])
            if len(parts) > 1:  # small blocks are sliced anew as one
                low, digits, maps = slice_rows(np.concatenate([row_values(*p[1:], np.arange(len(p[0]))) for p in parts]))
            every = np.packbits(np.arange(maps.shape[1] * 64) < at, bitorder="little").view(np.uint64)
            values = np.asarray(asked["v"].combine_chunks().flatten()).reshape(asked.num_rows, -1).astype(np.int64)
            for query, name, own, slot in zip(values, *(asked[c].to_pylist() for c in ("query_id", "block", "slot"))):
                among = every
                if own in first:
                    among, place = every.copy(), first[own] + slot
                    among[place >> 6] &= ~(np.uint64(1) << np.uint64(place & 63))
                slices, base = scores(low, digits, maps, query)
                rows = best(slices, among, k)
                value = np.full(len(rows), base, np.int64)
                for p, s in enumerate(slices):
                    value += (s[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << p
                out["query_id"] += [name] * len(rows)
                out["block"] += [own] * len(rows)
                out["slot"] += [slot] * len(rows)
                out["vec_id"].append(ids.take(pa.array(rows)))
                out["score"].append(value)
        return pa.table({
            "query_id": pa.array(out["query_id"], pa.int64()), "block": pa.array(out["block"], pa.int64()), "slot": pa.array(out["slot"], pa.int32()),
            "vec_id": pa.concat_arrays(out["vec_id"] or [pa.array([], pa.int64())]),
            "score": np.concatenate(out["score"] or [np.zeros(0, np.int64)])})

    keys = ["width", "cell", "group"]
    found = residents.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(
        run, "query_id long, block long, slot int, vec_id long, score long")
    order = Window.partitionBy("query_id", "block", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(64 * x)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
