"""Composite maps from pairs of single-class maps, their labels and checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.constants import CLASSES
from fabspark.functions import kernels as K
from fabspark.operators.joins import null_safe_join
from fabspark.operators.splitting import id_hash
from fabspark.session import broadcast_if_small


def class_index(df: DataFrame, id_col: str, class_col: str, seed: int = 42, draw: Callable[[Column, int], Column] = id_hash) -> DataFrame:
    """Add ``_idx``: 0, 1, 2, ... per class in the order of ``draw``, a hash of id and seed.

    Hash cells keep a class out of one task: the index is the count of earlier cells plus the
    place within the cell. The cell counts hold at most 65,536 rows per class.
    """
    h = draw(F.col(id_col), seed)
    keyed = df.withColumns({"_h": h, "_cell": F.shiftright(h, 48).cast("int")})
    keys = [class_col, "_cell"]
    earlier = Window.partitionBy(class_col).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = null_safe_join(keyed, broadcast_if_small(offsets), keys).withColumn(
        "_idx", F.col("_before") + F.row_number().over(Window.partitionBy(*keys).orderBy("_h", id_col)) - 1)
    return placed.drop("_h", "_cell", "_before")


def pair_maps(
    df: DataFrame, id_col: str, class_col: str, blob: str, combos: Sequence[tuple], seed: int = 42,
    draw: Callable[[Column, int], Column] = id_hash,
) -> DataFrame:
    """Pair the maps of two classes one to one: ``id_a, id_b, class_a, class_b, map_a, map_b``.

    Every map is used at most once per combination, so there are as many pairs as the smaller
    class has maps and no key is hot.
    """
    kind = df.schema[class_col].dataType.simpleString()
    table = F.array(*[
        F.struct(F.lit(i).alias("combo"), F.lit(a).cast(kind).alias("a"), F.lit(b).cast(kind).alias("b"))
        for i, (a, b) in enumerate(combos)
    ])
    wanted = df.filter(F.col(class_col).isin(sorted({c for pair in combos for c in pair})))
    indexed = class_index(wanted.filter(F.col(blob).isNotNull()).select(id_col, class_col), id_col, class_col, seed, draw)

    def side(which: str) -> DataFrame:
        mine = F.filter(table, lambda c: c[which] == F.col(class_col))
        return indexed.withColumn("_combo", F.explode(mine)).select(
            F.col("_combo.combo").alias("combo"), "_idx", F.col(id_col).alias(f"id_{which}"),
            F.col(class_col).alias(f"class_{which}"))

    # Ids are ranked and paired first; each side's maps then move once, to the pairs that use them.
    pairs = side("a").join(side("b"), ["combo", "_idx"]).drop("_idx")
    for which in "ab":
        maps = wanted.select(F.col(id_col).alias(f"id_{which}"), F.col(blob).alias(f"map_{which}"))
        pairs = pairs.join(maps, f"id_{which}")
    return pairs.select("combo", "id_a", "class_a", "map_a", "id_b", "class_b", "map_b")


def overlay(a: Column, b: Column, size: int = 4096) -> Column:
    """A die is defective if it is in either map, else active if it is in either."""

    @F.arrow_udf("binary")
    def merge(left: pa.Array, right: pa.Array) -> pa.Array:
        return K.to_binary(np.maximum(K.byte_rows(left, size), K.byte_rows(right, size)))

    return F.when(a.isNotNull() & b.isNotNull(), merge(a, b))


def paste_defects(base: Column, donor: Column, draw: Column, side: int = 64, jitter: int = 3) -> Column:
    """Base map with the donor's defects, moved by up to ``jitter`` dies each way, wrapping round.

    ``draw`` is a non-negative integer that picks the move.
    """
    span = 2 * jitter + 1

    @F.arrow_udf("binary")
    def paste(left: pa.Array, right: pa.Array, moves: pa.Array) -> pa.Array:
        out = K.byte_rows(left, side * side).reshape(-1, side, side).copy()
        bad = (K.byte_rows(right, side * side) == 2).reshape(-1, side, side)
        move = moves.to_numpy(zero_copy_only=False) % (span * span)
        for m in np.unique(move):
            at = move == m
            shifted = np.roll(bad[at], (int(m) // span - jitter, int(m) % span - jitter), axis=(1, 2))
            out[at] = np.where(shifted, 2, out[at])
        return K.to_binary(out.reshape(len(out), -1))

    return F.when(base.isNotNull() & donor.isNotNull(), paste(base, donor, draw))


def multi_hot(labels: Column, classes: Sequence = CLASSES) -> Column:
    return F.transform(F.array(*[F.lit(c) for c in classes]), lambda c: F.array_contains(labels, c).cast("int"))


def composite_checks(a: Column, b: Column, out: Column, size: int = 4096) -> Column:
    """Defects of both kept, active area kept, no die outside the inputs, only known values."""

    @F.arrow_udf("struct<defects_kept:boolean,active_kept:boolean,inside_mask:boolean,values_valid:boolean>")
    def check(left: pa.Array, right: pa.Array, made: pa.Array) -> pa.Array:
        x, y, z = (K.byte_rows(c, size) for c in (left, right, made))
        results = [
            (((x == 2) | (y == 2)) <= (z == 2)).all(axis=1), (((x > 0) | (y > 0)) <= (z > 0)).all(axis=1),
            ((z > 0) <= ((x > 0) | (y > 0))).all(axis=1), (z <= 2).all(axis=1),
        ]
        names = ["defects_kept", "active_kept", "inside_mask", "values_valid"]
        return pa.StructArray.from_arrays([pa.array(r) for r in results], names=names)

    return check(a, b, out)
