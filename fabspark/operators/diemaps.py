"""Die-map operators: features, resizing, symmetry copies, class heatmaps.

Only the map column crosses to Python, in Arrow batches; every other column stays in the
JVM. No operator emits one row per die of every map.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fabspark.constants import TRAIN_AUGMENTATION
from fabspark.functions import kernels as K


# ---- codec ------------------------------------------------------------------------
def cells_to_binary(cells: Column) -> Column:
    """Array of 0/1/2 to one byte per die."""
    return F.unhex(F.array_join(F.transform(cells, lambda v: F.lpad(v.cast("string"), 2, "0")), ""))


def binary_to_cells(blob: Column) -> Column:
    """Bytes back to an array of ints, row-major."""
    pairs = F.regexp_extract_all(F.hex(blob), F.lit("(..)"))
    return F.transform(pairs, lambda h: F.conv(h, 16, 10).cast("int"))


def long_form(df: DataFrame, blob: str, *keep: str) -> DataFrame:
    """One row per die; the checkable twin of the kernels, not used by them."""
    return df.select(*keep, F.posexplode(binary_to_cells(F.col(blob))).alias("pos", "die"))


def map_validity(blob: Column, rows: Column | int, cols: Column | int) -> Column:
    """True when the byte count matches the shape and only 0, 1 and 2 occur."""
    size = F.lit(rows) * F.lit(cols)
    return F.coalesce((F.length(blob) == size) & F.hex(blob).rlike("^(0[012])*$"), F.lit(False))


def die_values(blob: Column) -> Column:
    """Distinct die values present in a map, ascending."""
    digits = F.hex(blob)
    present = [F.when(digits.rlike(f"^(..)*{v:02X}"), F.lit(v)) for v in range(3)]
    return F.array_compact(F.array(*present))


# ---- features ---------------------------------------------------------------------
_FEATURES = (
    "struct<defect_density:double,active_ratio:double,edge_defect_ratio:double,"
    "center_defect_ratio:double,radial_mean:double,defect_count:int,active_count:int>"
)


def spatial_features(blob: Column, rows: int = 64, cols: int = 64) -> Column:
    """Seven disc-geometry features of a fixed-size map; all 0 when no die is active."""
    size = rows * cols

    @F.arrow_udf(_FEATURES)
    def features(column: pa.Array) -> pa.Array:
        maps = K.byte_rows(column, size)
        sums, active = K.region_sums(maps, K.region_weights(rows, cols, "disc"))
        defects, edge, center, dist = sums.T
        on = np.maximum(active, 1)
        values = [
            defects / on, active / size, edge / (defects + 1e-9), center / (defects + 1e-9),
            dist / np.maximum(defects, 1), defects.astype(np.int32), active.astype(np.int32),
        ]
        names = ["defect_density", "active_ratio", "edge_defect_ratio", "center_defect_ratio",
                 "radial_mean", "defect_count", "active_count"]
        return pa.StructArray.from_arrays([pa.array(v) for v in values], names=names)

    return F.when(blob.isNotNull(), features(blob))


def mechanism_metrics(blob: Column, rows: int = 64, cols: int = 64) -> Column:
    """Centre, edge and ring shares of the defects (diagonal geometry), and density."""
    size = rows * cols

    @F.arrow_udf("struct<center_ratio:double,edge_ratio:double,ring_ratio:double,defect_density:double>")
    def metrics(column: pa.Array) -> pa.Array:
        maps = K.byte_rows(column, size)
        sums, active = K.region_sums(maps, K.region_weights(rows, cols, "diagonal"))
        total = sums[:, 0] + 1e-8
        values = [sums[:, 1] / total, sums[:, 2] / total, sums[:, 3] / total, sums[:, 0] / (active + 1e-8)]
        names = ["center_ratio", "edge_ratio", "ring_ratio", "defect_density"]
        return pa.StructArray.from_arrays([pa.array(v) for v in values], names=names)

    return F.when(blob.isNotNull(), metrics(blob))


def defect_ratio(blob: Column) -> Column:
    """Defective share of the active dies of a map of any size; 0 if none is active."""

    @F.arrow_udf("double")
    def ratio(column: pa.Array) -> pa.Array:
        column = column.cast(pa.binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        d, a = (K.ragged_counts(mask, offsets) for mask in (data == 2, data > 0))
        return pa.array(np.where(a > 0, d / np.maximum(a, 1), 0.0))

    return F.when(blob.isNotNull(), ratio(blob))


# ---- resizing and scaling ---------------------------------------------------------
def resize_nearest(map_struct: Column, out_rows: int = 64, out_cols: int = 64) -> Column:
    """Nearest-neighbour resize of ``struct<rows,cols,cells>``; values stay 0/1/2.

    NULL for a map that is missing or does not fit its shape.
    """

    @F.arrow_udf("binary")
    def resize(column: pa.Array) -> pa.Array:
        out, valid = np.zeros((len(column), out_rows * out_cols), np.uint8), np.zeros(len(column), bool)
        for at, rows, cols, maps in K.map_structs(column):
            out[at] = maps[:, K.gather_index(rows, cols, out_rows, out_cols)]
            valid[at] = True
        return K.to_binary(out, valid)

    return resize(map_struct)


def resize_defect_mask(map_struct: Column, out_rows: int = 64, out_cols: int = 64) -> Column:
    """Area-averaged defect mask, as an array of shares in row-major order.

    NULL for a map that is missing or does not fit its shape.
    """

    @F.arrow_udf("array<double>")
    def resize(column: pa.Array) -> pa.Array:
        out, valid = np.zeros((len(column), out_rows * out_cols)), np.zeros(len(column), bool)
        for at, rows, cols, maps in K.map_structs(column):
            valid[at] = True
            mask = (maps == 2).reshape(-1, rows, cols).astype(np.float64)
            left, right = K.overlap_matrix(rows, out_rows), K.overlap_matrix(cols, out_cols)
            out[at] = np.einsum("ir,nrc,jc->nij", left, mask, right, optimize=True).reshape(len(at), -1)
        size = out_rows * out_cols
        offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * size)
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()), mask=pa.array(~valid))

    return resize(map_struct)


def normalise(cells: Column) -> Column:
    """0/1/2 to 0.0/0.5/1.0, clipped to [0, 1]."""
    return F.transform(cells, lambda v: F.least(F.greatest(v / 2, F.lit(0.0)), F.lit(1.0)).cast("float"))


# ---- symmetry copies --------------------------------------------------------------
def symmetry(blob: Column, hflip: Column, vflip: Column, turns: Column, side: int = 64) -> Column:
    """Flip left-right, then top-bottom, then turn by quarter turns anticlockwise."""
    code = (hflip.cast("int") + 2 * vflip.cast("int") + 4 * F.pmod(turns.cast("int"), F.lit(4))).cast("int")

    @F.arrow_udf("binary")
    def apply(column: pa.Array, codes: pa.Array) -> pa.Array:
        maps = K.byte_rows(column, side * side)
        codes, table, out = codes.fill_null(0).to_numpy(zero_copy_only=False), K.symmetry_table(side, side), np.empty_like(maps)
        for code in np.unique(codes):  # one index row per code, not per map
            out[codes == code] = maps[codes == code][:, table[code]]
        return K.to_binary(out)

    return F.when(blob.isNotNull(), apply(blob, code))


def augmented_copies(df: DataFrame, id_col: str, blob: str, copies: int, side: int = 64, seed: int = 42) -> DataFrame:
    """``copies`` flipped or turned variants per map; the draw depends only on id, copy and seed."""
    draw = F.xxhash64(F.col(id_col), F.col("copy"), F.lit(seed))
    return (
        df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .withColumn("_draw", F.pmod(draw, F.lit(16)))
        .withColumn(blob, symmetry(
            F.col(blob), F.col("_draw") % 2, F.floor(F.col("_draw") / 2) % 2, F.floor(F.col("_draw") / 4), side
        ))
        .drop("_draw")
    )


# ---- random image steps -----------------------------------------------------------
MAPS_AT_ONCE = 1024
_M31 = (1 << 31) - 1


def _mix31(x: np.ndarray) -> np.ndarray:
    """Mixes 31 bits; products stay below 2^62, so SQL can do the same in whole numbers."""
    x = (x ^ (x >> 16)) * 0x45D9F3B & _M31
    x = (x ^ (x >> 15)) * 0x2C1B3C6D & _M31
    return x ^ (x >> 16)


def draw31(seeds: np.ndarray, step: int, number) -> np.ndarray:
    """Uniform draws in [0, 1): the ``number``-th of a map's ``step``. A counter in place of a state, so all maps draw at once."""
    return _mix31((_mix31((seeds + 7919 * step) & _M31) + number) & _M31) / float(1 << 31)


def augmented(maps: np.ndarray, seeds: np.ndarray, config: dict) -> np.ndarray:
    """Random image steps on a stack of maps with values in [0, 1]; a step works on all maps that it hits."""
    count, side = maps.shape[0], maps.shape[1]
    y, x = np.mgrid[:side, :side]
    middle, every = (side - 1) / 2, np.arange(count)
    for step, (name, c) in enumerate(config.items(), 1):
        hit = np.flatnonzero(draw31(seeds, step, 0) < c["p"])
        if not len(hit):
            continue
        own, part = seeds[hit], maps[hit]

        def between(low: float, high: float, number: int) -> np.ndarray:
            return low + (high - low) * draw31(own, step, number)

        def whole(low, high, number: int) -> np.ndarray:
            return (low + np.floor((high - low + 1) * draw31(own, step, number))).astype(int)

        if name == "Rotate":
            angle = np.deg2rad(between(-c["limit"], c["limit"], 1))[:, None, None]
            sy = np.floor(np.cos(angle) * (y - middle) + np.sin(angle) * (x - middle) + middle + 0.5).astype(int)
            sx = np.floor(np.cos(angle) * (x - middle) - np.sin(angle) * (y - middle) + middle + 0.5).astype(int)
            inside = (sy >= 0) & (sy < side) & (sx >= 0) & (sx < side)
            part = part[every[:len(hit), None, None], sy.clip(0, side - 1), sx.clip(0, side - 1)] * inside
        elif name == "HorizontalFlip":
            part = part[:, :, ::-1]
        elif name == "VerticalFlip":
            part = part[:, ::-1]
        elif name == "GaussNoise":
            spread = np.sqrt(between(*c["var_limit"], 1))[:, None, None]
            pixel = 2 + 2 * (y * side + x)
            u, v = (draw31(own[:, None, None], step, pixel + k) for k in (0, 1))
            part = part + spread * np.sqrt(-2 * np.log(1 - u)) * np.cos(2 * np.pi * v)
        elif name == "Blur":
            size = c["blur_limit"]
            wide = np.pad(part, ((0, 0), (size // 2,) * 2, (size // 2,) * 2), mode="reflect")
            part = sum(wide[:, i:i + side, j:j + side] for i in range(size) for j in range(size)) / size**2
        elif name == "RandomBrightnessContrast":
            contrast, light = (between(-c[k], c[k], n)[:, None, None] for n, k in enumerate(("contrast_limit", "brightness_limit"), 1))
            part = part * (1 + contrast) + light
        elif name == "CoarseDropout":
            holes = whole(c["min_holes"], c["max_holes"], 1)
            for k in range(c["max_holes"]):
                high, wide = (whole(c[f"min_{d}"], c[f"max_{d}"], 2 + 4 * k + n) for n, d in enumerate(("height", "width")))
                top, left = (np.floor(draw31(own, step, 4 + 4 * k + n) * (side - d + 1)).astype(int) for n, d in enumerate((high, wide)))
                covers = [(p >= a[:, None, None]) & (p < (a + d)[:, None, None]) for p, a, d in ((y, top, high), (x, left, wide))]
                part = np.where(covers[0] & covers[1] & (k < holes)[:, None, None], c["fill_value"], part)
        else:
            raise ValueError(f"unknown step {name}")
        maps[hit] = part
    return np.clip(maps, 0.0, 1.0)


def augment_image(blob: Column, draw: Column, side: int = 64, config: dict = TRAIN_AUGMENTATION) -> Column:
    """Normalised map after the random image steps of ``config``, as ``array<float>``.

    ``draw`` is a hash per copy, of which 31 bits seed that map's draws. Maps are worked on in
    stacks of ``MAPS_AT_ONCE``, so memory does not grow with the batch.
    """

    @F.arrow_udf("array<float>")
    def augment(column: pa.Array, seeds: pa.Array) -> pa.Array:
        low = np.asarray(seeds.fill_null(0)).astype(np.int64) & _M31
        out = np.empty((len(low), side * side), np.float32)
        for start in range(0, len(low), MAPS_AT_ONCE):
            part = slice(start, start + MAPS_AT_ONCE)
            maps = K.byte_rows(column.slice(start, MAPS_AT_ONCE), side * side).reshape(-1, side, side) / 2.0
            out[part] = augmented(maps, low[part], config).reshape(len(maps), -1)
        offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * (side * side))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return F.when(blob.isNotNull(), augment(blob, draw))


# ---- class heatmaps ---------------------------------------------------------------
SLOTS = 64
def _class_sums(df: DataFrame, class_col: str, values: str, kind: str) -> DataFrame:
    """One summed vector per task and class, from a map or array column."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            if kind == "map":
                column = batch.column("v").cast(pa.binary()).drop_null()
                if not len(column):
                    continue
                rows = (K.byte_rows(column, len(column[0].as_py())) == 2).astype(np.float64)
            else:
                column = batch.column("v").drop_null()
                if not len(column):
                    continue
                rows = np.abs(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)
            codes = batch.filter(batch.column("v").is_valid()).column("c").dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            for i, label in enumerate(codes.dictionary.to_pylist()):
                part = rows[index == i]
                n, total = totals.get(label, (0, 0.0))
                totals[label] = (n + len(part), total + part.sum(axis=0))
        if totals:
            yield pa.RecordBatch.from_pydict({
                "c": pa.array(list(totals), class_type),
                "n": pa.array([n for n, _ in totals.values()], pa.int64()),
                "total": pa.array([list(t) for _, t in totals.values()], pa.list_(pa.float64())),
            })

    picked = df.select(F.col(class_col).alias("c"), F.col(values).alias("v"))
    kind_of_class = picked.schema["c"].dataType
    class_type = to_arrow_type(kind_of_class)
    return picked.mapInArrow(sums, f"c {kind_of_class.simpleString()}, n bigint, total array<double>")


def class_heatmap(df: DataFrame, class_col: str, values: str, kind: str = "map") -> DataFrame:
    """Cell-wise mean per class: of ``die == 2`` (``kind='map'``) or of ``|value|`` (``'array'``).

    Each task sends one vector per class. Vectors are added as vectors, first per class and slot of
    tasks, then per class, and only the class means become cells.
    """
    def added(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(Summarizer.sum(F.col("v")).alias("v"), F.sum("n").alias("n"))

    partial = _class_sums(df, class_col, values, kind)
    partial = partial.select("c", "n", array_to_vector("total").alias("v"), (F.spark_partition_id() % SLOTS).alias("slot"))
    whole = added(added(partial, "c", "slot"), "c").select("c", "n", vector_to_array("v").alias("total"))
    return whole.select(F.col("c").alias(class_col), F.posexplode("total").alias("pos", "s"), "n").select(
        class_col, "pos", (F.col("s") / F.col("n")).alias("mean_value"), F.col("n").alias("n_maps"))


def heatmap_entropy(heatmap: DataFrame, class_col: str) -> DataFrame:
    """Entropy of each class mean map, taken as a distribution over cells."""
    # sum(-p ln p) with p = m / S equals ln S - sum(m ln m) / S: one pass, no join back.
    m = F.col("mean_value") + 1e-10
    return heatmap.groupBy(class_col).agg(
        (F.ln(F.sum(m)) - F.sum(m * F.ln(m)) / F.sum(m)).alias("spatial_entropy"),
        F.max("n_maps").alias("n_samples"),
    )


def spatial_evidence(df: DataFrame, class_col: str, blob: str, rows: int = 64, cols: int = 64) -> DataFrame:
    """Class means of the mechanism metrics, with entropy and sample count."""
    means = (
        df.select(class_col, mechanism_metrics(F.col(blob), rows, cols).alias("m"))
        .groupBy(class_col)
        .agg(*[F.avg(f"m.{c}").alias(c) for c in ("center_ratio", "edge_ratio", "ring_ratio", "defect_density")])
    )
    return means.join(heatmap_entropy(class_heatmap(df, class_col, blob), class_col), class_col)
