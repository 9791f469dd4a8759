"""Numpy work on batches of die maps, called by Spark as Arrow functions.

A die map is row-major bytes: 0 empty, 1 good die, 2 defective die.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 512


def byte_rows(column: pa.Array, size: int) -> np.ndarray:
    """Equal-length byte values as an ``(n, size)`` matrix; NULL rows read as zeros."""
    column = column.cast(pa.binary())
    if column.null_count:
        column = pc.fill_null(column, bytes(size))
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + n + 1]
    if n and not (np.diff(offsets) == size).all():
        raise ValueError(f"die maps must all hold {size} cells")
    if n == 0 or size == 0:
        return np.zeros((n, size), np.uint8)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[-1]].reshape(n, size)


def ragged_counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Set cells per row of a ragged byte column, without wide copies of all cells."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(mask[: offsets[-1]], offsets[:-1][full], dtype=np.int64)
    return out


def to_binary(rows: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Inverse of ``byte_rows`` for a contiguous matrix of equal-length rows; NULL where not ``valid``."""
    n, size = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * size
    data = np.ascontiguousarray(rows, dtype=np.uint8)
    bits = None if valid is None else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [bits, pa.py_buffer(offsets), pa.py_buffer(data)])


def distances(rows: int, cols: int) -> np.ndarray:
    y, x = np.ogrid[:rows, :cols]
    return np.sqrt((y - rows / 2) ** 2 + (x - cols / 2) ** 2).ravel()


def region_weights(rows: int, cols: int, geometry: str) -> np.ndarray:
    """Columns to sum over defective cells: all, then the regions, then distance."""
    dist = distances(rows, cols)
    if geometry == "disc":
        radius = min(rows, cols) / 2 - 0.5
        regions = [dist > radius * 0.75, dist < radius * 0.38]
    elif geometry == "diagonal":
        reach = np.sqrt((rows // 2) ** 2 + (cols // 2) ** 2)
        regions = [
            dist <= reach * 0.35,
            dist >= reach * 0.75,
            (dist >= reach * 0.55) & (dist < reach * 0.75),
        ]
    else:
        raise ValueError(f"unknown geometry {geometry!r}")
    return np.column_stack([np.ones_like(dist), *regions, dist]).astype(np.float64)


def region_sums(maps: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per map: sums of ``weights`` over defective cells, and the number of active cells."""
    sums = np.empty((len(maps), weights.shape[1]))
    active = np.empty(len(maps), dtype=np.int64)
    for start in range(0, len(maps), CHUNK):
        part = maps[start : start + CHUNK]
        sums[start : start + CHUNK] = (part == 2).astype(np.float64) @ weights
        active[start : start + CHUNK] = np.count_nonzero(part, axis=1)
    return sums, active


def gather_index(rows: int, cols: int, out_rows: int, out_cols: int) -> np.ndarray:
    """Flat source index per output cell for nearest-neighbour resizing."""
    r = np.minimum(np.arange(out_rows) * rows // out_rows, rows - 1)
    c = np.minimum(np.arange(out_cols) * cols // out_cols, cols - 1)
    return (r[:, None] * cols + c[None, :]).ravel()


def overlap_matrix(size: int, out_size: int) -> np.ndarray:
    """Share of each source cell in each output cell along one axis; rows sum to 1."""
    scale = size / out_size
    lo = np.arange(out_size)[:, None] * scale
    hi = lo + scale
    cell = np.arange(size)[None, :]
    return np.clip(np.minimum(hi, cell + 1) - np.maximum(lo, cell), 0, None) / scale


def map_structs(column: pa.StructArray):
    """Yield ``(positions, rows, cols, matrix)`` for each distinct map shape of a batch, in chunks.

    Maps that are missing or whose bytes do not fill their shape are left out.
    """
    rows, cols = (column.field(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rows", "cols"))
    size = pc.binary_length(column.field("cells").cast(pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
    fit = column.is_valid().to_numpy(zero_copy_only=False) & (rows > 0) & (cols > 0) & (size == rows * cols)
    shapes = rows * 1_000_000 + cols
    for shape in np.unique(shapes[fit]):
        every = np.flatnonzero(fit & (shapes == shape))
        r, c = int(shape // 1_000_000), int(shape % 1_000_000)
        for start in range(0, len(every), CHUNK):
            at = every[start:start + CHUNK]
            yield at, r, c, byte_rows(column.field("cells").take(pa.array(at)), r * c)


def symmetry_table(rows: int, cols: int) -> np.ndarray:
    """Source index per output cell for each (h-flip, v-flip, quarter turns): row h + 2v + 4k."""
    base = np.arange(rows * cols).reshape(rows, cols)
    table = []
    for k in range(4):
        for v in (False, True):
            for h in (False, True):
                grid = base[:, ::-1] if h else base
                grid = grid[::-1, :] if v else grid
                table.append(np.rot90(grid, k).ravel())
    return np.array(table)


def beta_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided Student-t tail: regularised incomplete beta by continued fraction."""
    from math import lgamma

    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    out = np.full(t.shape, np.nan)
    for i in np.ndindex(t.shape):
        if not (df[i] > 0) or np.isnan(t[i]):
            continue
        if np.isinf(t[i]):
            out[i] = 0.0
            continue
        x, a, b = df[i] / (df[i] + t[i] ** 2), df[i] / 2, 0.5
        if x >= 1:
            out[i] = 1.0
            continue
        front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x))
        if x < (a + 1) / (a + b + 2):
            out[i] = front * _beta_fraction(x, a, b) / a
        else:
            out[i] = 1 - front * _beta_fraction(1 - x, b, a) / b
    return out


def _beta_fraction(x: float, a: float, b: float) -> float:
    # Modified Lentz evaluation of the standard continued fraction.
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    f = d
    for m in range(1, 10_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + step * d or tiny)
            c = 1 + step / c or tiny
            f *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return f
