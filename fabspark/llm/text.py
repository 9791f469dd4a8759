"""Words, hashes and shingles of Arrow text columns, whole columns at a time.

A word is a run of bytes other than space and 0x09-0x0D; those six bytes never occur inside a
longer UTF-8 character, so the work is on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SEGMENT = 1 << 18
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))[LOWER]
_BYTES[SPACE] = 0
_POWERS = mix(np.arange(1, 65537, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


def column(values) -> pa.Array:
    """One null-free string array."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.fill_null("") if values.null_count else values


def pieces(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Row ranges of about ``limit`` bytes, with the first row's number; a longer text stands alone."""
    _, offsets = buffers(texts)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, texts.slice(start, end - start)
        start = end


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets, both without copying."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each run of bytes of one class other than 0, and the number of runs before each row."""
    kind = classes[data]
    inside = kind != 0
    edges = offsets[offsets < len(data)]
    first = inside.copy()
    first[1:] &= kind[1:] != kind[:-1]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= kind[1:] != kind[:-1]
    last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gaps: bool = False) -> np.ndarray:
    """64-bit hash of each word with A-Z in lower case; ``gaps`` if other bytes than blanks stand between words."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        upto = max(done + 1, int(np.searchsorted(ends, starts[done] + _SEGMENT, "right")))
        base, stop = int(starts[done]), int(ends[upto - 1])
        begin = starts[done:upto] - base
        place = np.arange(stop - base) - np.repeat(begin, np.diff(np.append(begin, stop - base)))
        weight = _POWERS[place & 0xFFFF]
        if stop - base > 0x10000:
            weight = weight + (place >> 16).astype(np.uint64) * _U(0xA24BAED4963EE406)
        value = _BYTES[data[base:stop]] * weight
        if gaps:
            value[place >= np.repeat(ends[done:upto] - starts[done:upto], np.diff(np.append(begin, stop - base)))] = 0
        out[done:upto] = np.add.reduceat(value, begin)
        done = upto
    return mix(out + (ends - starts).astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside a row, and the number of windows before each row.

    A row with fewer words has its whole sequence as one window; a row without words has none.
    """
    counts = np.diff(first)
    number = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    before = np.concatenate([[0], np.cumsum(number)])
    factor = mix(np.arange(11, 11 + width, dtype=np.uint64)) | _U(1)
    origin = np.arange(before[-1]) - np.repeat(before[:-1] - first[:-1], number)
    length = np.repeat(np.minimum(counts, width), number)
    total = length.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
    for k in range(width):
        inside = length > k
        if inside.all():
            total += hashes[origin + k] * factor[k]
        else:
            total[inside] += hashes[origin[inside] + k] * factor[k]
    return mix(total), before


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The distinct window hashes of each row, ascending, as unsigned 64-bit numbers."""
    for _, part in pieces(texts):
        data, offsets = buffers(part)
        starts, ends, first = spans(data, offsets)
        found, before = windows(word_hashes(data, starts, ends), first, width)
        for a, b in zip(before[:-1], before[1:]):
            yield np.unique(found[a:b])
