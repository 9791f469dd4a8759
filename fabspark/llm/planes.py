"""Bytes of one segment of token ids: plane-shuffled, compressed blocks behind a chunk index.

Layout, little-endian: the header, the chunk index, the compressed document index, the planes.
A block of fixed size is transposed into byte planes (all first bytes, all second bytes, ...) or
bit planes, and each plane is one zstandard frame. The index has each block's place, checksum
and plane lengths, so a reader decodes only the blocks that it wants.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import zstandard

MAGIC = b"IDPLANE1"
HEADER = "<8sQQIIQ"  # magic, ids, documents, ids per block, planes, bytes of the document index
BLOCK = 1 << 16
LEVEL = 3


def _split(block: np.ndarray, planes: int) -> list[bytes]:
    raw = block.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def _join(parts: list[bytes], count: int) -> np.ndarray:
    if len(parts) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in parts], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


def encode(ids: np.ndarray, lengths: np.ndarray, names: np.ndarray, valid: np.ndarray, planes: int = 4,
           block: int = BLOCK) -> bytes:
    """One segment: all ids, and per document its number of ids and its 64-bit name, if it has one."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    documents = squeeze.compress(
        np.diff(names.astype("<i8"), prepend=0).astype("<i8").tobytes()
        + lengths.astype("<i8").tobytes() + valid.astype(np.uint8).tobytes())
    index, body, at = [], [], 0
    for start in range(0, len(ids), block):
        part = ids[start:start + block]
        frames = [squeeze.compress(p) for p in _split(part, planes)]
        index.append(struct.pack(f"<QI{planes}I", at, zlib.crc32(part.astype("<u4").tobytes()), *map(len, frames)))
        body += frames
        at += sum(map(len, frames))
    head = struct.pack(HEADER, MAGIC, len(ids), len(lengths), block, planes, len(documents))
    return b"".join([head, *index, documents, *body])


def documents(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, names and name validity of the documents of a segment."""
    _, total, count, block, planes, size = struct.unpack_from(HEADER, data)
    begin = struct.calcsize(HEADER) + -(-total // block) * struct.calcsize(f"<QI{planes}I")
    raw = zstandard.ZstdDecompressor().decompress(data[begin:begin + size])
    wide = np.frombuffer(raw[:16 * count], "<i8")
    return wide[count:], np.cumsum(wide[:count]), np.frombuffer(raw[16 * count:], np.uint8).astype(bool)


def decode(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop``; only the blocks that hold them are read."""
    magic, total, _, block, planes, size = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    stop = total if stop is None else min(stop, total)
    entry = f"<QI{planes}I"
    wide, begin = struct.calcsize(entry), struct.calcsize(HEADER)
    body = begin + -(-total // block) * wide + size
    expand, out = zstandard.ZstdDecompressor(), []
    for k in range(start // block, -(-stop // block) if stop > start else 0):
        at, check, *lengths = struct.unpack_from(entry, data, begin + k * wide)
        parts, at = [], body + at
        for length in lengths:
            parts.append(expand.decompress(data[at:at + length]))
            at += length
        ids = _join(parts, min(block, total - k * block))
        if zlib.crc32(ids.tobytes()) != check:
            raise ValueError(f"block {k} is damaged")
        out.append(ids[max(0, start - k * block):stop - k * block])
    return np.concatenate(out) if out else np.zeros(0, "<u4")
