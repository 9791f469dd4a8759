"""Array files of die maps as a Python data source, read and written in byte ranges.

``spark.read.format("npy_maps").load(path)`` after :func:`register`. A file is either a ``.npy``
array whose first axis counts the maps, or, with ``option("size", bytes)``, headerless maps of one
length. The header gives record size and count, so partitions are planned as byte ranges without
reading maps, and each task seeks to its range and yields Arrow batches. Paths may be local or any
that pyarrow's file systems open, and must be visible to driver and executors alike.
"""

from __future__ import annotations

import ast
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

NAME = "npy_maps"
MAGIC = b"\x93NUMPY"
PART_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
SCHEMA = "wafer_id long, wafer_map_flat binary"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)


def files_of(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    """The file, or the files of the folder in name order without hidden ones."""
    system, place = opened(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.File:
        return system, [info]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(place))
    return system, sorted((f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.base_name)


@dataclass(frozen=True)
class Layout:
    """Where a file's maps begin, how many there are, and their value type and number of values."""

    start: int
    count: int
    kind: str
    values: int

    @property
    def record(self) -> int:
        return np.dtype(self.kind).itemsize * self.values


def layout(system: fs.FileSystem, info: fs.FileInfo, size: int | None) -> Layout:
    """Layout of a file from its first bytes and its length; fails if the two do not agree."""
    if size:
        if info.size % size:
            raise ValueError(f"{info.path}: {info.size} bytes are not whole maps of {size}")
        return Layout(0, info.size // size, "|u1", size)
    with system.open_input_file(info.path) as file:
        head = file.read(12)
        if head[:6] != MAGIC:
            raise ValueError(f"{info.path} has no array header; give the size of a map for headerless files")
        long = head[6] > 1  # version 1 has two bytes of length, later ones four
        length = int.from_bytes(head[8:12] if long else head[8:10], "little")
        start = (12 if long else 10) + length
        file.seek(start - length)
        header = ast.literal_eval(file.read(length).decode("utf-8" if head[6] > 2 else "latin-1"))
    shape, kind = header["shape"], header["descr"]
    if header["fortran_order"] and len(shape) > 1:
        raise ValueError(f"{info.path}: maps of a column-major array are not contiguous")
    if not isinstance(kind, str) or np.dtype(kind).kind not in "uibf" or not shape:
        raise ValueError(f"{info.path}: not an array of maps")
    out = Layout(start, int(shape[0]), kind, int(np.prod(shape[1:], dtype=np.int64)))
    if start + out.count * out.record != info.size:
        raise ValueError(f"{info.path}: header and length disagree")
    return out


class Range(InputPartition):
    """Maps ``first`` to ``first + count`` of a file; ``number`` is the id of the first."""

    def __init__(self, path: str, form: Layout, first: int, count: int, number: int) -> None:
        super().__init__((path, first))
        self.path, self.form, self.first, self.count, self.number = path, form, first, count, number


class NpyReader(DataSourceReader):
    def __init__(self, path: str, size: int | None, part_bytes: int) -> None:
        self.path, self.size, self.part_bytes = path, size, part_bytes

    def partitions(self) -> list[Range]:
        system, found = files_of(self.path)
        out, number = [], 0
        for info in found:
            form = layout(system, info, self.size)
            step = max(1, self.part_bytes // max(1, form.record))
            out += [Range(info.path, form, a, min(step, form.count - a), number + a) for a in range(0, form.count, step)]
            number += form.count
        return out or [Range("", Layout(0, 0, "|u1", 0), 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        form, system = partition.form, opened(self.path)[0]
        step = max(1, BATCH_BYTES // max(1, form.record))
        with system.open_input_file(partition.path) as file:
            file.seek(form.start + partition.first * form.record)
            for done in range(0, partition.count, step):
                n = min(step, partition.count - done)
                raw = file.read(n * form.record)
                if len(raw) < n * form.record:
                    raise EOFError(f"{partition.path} ends early")
                if np.dtype(form.kind).itemsize > 1:
                    raw = np.frombuffer(raw, form.kind).astype(np.uint8).tobytes()
                ends = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * form.values)
                maps = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(raw)])
                ids = pa.array(np.arange(n, dtype=np.int64) + partition.number + done)
                yield pa.RecordBatch.from_arrays([ids, maps], ["wafer_id", "wafer_map_flat"])


@dataclass
class Written(WriterCommitMessage):
    part: int
    path: str | None


class NpyWriter(DataSourceArrowWriter):
    """One array file per task, in the order of the tasks; files appear only when all tasks are done."""

    def __init__(self, path: str, side: int, header: bool, overwrite: bool) -> None:
        self.path, self.side, self.header, self.overwrite = path, side, header, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part, system, place = TaskContext.get().partitionId(), *opened(self.path)
        system.create_dir(place)
        temp, count = f"{place}/.{uuid.uuid4().hex}", 0
        with system.open_output_stream(f"{temp}.maps") as file:
            for batch in iterator:
                column = batch.column(batch.schema.get_field_index("wafer_map_flat"))
                if column.null_count or any(len(x) != self.side ** 2 for x in column.to_pylist()):
                    raise ValueError(f"a map is missing or has not {self.side} x {self.side} dies")
                file.write(b"".join(column.to_pylist()))
                count += len(column)
        if not self.header:
            return Written(part, f"{temp}.maps")
        if count:
            # The header holds the count, which is known only now, so the maps are copied behind it in pieces.
            header = f"{{'descr': '|u1', 'fortran_order': False, 'shape': ({count}, {self.side}, {self.side}), }}"
            header += " " * (-(len(header) + 11) % 64) + "\n"
            with system.open_output_stream(f"{temp}.npy") as out, system.open_input_stream(f"{temp}.maps") as maps:
                out.write(MAGIC + b"\x01\x00" + len(header).to_bytes(2, "little") + header.encode("latin-1"))
                while piece := maps.read(BATCH_BYTES):
                    out.write(piece)
        system.delete_file(f"{temp}.maps")
        return Written(part, f"{temp}.npy" if count else None)

    def commit(self, messages: list[Written | None]) -> None:
        system, place = opened(self.path)
        system.create_dir(place)
        first = 0
        for info in files_of(self.path)[1]:
            if self.overwrite:
                system.delete_file(info.path)
            else:
                first = max(first, int(info.base_name[5:15]) + 1)
        for m in messages:
            if m and m.path:
                system.move(m.path, f"{place}/part-{first + m.part:010d}{m.path[m.path.rindex('.'):]}")

    def abort(self, messages: list[Written | None]) -> None:
        system = opened(self.path)[0]
        for m in messages:
            if m and m.path:
                system.delete_file(m.path)


class NpyMaps(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> NpyReader:
        size = self.options.get("size")
        return NpyReader(self.options["path"], int(size) if size else None, int(self.options.get("partbytes", PART_BYTES)))

    def writer(self, schema, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options["path"], int(self.options.get("side", 64)), self.options.get("header", "true") == "true", overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NpyMaps)


def read_npy_maps(spark: SparkSession, path: str, size: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """``wafer_id`` (the position in the file, or over a folder's files in name order) and ``wafer_map_flat``."""
    register(spark)
    reader = spark.read.format(NAME).option("partBytes", part_bytes)
    return (reader.option("size", size) if size else reader).load(path)


def write_npy_maps(df: DataFrame, path: str, side: int = 64, mode: str = "overwrite", header: bool = True) -> None:
    """Write ``wafer_map_flat`` in the order of the partitions and rows of ``df``, one file per partition."""
    register(df.sparkSession)
    df.select("wafer_id", "wafer_map_flat").write.format(NAME).option("side", side).option("header", header).mode(mode).save(path)
