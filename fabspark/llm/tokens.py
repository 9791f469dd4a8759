"""Token ids of all documents in plane-shuffled files, in ascending order of the document ids.

Texts are range-partitioned and sorted by id; each task encodes its range and writes segments of
whole documents. A file of the table is one range, a row of it one segment (``planes``), so a
segment can be read alone and no task holds more than one.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabspark.llm import planes
from fabspark.llm.text import SPACE, buffers, column, pieces

SEGMENT_IDS = 1 << 20
END_ID = 1
SEGMENTS = "part int, segment int, documents long, ids long, data binary"
DOCUMENTS = "doc_id long, part int, segment int, inside long, n_tokens long, ids_crc32 long"
CACHED_WORDS = 600_000
PIECE = 16 << 20


class Encoder:
    """Ids of texts for a tokenizer that drops white space, by way of each distinct word.

    The tokenizer's pattern never joins characters across ASCII white space, so a text's ids are
    those of its words in turn. A word's final run of ``.`` and ``,`` after a letter is a token run
    of its own, and A-Z are lower-cased first anyway; both make words repeat more often.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _parts(word: str) -> tuple[str, str]:
        if word.isascii() and "<" not in word:
            word = word.lower()
        body = word.rstrip(".,")
        return (body, word[len(body):]) if body and body[-1].isalpha() else (word, "")

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as 32-bit numbers."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known, split = self.known, [self._parts(w) for w in words]
        new = list({p for pair in split for p in pair if p and p not in known})
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for start in range(0, len(new), 10_000):
            some = new[start:start + 10_000]
            known.update((w, array("I", e.ids).tobytes()) for w, e in zip(some, encode(some, add_special_tokens=False)))
        known[""] = b""
        return [known[a] + known[b] for a, b in split]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of them per text."""
        data, offsets = buffers(texts)
        blank = data.copy()
        blank[SPACE[data]] = 32
        plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(blank)])
        lists = pc.split_pattern(plain, " ")
        ends = np.asarray(lists.offsets)
        coded = lists.flatten().dictionary_encode()
        found = self.words(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), np.uint32)
        place = np.concatenate([[0], np.cumsum(size)])
        pick = np.asarray(coded.indices)
        counts = size[pick]
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = pool[np.arange(before[-1]) - np.repeat(before[:-1] - place[pick], counts)]
        return ids, np.diff(before[ends])


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, with the words it has met in earlier tasks.

    This package travels inside the tasks; only an installed module lives as long as the worker.
    """
    import tokenizers

    kept = vars(tokenizers).setdefault("_fabspark_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def write(docs: DataFrame, path: str, tokenizer: str, text: str = "text", doc_id: str = "doc_id",
          end_id: int = END_ID, planes_per_block: int = 4, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all ``docs`` below ``path``, ``end_id`` after each document.

    A null text is empty and has the end id alone. Null ids come first; equal ids follow each
    other by a hash of their texts. A document longer than ``segment_ids`` is a segment of its own.
    """
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number, part = encoder(tokenizer).texts, 0, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids, lengths, names, valid = (np.concatenate(x) for x in zip(*held))
            data = planes.encode(ids, lengths, names, valid, planes_per_block)
            row = [[part], [number], [len(lengths)], [len(ids)], [data]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["part", "segment", "documents", "ids", "data"])

        for batch in batches:
            texts, names = column(batch.column("text")), batch.column("doc_id")
            for first, some in pieces(texts, PIECE):
                ids, counts = encode(some)
                after = np.cumsum(counts)
                ids = np.insert(ids, after, end_id)
                own = names.slice(first, len(some))
                part = batch.column("part")[first].as_py()
                lengths, valid = counts + 1, np.asarray(own.is_valid())
                values = np.asarray(own.fill_null(0))
                start = 0
                while start < len(lengths):  # cut at documents where the segment is full
                    room = segment_ids - sum(len(h[0]) for h in held)
                    stop = int(np.searchsorted(np.cumsum(lengths[start:]), room, "right")) + start
                    if stop == start and held:
                        yield flush()
                        number += 1
                        continue
                    stop = max(stop, start + 1)
                    a = int(lengths[:start].sum())
                    held.append((ids[a:a + int(lengths[start:stop].sum())], lengths[start:stop], values[start:stop], valid[start:stop]))
                    start = stop
        if held:
            yield flush()

    ordered.mapInArrow(segments, SEGMENTS).write.mode("overwrite").option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    table = spark.read.schema(SEGMENTS).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, data in zip(batch.column("part"), batch.column("segment"), batch.column("data")):
                raw = data.as_py()
                lengths, names, valid = planes.documents(raw)
                ids, ends = planes.decode(raw), np.cumsum(lengths)
                view = memoryview(np.ascontiguousarray(ids).view(np.uint8))
                checks = [zlib.crc32(view[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                count = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64(), mask=~valid), pa.array([part.as_py()] * count, pa.int32()),
                    pa.array([segment.as_py()] * count, pa.int32()), pa.array(ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(checks, pa.int64()),
                ], ["doc_id", "part", "segment", "inside", "n_tokens", "ids_crc32"])

    sums = table.select("part", "segment", "ids")
    parts = sums.groupBy("part").agg(F.sum("ids").alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", ahead.alias("_part"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = sums.withColumn("_segment", F.coalesce(F.sum("ids").over(inner), F.lit(0))).join(parts, "part")
    places = places.select("part", "segment", (F.col("_part") + F.col("_segment")).alias("_before"))
    found = table.select("part", "segment", "data").mapInArrow(documents, DOCUMENTS)
    return found.join(places, ["part", "segment"]).select(
        "doc_id", (F.col("_before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
