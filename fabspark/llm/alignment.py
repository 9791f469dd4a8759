"""Alignment of two tokenizers' tokens on the same texts.

Tokenizer A is a byte-level one (``tokenizers`` file), B a piece model (``sentencepiece`` file). A
group is the text between two byte offsets at which tokens of both end. What is known about a byte
range is a fragment: tokens before the first common end (open prefix), closed groups, and tokens
after the last one (open suffix). Fragments are composed end to start, which is associative, so a
very long text is cut into byte ranges that Spark deals to tasks, and a tree of groupings composes
them.

Neither tokenizer joins bytes across a single space between two other characters (A's pattern
splits there, B has no piece with an inner space), so tokens of a span between two such places
depend on the span alone: each distinct span is encoded and aligned once per task, and a byte range
is encoded with the rest of the spans at its ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.storage import saved
from fabspark.llm.text import buffers, column, pieces
from fabspark.session import cut_lineage

CHUNK = 1 << 16  # bytes of a text that one fragment covers
SPAN = 4096      # a chunk may end inside a span up to this length
FAN = 16
KNOWN = 400_000
PIECE = 1 << 20  # bytes of text in one block of documents
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
FRAGMENT = "k1 long, k2 long, chunk int, sound boolean, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, pairs array<long>, holders array<long>, links binary")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


# ---- fragments ----------------------------------------------------------------------------
class Fragment(NamedTuple):
    """Tokens that end in a byte range, and how many of A and of B there are up to each common end."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray

    def parts(self) -> tuple:
        """Open prefix, closed groups and open suffix, each as (A ids, B ids); all is prefix if nothing ends in common."""
        if not len(self.a_cuts):
            return (self.a_ids, self.b_ids), [], (self.a_ids[:0], self.b_ids[:0])
        groups = list(zip(np.split(self.a_ids, self.a_cuts), np.split(self.b_ids, self.b_cuts)))
        return groups[0], groups[1:-1], groups[-1]


def compose(fragments: list[Fragment]) -> Fragment:
    """Fragments of neighbouring byte ranges as one: each open suffix closes with the next open prefix."""
    a = np.cumsum([0] + [len(f.a_ids) for f in fragments[:-1]])
    b = np.cumsum([0] + [len(f.b_ids) for f in fragments[:-1]])
    return Fragment(*(np.concatenate(x) for x in (
        [f.a_ids for f in fragments], [f.b_ids for f in fragments],
        [f.a_cuts + s for f, s in zip(fragments, a)], [f.b_cuts + s for f, s in zip(fragments, b)])))


# ---- encoding -----------------------------------------------------------------------------
def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def safe_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of spans: every row's start, and each single space between characters known not to be blank."""
    plain = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF)  # two-byte characters that are letters or marks
    ends = plain.copy()
    ends[1:] |= lead[:-1]
    cut = data == 0x20
    cut[1:] &= ends[:-1]
    cut[:-1] &= (plain | lead)[1:]
    cut[-1:] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class Pairing:
    """Ids and groups of texts, by way of each distinct span."""

    def __init__(self, a_path: str, b_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        alphabet, size = byte_alphabet(), self.a.get_vocab_size(True)
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.names = {
            "a_ids": [bytes(alphabet.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(size)],
            "b_ids": [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces_b)]}
        self.width = {k: np.array([len(x) for x in v], np.int64) for k, v in self.names.items()}
        if any(" " in p.decode(errors="replace").lstrip(" ") for p in self.names["b_ids"]):
            raise ValueError("a piece of B spans a space inside a text: spans cannot be encoded alone")
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        none = np.zeros(0, np.int32)
        # Per span: ids and group sizes in pools, and where each span's part ends.
        self.pools = {"a_ids": none, "b_ids": none, "a_sizes": none, "b_sizes": none}
        self.ends = {k: np.zeros(1, np.int64) for k in ("a_ids", "b_ids", "sizes")}
        self.sound = np.zeros(0, bool)

    def learn(self, spans: list[bytes]) -> None:
        """Encode and align spans that were not met before."""
        texts = [s.decode(errors="replace") for s in spans]
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        found = {"a_ids": [e.ids for e in encode(texts, add_special_tokens=False)], "b_ids": self.b.encode([t[1:] for t in texts], num_threads=1)}
        size = np.fromiter(map(len, spans), np.int64, len(spans))
        row, good = np.repeat(np.arange(len(spans)), size), np.ones(len(spans), bool)
        raw = np.frombuffer(b"".join(spans), np.uint8)
        flat, ends, counts = {}, {}, {}
        for name, side in found.items():
            counts[name] = np.fromiter(map(len, side), np.int64, len(side))
            flat[name] = np.fromiter(chain.from_iterable(side), np.int32, int(counts[name].sum()))
            width = np.bincount(np.repeat(np.arange(len(spans)), counts[name]), self.width[name][flat[name]], len(spans))
            same = width == size
            ids = flat[name][np.repeat(same, counts[name])]
            own = np.frombuffer(b"".join(map(self.names[name].__getitem__, ids.tolist())), np.uint8)
            theirs = np.repeat(same, size)
            same[row[theirs][own != raw[theirs]]] = False
            good &= same
        first = len(self.known)
        self.known.update(zip(spans, range(first, first + len(spans))))
        self.sound = np.concatenate([self.sound, good])
        for name in found:
            flat[name] = flat[name][np.repeat(good, counts[name])]
            ends[name] = np.cumsum(self.width[name][flat[name]])
            self.ends[name] = np.concatenate([self.ends[name], self.ends[name][-1] + np.cumsum(counts[name] * good)])
        both = np.intersect1d(ends["a_ids"], ends["b_ids"], assume_unique=True)
        for name in ("a_ids", "b_ids"):
            flat[name.replace("ids", "sizes")] = np.diff(np.searchsorted(ends[name], both, "right"), prepend=0).astype(np.int32)
        reach = np.cumsum(size * good)
        self.ends["sizes"] = np.concatenate([self.ends["sizes"], self.ends["sizes"][-1] + np.searchsorted(both, reach, "right")])
        self.pools = {k: np.concatenate([v, flat[k]]) for k, v in self.pools.items()}

    def align(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]]:
        """For rows of bytes that start with a space: soundness, flat arrays, and where each row's part of them ends.

        Rows in which either tokenizer's bytes differ from the row's have no tokens.
        """
        starts = safe_places(data, offsets)
        edges = np.append(starts, len(data)).astype(np.int64)
        spans = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = spans.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) + len(names) > KNOWN:
            self.forget()
        new = [n for n in names if n not in self.known]
        for k in range(0, len(new), 20_000):
            self.learn(new[k:k + 20_000])
        pick = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[np.asarray(coded.indices)]
        before = np.searchsorted(starts, offsets)
        bad = np.concatenate([[0], np.cumsum(~self.sound[pick])])
        sound = bad[before[1:]] == bad[before[:-1]]
        pick = pick[np.repeat(sound, np.diff(before))]
        kept = np.concatenate([[0], np.cumsum(np.diff(before) * sound)])
        flat, ends = {}, {}
        for name, pools in (("a_ids", ["a_ids"]), ("b_ids", ["b_ids"]), ("sizes", ["a_sizes", "b_sizes"])):
            low, count = self.ends[name][pick], self.ends[name][pick + 1] - self.ends[name][pick]
            after = np.concatenate([[0], np.cumsum(count)])
            place = np.arange(after[-1]) - np.repeat(after[:-1] - low, count)
            for pool in pools:
                flat[pool] = self.pools[pool][place]
            ends[name] = after[kept]
        return sound, flat, ends

    def fragment(self, data: np.ndarray, skip: int, keep: int) -> Fragment | None:
        """The fragment of bytes ``skip`` to ``keep`` of a run of whole spans; None if bytes differ."""
        sound, flat, _ = self.align(data, np.array([0, len(data)]))
        if not sound[0]:
            return None
        ends = [np.cumsum(self.width[k][flat[k]]) for k in ("a_ids", "b_ids")]
        low, high = zip(*(np.searchsorted(e, [skip, keep], "right") for e in ends))
        cuts = [np.cumsum(flat[k]) for k in ("a_sizes", "b_sizes")]
        inside = (ends[0][cuts[0] - 1] > skip) & (ends[0][cuts[0] - 1] <= keep)
        return Fragment(flat["a_ids"][low[0]:high[0]], flat["b_ids"][low[1]:high[1]],
                        (cuts[0][inside] - low[0]).astype(np.int32), (cuts[1][inside] - low[1]).astype(np.int32))


def pairing(a_path: str, b_path: str) -> Pairing:
    """The worker's pairing of two files, kept on an installed module since this package travels inside the tasks."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_fabspark_pairings", {})
    if (a_path, b_path) not in kept:
        kept[a_path, b_path] = Pairing(a_path, b_path)
    return kept[a_path, b_path]


def lists(flat: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


# ---- Spark: from texts to groups ----------------------------------------------------------
def long_fragments(texts: DataFrame, a_path: str, b_path: str, chunk: int) -> DataFrame:
    """One fragment per row of ``texts`` (k1, k2, text), composed of its chunks' fragments in a tree."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, raw in zip(batch.column("k1"), batch.column("k2"), batch.column("text")):
                data = np.frombuffer(b" " + raw.cast(pa.large_binary()).as_py(), np.uint8)
                starts = safe_places(data, np.array([0, len(data)]))
                edges = np.append(starts, len(data))
                places = [0]
                while places[-1] < len(data):
                    at = min(places[-1] + chunk, len(data))
                    span = int(np.searchsorted(edges, at, "right"))
                    if at < len(data) and edges[span] - edges[span - 1] > SPAN:
                        at = int(edges[span])
                    while at < len(data) and data[at] & 0xC0 == 0x80:  # inside a character
                        at += 1
                    places.append(at)
                for i, (s, e) in enumerate(zip(places, places[1:])):
                    first = int(edges[np.searchsorted(edges, s, "right") - 1])
                    last = int(edges[np.searchsorted(edges, e, "left")])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k1.as_py()]), pa.array([k2.as_py()]), pa.array([i], pa.int32()), pa.array([s - first], pa.int32()),
                         pa.array([e - first], pa.int32()), pa.array([data[first:last].tobytes()], pa.binary())],
                        ["k1", "k2", "chunk", "skip", "keep", "bytes"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pairing(a_path, b_path)
            for r in batch.to_pylist():
                f = pair.fragment(np.frombuffer(r["bytes"], np.uint8), r["skip"], r["keep"])
                yield from fragment_rows([(r["k1"], r["k2"], r["chunk"], f is not None, f)]).to_batches()

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.sort_by("chunk")
        parts = [Fragment(*(np.array(rows[c][i].values, np.int32) for c in Fragment._fields)) for i in range(rows.num_rows)]
        sound = all(rows["sound"].to_pylist())
        return fragment_rows([(key[0].as_py(), key[1].as_py(), key[2].as_py(), sound, compose(parts) if sound else None)])

    chunks = texts.mapInArrow(cut, "k1 long, k2 long, chunk int, skip int, keep int, bytes binary")
    # A key of its own per chunk deals the chunks of one text to many tasks.
    found = cut_lineage(chunks.repartition("k1", "k2", "chunk").mapInArrow(encode, FRAGMENT))
    last = found.agg(F.max("chunk")).first()[0]
    while last:
        parents = found.groupBy("k1", "k2", F.floor(F.col("chunk") / FAN).cast("int").alias("parent"))
        found = cut_lineage(parents.applyInArrow(merge, FRAGMENT))
        last //= FAN
    return found


def fragment_rows(rows: list[tuple]) -> pa.Table:
    none = Fragment(*[np.zeros(0, np.int32)] * 4)
    k1, k2, chunk, sound, parts = zip(*rows)
    arrays = [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(chunk, pa.int32()), pa.array(sound, pa.bool_())]
    for name in Fragment._fields:
        arrays.append(pa.array([getattr(f or none, name) for f in parts], pa.list_(pa.int32())))
    return pa.Table.from_arrays(arrays, ["k1", "k2", "chunk", "sound", *Fragment._fields])


class Groups(NamedTuple):
    """Some documents' ids and group sizes in flat arrays, with where each document's part ends."""

    doc_id: pa.Array
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    ends: np.ndarray

    def rows(self, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [self.doc_id, lists(self.a_ids, self.a_ends), lists(self.b_ids, self.b_ends), lists(self.a_sizes, self.ends), lists(self.b_sizes, self.ends)],
            ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])


def documents(docs: DataFrame, a_path: str, b_path: str, text: str, doc_id: str, chunk: int, piece: int, finish: Callable, schema: str) -> DataFrame:
    """``finish(groups, number)`` for pieces of the documents; ``number`` is one of its own for each piece."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.filter(F.octet_length("text") <= chunk).withColumn("part", F.spark_partition_id())
    long = rows.filter(F.octet_length("text") > chunk).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            texts, names, pair = column(batch.column("text")), batch.column("doc_id"), pairing(a_path, b_path)
            for first, some in pieces(texts, piece):
                data, offsets = buffers(some)
                data = np.insert(data, offsets[:-1][np.flatnonzero(np.diff(offsets))], 0x20)
                offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
                _, flat, ends = pair.align(data, offsets)
                yield finish(Groups(names.slice(first, len(some)), *flat.values(), *ends.values()), (batch.column("part")[0].as_py() << 32) + number)
                number += 1

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 1 << 31  # apart from those of short documents
        for batch in batches:
            for i in range(batch.num_rows):
                flat = [np.array(batch.column(k)[i].values, np.int32) for k in ("a_ids", "b_ids")]
                cuts = [np.diff(np.array(batch.column(k)[i].values, np.int32), prepend=np.int32(0)) for k in ("a_cuts", "b_cuts")]
                ends = [np.array([0, len(x)]) for x in (*flat, cuts[0])]
                yield finish(Groups(batch.column("doc_id").slice(i, 1), *flat, *cuts, *ends), (batch.column("part")[0].as_py() << 32) + number)
                number += 1

    found = long_fragments(long.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]), a_path, b_path, chunk)
    joined = long.select("doc_id", "k1", "k2").join(found, ["k1", "k2"]).select(
        "doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts", F.spark_partition_id().alias("part"))
    return short.mapInArrow(whole, schema).unionByName(joined.mapInArrow(composed, schema))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ids of A and B in order, and tokens of each per group.

    Both encode a space and the text. Null and empty texts, and those whose tokens' bytes are not
    these, have empty arrays. Equal rows stay apart; a text beyond ``chunk`` bytes is encoded once
    for all rows that hold it. Other columns are ignored.
    """
    return documents(docs, a_path, b_path, text, doc_id, chunk, PIECE, Groups.rows, ALIGNED)


# ---- Spark: pairs and digests -------------------------------------------------------------
def group_links(a_ids: np.ndarray, b_ids: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair ``a << 32 | b`` and number of links for all pairs of ids that share a group.

    A large group gives each pair of ids once, however often they meet.
    """
    a_from, b_from = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    links = a_sizes.astype(np.int64) * b_sizes
    small = np.flatnonzero(links <= 256)
    n = links[small]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    group = np.repeat(small, n)
    width = b_sizes[group]
    pairs = [a_ids[a_from[group] + inner // width].astype(np.int64) << 32 | b_ids[b_from[group] + inner % width]]
    groups, times = [group], [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(links > 256):
        x, nx = np.unique(a_ids[a_from[g]:a_from[g] + a_sizes[g]], return_counts=True)
        y, ny = np.unique(b_ids[b_from[g]:b_from[g] + b_sizes[g]], return_counts=True)
        pairs.append((x.astype(np.int64)[:, None] << 32 | y).ravel())
        times.append((nx[:, None] * ny).ravel())
        groups.append(np.full(len(x) * len(y), g))
    return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All groups as ``a1,a2|b1;`` in a row of bytes, and where each group ends."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    ids = np.empty(len(a_ids) + len(b_ids), np.int32)
    mark = np.full(len(ids), ord(","), np.uint8)
    a_place = np.arange(len(a_ids)) + np.repeat(b_ends - b_sizes, a_sizes)
    b_place = np.arange(len(b_ids)) + np.repeat(a_ends, b_sizes)
    ids[a_place], ids[b_place] = a_ids, b_ids
    mark[a_place[a_ends - 1]], mark[b_place[b_ends - 1]] = ord("|"), ord(";")
    digits = len(str(int(ids.max(initial=0))))
    cells = np.empty((len(ids), digits + 1), np.uint8)
    shown = np.ones((len(ids), digits + 1), bool)
    for d in range(digits):
        power = np.int32(10 ** (digits - 1 - d))
        cells[:, d] = ids // power % 10 + 48
        if d < digits - 1:
            shown[:, d] = ids >= power
    cells[:, digits] = mark
    ends = np.cumsum(shown.sum(axis=1))
    return cells[shown], ends[b_place[b_ends - 1]]


def block(groups: Groups, number: int) -> pa.RecordBatch:
    """A block of documents with their digests, its distinct pairs, and how many of its documents link each."""
    rows = len(groups.doc_id)
    a_ids, b_ids, a_sizes, b_sizes = groups[1:5]
    group, pairs, times = group_links(a_ids, b_ids, a_sizes, b_sizes)
    row = np.repeat(np.arange(rows), np.diff(groups.ends))[group]
    del group
    links = np.bincount(row, times, rows).astype(np.int64)
    coded = pa.array(pairs).dictionary_encode()
    del pairs
    names = np.asarray(coded.dictionary)
    width = max(1, len(names))
    held, where = np.unique(row * width + np.asarray(coded.indices), return_inverse=True)
    del row, coded
    often = np.bincount(where, times, len(held)).astype(np.int64)
    del where, times
    row, place = held // width, held % width
    raw, ends = group_texts(a_ids, b_ids, a_sizes, b_sizes)
    ends = np.concatenate([[0], ends])[groups.ends]
    view = memoryview(np.ascontiguousarray(raw))
    digests = [hashlib.sha256(view[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
    packed = b"".join(x.astype(t).tobytes() for x, t in ((np.bincount(row, minlength=rows), np.int64), (place, np.int32), (often, np.int64)))
    long = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([groups.doc_id], long), *(pa.array([np.diff(e)], long) for e in (groups.a_ends, groups.b_ends, groups.ends)),
        pa.array([links], long), pa.array([digests], pa.list_(pa.string())), pa.array([names], long),
        pa.array([np.bincount(place, minlength=len(names))], long), pa.array([zstandard.ZstdCompressor(level=1).compress(packed)], pa.binary()),
    ], [f.split()[0] for f in BLOCKS.split(", ")])


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair`` (A id << 32 | B id), ``n``: how many documents of all blocks link it, and ``best``: no B id does more often."""
    counts = found.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("n"))
    counts = saved(counts, "pair-counts").withColumn("a", F.shiftright("pair", 32).cast("int"))
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))  # at most one row per entry of A's vocabulary
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def digest(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", chunk: int = CHUNK, piece: int = PIECE) -> DataFrame:
    """Per row of ``docs``, aligned as by :func:`align`: token, group and link counts, links that are their A id's best, the sum of all links' counts, and a hash of the groups."""
    found = saved(documents(docs, a_path, b_path, text, doc_id, chunk, piece, block, BLOCKS), "aligned-blocks")
    wanted = found.select(F.col("block").alias("home"), F.posexplode("pairs").alias("place", "pair"))
    known = wanted.join(pair_counts(found), "pair").select("home", "place", "n", "best")

    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        columns = {c: block[c].combine_chunks().flatten() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        rows = len(columns["doc_id"])
        raw = zstandard.ZstdDecompressor().decompress(block["links"][0].as_py())
        held = np.frombuffer(raw, np.int64, rows)
        total = int(held.sum())
        place, often = np.frombuffer(raw, np.int32, total, 8 * rows), np.frombuffer(raw, np.int64, total, 8 * rows + 4 * total)
        n, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        at = np.asarray(counts["place"].combine_chunks())
        n[at], best[at] = np.asarray(counts["n"].combine_chunks()), np.array(counts["best"].combine_chunks()).astype(np.int64)
        row = np.repeat(np.arange(rows), held)
        sums = []
        for value in (best, n):
            out = np.zeros(rows, np.int64)
            np.add.at(out, row, often * value[place])
            sums.append(out)
        return pa.table({**{c: columns[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}, "n_best": sums[0], "count_sum": sums[1],
                         "groups_sha256": columns["groups_sha256"]})

    return found.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(run, RESULT)
