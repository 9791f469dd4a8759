"""Document probability from a subword lattice.

The pieces of an existing vocabulary and their unigram scores weight every way to cut a word into
pieces; the log-space forward recursion sums them. Pieces never cross white space, so a text's
probability is the product of its words' and of the end mark's, and each distinct word needs one
recursion. The vocabulary file fixes the pieces; expectation maximisation over the words of the
training documents, counted for the whole corpus, fits their scores. A word of the training
documents is also an arc of its own, weighted like a piece by how often it is a token.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.storage import saved
from fabspark.llm.text import LOWER, SPACE, buffers, column, pieces

MARK = "▁"
ROUNDS = 2
HELD_OUT = (7, 2)
LOG10 = math.log(10)
CHUNK_BYTES = 16 << 20


class Lattice:
    """A trie of pieces as sorted arrays; works on many words of equal length at a time."""

    def __init__(self, names: list[str], byte_ids: dict[int, int], logp: np.ndarray) -> None:
        nodes: dict[tuple[int, int], int] = {}
        owner: dict[int, int] = {}
        for i, name in enumerate(names):
            at = 0
            for ch in name:
                at = nodes.setdefault((at, ord(ch)), len(nodes) + 1)
            if name:
                owner[at] = i
        keys = np.array([(a << 21) | c for a, c in nodes], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order]
        self.piece = np.full(len(nodes) + 1, -1)
        for at, i in owner.items():
            self.piece[at] = i
        self.bytes = np.array([byte_ids[b] for b in range(256)])
        self.logp = logp

    def spell(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct character: its number, the log-probability of its bytes, and the byte pieces."""
        unique, place = np.unique(chars, return_inverse=True)
        use = np.full((len(unique), 4), -1)
        for k, c in enumerate(unique.tolist()):
            raw = chr(c).encode("utf-8", "surrogatepass")
            use[k, :len(raw)] = self.bytes[list(raw)]
        cost = np.where(use >= 0, self.logp[use], 0.0).sum(axis=1)
        return place.reshape(chars.shape), cost, use

    def arcs(self, chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of all pieces in the rows, by start."""
        length = chars.shape[1]
        for start in range(length):
            rows, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
            for end in range(start + 1, length + 1):
                key = (node << 21) | chars[rows, end - 1]
                spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[spot] == key
                if not hit.any():
                    break
                rows, node = rows[hit], self.child[spot[hit]]
                piece = self.piece[node]
                own = piece >= 0
                if own.any():
                    yield start, end, rows[own], piece[own]

    def forward(self, chars: np.ndarray) -> np.ndarray:
        """Log sums over all segmentations of each prefix: rows x (length + 1)."""
        alpha = np.full((len(chars), chars.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0
        place, cost, _ = self.spell(chars)
        reached = 0
        for start, end, rows, piece in self.arcs(chars):
            while reached <= start:  # the spelled-out character is an arc too
                alpha[:, reached + 1] = np.logaddexp(alpha[:, reached + 1], alpha[:, reached] + cost[place[:, reached]])
                reached += 1
            alpha[rows, end] = np.logaddexp(alpha[rows, end], alpha[rows, start] + self.logp[piece])
        for k in range(reached, chars.shape[1]):
            alpha[:, k + 1] = np.logaddexp(alpha[:, k + 1], alpha[:, k] + cost[place[:, k]])
        return alpha

    def expected(self, chars: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in the rows, times ``weight``."""
        alpha, arcs = self.forward(chars), list(self.arcs(chars))
        place, cost, use = self.spell(chars)
        beta = np.full(alpha.shape, -np.inf)
        beta[:, -1] = 0
        counts, k = np.zeros(len(self.logp)), len(arcs)
        for start in range(chars.shape[1] - 1, -1, -1):
            through = beta[:, start + 1] + cost[place[:, start]]
            beta[:, start] = through
            while k and arcs[k - 1][0] == start:
                k -= 1
                _, end, rows, piece = arcs[k]
                beta[rows, start] = np.logaddexp(beta[rows, start], beta[rows, end] + self.logp[piece])
                share = np.exp(alpha[rows, start] + self.logp[piece] + beta[rows, end] - alpha[rows, -1])
                counts += np.bincount(piece, share * weight[rows], len(counts))
            share = np.exp(alpha[:, start] + through - alpha[:, -1]) * weight
            for column_ in use.T:
                ids = column_[place[:, start]]
                counts += np.bincount(ids[ids >= 0], share[ids >= 0], len(counts))
        return counts


def groups(words: list[str], cells: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and character matrix of words of one length, in blocks of bounded size; each word gets the mark in front."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[order], np.unique(lengths), "right")
    begin = 0
    for stop in edges.tolist():
        length = int(lengths[order[begin]])
        step = max(1, cells // length)
        for a in range(begin, stop, step):
            rows = order[a:min(stop, a + step)]
            joined = "".join([MARK + words[i] for i in rows.tolist()]).encode("utf-32-le", "surrogatepass")
            yield rows, np.frombuffer(joined, np.uint32).reshape(len(rows), length).astype(np.int64)
        begin = stop


def vocabulary(path: str) -> tuple[list[str], dict[int, int], np.ndarray]:
    """Pieces of a sentencepiece file, its byte pieces, and scores as log-probabilities to start from.

    Piece numbers are those of the file. A file of merges scores by rank; ranks become
    probabilities that fall with their inverse.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names, byte_ids = [], {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        names.append("" if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) else piece)
    rank = np.array([-model.get_score(i) for i in range(len(names))]).clip(0)
    start = 1 / (rank + 10)
    start[[i for i, n in enumerate(names) if not n]] = 1e-6
    return names, byte_ids, np.log(start / start.sum())


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of each text, A-Z in lower case, as one array, and the end of each text in it."""
    data, offsets = buffers(texts)
    plain = LOWER[data]
    plain[SPACE[data]] = 32
    wide = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(plain)])
    lists = pc.split_pattern(wide, " ")
    flat, ends = lists.flatten(), np.asarray(lists.offsets)
    full = np.asarray(pc.not_equal(flat, ""))
    return flat.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[ends]


def _held(names: pa.Array, rule: tuple[int, int]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if n is None else str(n).encode()) % rule[0] == rule[1] for n in names.to_pylist()], bool)


def count_words(docs: DataFrame, rule: tuple[int, int]) -> DataFrame:
    """(word, c, c_all) over all documents, and the number of training documents as word NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "c", "c_all"]
        for batch in batches:
            train = ~_held(batch.column("doc_id"), rule)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.string()), pa.array([int(train.sum())]), pa.array([len(train)])], names)
            for first, some in pieces(column(batch.column("text")), 8 << 20):
                words, ends = _words(some)
                coded = words.dictionary_encode()
                weight = np.repeat(train[first:first + len(some)], np.diff(ends))
                index, count = np.asarray(coded.indices), len(coded.dictionary)
                yield pa.RecordBatch.from_arrays([
                    coded.dictionary.cast(pa.string()), pa.array(np.bincount(index[weight], minlength=count)),
                    pa.array(np.bincount(index, minlength=count))], names)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, c long, c_all long").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def fit(words: DataFrame, names: list[str], byte_ids: dict[int, int], logp: np.ndarray, rounds: int) -> np.ndarray:
    """Piece scores after ``rounds`` of expectation maximisation over the training words.

    Only sums per piece reach the driver: their number is the vocabulary's size.
    """
    train = words.filter("word IS NOT NULL AND c > 0").select("word", "c")
    for _ in range(rounds):
        held = words.sparkSession.sparkContext.broadcast(Lattice(names, byte_ids, logp))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            lattice, counts = held.value, np.zeros(len(logp))
            for batch in batches:
                text, weight = batch.column("word").to_pylist(), np.asarray(batch.column("c"))
                for rows, chars in groups(text):
                    counts += lattice.expected(chars, weight[rows])
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], ["piece", "uses"])

        sums = train.mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()
        uses = np.full(len(logp), 1e-3)
        uses[np.asarray(sums["piece"])] += np.asarray(sums["uses"])
        logp = np.log(uses / uses.sum())
    return logp


DISCOUNT = 0.75  # of each training word's count, left to the pieces


def score(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS,
          rule: tuple[int, int] = HELD_OUT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: the contract's counts, ``base_score`` and ``score`` (log10).

    Rows of which the CRC of the id leaves ``rule[1]`` modulo ``rule[0]`` are held out. With N
    tokens and T distinct words in training, the lattice of a word sums its own arc,
    max(c - d, 0) / N, and d T / N times all cuts into pieces; the end mark has its share of N.
    Null texts are empty: one end mark. Equal rows score alike. Without training rows the pieces
    alone score, and the base is the logarithm of 1 / (N + 1 (V + 1)) with both zero. Other
    columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = saved(count_words(docs, rule), "words")
    sums = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("c"))), F.lit(0)),
        F.count(F.when(F.col("word").isNotNull() & (F.col("c") > 0), 1))).first()
    total, ends, types = (int(x) for x in sums)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    names, byte_ids, logp = vocabulary(model)
    context = docs.sparkSession.sparkContext
    lattice = context.broadcast(Lattice(names, byte_ids, fit(words, names, byte_ids, logp, rounds)))
    rest = DISCOUNT * types / total if total and types else 1.0
    scale = max(total, 1)
    floor = math.log10(1 / (total + types + (ends > 0) + 1))
    end_base = math.log10(ends + 1) + floor
    end_score = math.log10(ends / total) if ends else floor

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, c = batch.column("word").to_pylist(), np.asarray(batch.column("c"))
            cuts = np.zeros(len(text))
            for rows, chars in groups(text):
                cuts[rows] = lattice.value.forward(chars)[:, -1]
            own = np.maximum(c - DISCOUNT, 0) / scale
            with np.errstate(divide="ignore"):
                both = np.logaddexp(np.log(own), cuts + math.log(rest)) / LOG10
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(both)], ["word", "c", "logp"])

    scored = words.filter("word IS NOT NULL").select("word", "c").mapInArrow(arcs, "word string, c long, logp double")
    chunks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // chunk_bytes))
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"))
    dealt = dealt.repartition(chunks, "chunk")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = np.asarray(batch.column("chunk"))
            for k in np.unique(chunk).tolist():
                own = column(batch.column("text").filter(pa.array(chunk == k)))
                seen = pc.unique(pa.chunked_array([pc.unique(_words(some)[0]) for _, some in pieces(own)], pa.large_string()))
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(seen), pa.int32()), seen.cast(pa.string())], ["chunk", "word"])

    needed = dealt.mapInArrow(distinct, "chunk int, word string").join(scored, "word").select("chunk", "word", "c", "logp")

    def total_up(own: pa.Table, known: pa.Table) -> pa.Table:
        held = _held(own["doc_id"], rule)
        names_, c, logp_ = known["word"].combine_chunks().cast(pa.large_string()), np.asarray(known["c"]), np.asarray(known["logp"])
        out = [np.zeros(own.num_rows), np.zeros(own.num_rows), np.zeros(own.num_rows, np.int64), np.zeros(own.num_rows, np.int64)]
        for first, some in pieces(column(own["text"])):
            words_, ends_ = _words(some)
            coded = words_.dictionary_encode()
            spot = np.asarray(pc.index_in(coded.dictionary, value_set=names_))[np.asarray(coded.indices)] if len(words_) else np.zeros(0, np.int64)
            row, rows = np.repeat(np.arange(len(some)), np.diff(ends_)), slice(first, first + len(some))
            out[0][rows] = np.bincount(row, np.log10(c[spot] + 1.0) + floor, len(some)) + end_base
            out[1][rows] = np.bincount(row, logp_[spot], len(some)) + end_score
            out[2][rows] = np.diff(ends_) + 1
            out[3][rows] = np.bincount(row, c[spot] > 0, len(some)) + (ends > 0)
        return pa.table({
            "doc_id": own["doc_id"], "held_out": held, "n_tokens": out[2], "n_known": out[3],
            "train_tokens": np.full(own.num_rows, total), "base_score": out[0], "score": out[1]})

    return dealt.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(
        total_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
