"""Token alignment against whole-text encoding by the plain libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from fabspark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, a_ids int, chunk int, k1 long, part int, block long, n long"


@pytest.fixture(scope="module")
def plain():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()

    def groups(text):
        if not text:
            return []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        x_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in x]
        y_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not b"".join(x_bytes) == b"".join(y_bytes) == (" " + text).encode():
            return []
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in (x_bytes, y_bytes)]
        out, i, j = [], 0, 0
        for common in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(common) + 1, ends[1].index(common) + 1
            out.append((x[i:k], y[j:m]))
            i, j = k, m
        return out

    return groups


def brute(rows, groups):
    found = [groups(t) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in found]
    count = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (doc_id, _), g, c in zip(rows, found, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(m for p, m in c.items() if count[p] == most[p[0]]), sum(m * count[p] for p, m in c.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(11)
    pool = ["the", "Étude", "naïve", "don't", "12,5", "日本語", " ", "", "<|endoftext|>", "<s>", "</s>", "<0x41>", "thntblere", "word.", "(x)",
            "\n", "\t", "é", "İ", "ß́", "🙂", " ", "___", "'s", "_", "　", "Ω"]
    out = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    out += ["".join(rng.choice(pool + [" ", "  "]) for _ in range(40)) for _ in range(60)]
    return out + [None, "", " ", "  ", "a", " a ", "▁a b", "x ▁ y", "a" * 3000, "é" * 999, "日本" * 700, "ab cd " * 900, "\x00 \x01 z", "a\u0085 b", "the " * 400 + "▁"]


def rows_of():
    some = texts()
    rows = list(enumerate(some)) + [(3, some[3]), (3, some[5]), (None, some[7]), (None, None)] + [(1000 + i, some[0]) for i in range(60)]
    return rows + [(2000 + i, "ab cd " * 900) for i in range(3)]


@pytest.mark.parametrize("chunk, span, fan, piece", [(1 << 16, 4096, 16, 1 << 20), (50, 20, 2, 300), (97, 1000, 3, 4000)])
def test_documents(spark, plain, monkeypatch, chunk, span, fan, piece):
    monkeypatch.setattr(alignment, "SPAN", span)
    monkeypatch.setattr(alignment, "FAN", fan)
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], DOCS).repartition(5)
    out = alignment.digest(df, A, B, chunk=chunk, piece=piece)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == brute(rows, plain)
    if fan == 2:
        monkeypatch.setattr(alignment, "KNOWN", 40)
        rows = [(i, t) for i, t in rows if t != "ab cd " * 900]
        aligned = alignment.align(df.filter("text IS NULL OR text != repeat('ab cd ', 900)"), A, B, chunk=chunk).collect()
        want = [(i, [(a, b) for a, b in plain(t)]) for i, t in rows]
        have = [(r["doc_id"], [(a.tolist(), b.tolist()) for a, b in zip(
            np.split(np.array(r["a_ids"], int), np.cumsum(r["a_sizes"])[:-1]), np.split(np.array(r["b_ids"], int), np.cumsum(r["b_sizes"])[:-1]))]
            if r["a_sizes"] else []) for r in aligned]
        assert sorted(have, key=repr) == sorted(want, key=repr)


def test_no_documents(spark):
    assert alignment.digest(spark.createDataFrame([], DOCS), A, B).count() == 0


def test_fragments_are_a_monoid(plain):
    pair = alignment.Pairing(A, B)
    text = next(t for t in texts() if t and plain(t) and len(t) > 100)
    data = np.frombuffer(b" " + text.encode(), np.uint8)
    whole = pair.fragment(data, 0, len(data))
    rng = random.Random(3)
    for _ in range(30):
        places = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(6))})
        parts = [pair.fragment(data, s, e) for s, e in zip(places, places[1:])]
        left = right = parts[0]
        for p in parts[1:]:
            left = alignment.compose([left, p])
        for p in parts[-2::-1]:
            right = alignment.compose([p, right if p is not parts[-2] else parts[-1]])
        for got in (left, alignment.compose(parts), *([right] if len(parts) > 1 else [])):
            assert all(np.array_equal(x, y) for x, y in zip(got, whole))
    prefix, closed, suffix = pair.fragment(data, 10, 60).parts()
    assert sum(len(a) for a, _ in [prefix, *closed, suffix]) == len(pair.fragment(data, 10, 60).a_ids)


def test_large_groups():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 300, 2, 17], np.int32), np.array([1, 200, 3, 16], np.int32)
    a, b = rng.integers(0, 40, sizes[0].sum()).astype(np.int32), rng.integers(0, 30, sizes[1].sum()).astype(np.int32)
    group, pairs, times = alignment.group_links(a, b, *sizes)
    got, want, i, j = Counter(), Counter(), 0, 0
    for g, p, n in zip(group.tolist(), pairs.tolist(), times.tolist()):
        got[g, p >> 32, p & 0xFFFFFFFF] += n
    for g, (x, y) in enumerate(zip(*sizes)):
        want.update((g, s, t) for s in a[i:i + x].tolist() for t in b[j:j + y].tolist())
        i, j = i + x, j + y
    assert got == want
