"""Spelling variants against edit distance of all pairs."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fabspark.llm import variants

DOCS = "doc_id long, text string, word string, n long, cell string, role int, form string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def count(rows, shortest=6, fewest=5):
    seen = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                seen[run] = seen.get(run, 0) + 1
    return {w: n for w, n in seen.items() if n >= fewest}


def brute(words, factor=5):
    form, out = {}, []
    for w, n in words.items():
        close = sorted((-m, v) for v, m in words.items() if near(w, v))
        form[w] = (close[0][1], -close[0][0]) if close and -close[0][0] >= factor * n else (None, None)
        out.append((w, n, len(close)))
    def root(w):
        return w if form[w][0] is None else root(form[w][0])
    return sorted((w, form[w][0], root(w), n, k, form[w][1]) for w, n, k in out)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(7)
    words = {}
    for _ in range(120):
        w = "".join(rng.choice(["an", "na", "ter", "re", "th", "él", "ß", "q"]) for _ in range(rng.randint(2, 5)))
        words[w] = rng.choice([5, 30, 200, 5000])
        for _ in range(4):
            i, c = rng.randrange(len(w) + 1), rng.choice("aenrtzé×ÿ")
            words[rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])] = rng.choice([5, 5, 30, 200])
    words = {w: n for w, n in words.items() if len(w) > 1}
    words |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 125}  # chain, tie
    long = "ab" * 400
    words |= {long: 9, long + "c": 50, long[:500] + "x" + long[501:]: 50, "b" + long[1:]: 8, "ba" * 400: 7}
    return words


@pytest.mark.parametrize("cell, visitors, piece", [(20_000, 100_000, 1 << 16), (7, 11, 50)])
def test_pairs(spark, vocabulary, monkeypatch, cell, visitors, piece):
    for name, value in (("CELL", cell), ("VISITORS", visitors), ("PIECE", piece)):
        monkeypatch.setattr(variants, name, value)
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long").withColumn("near_n", F.lit(1)).repartition(3)
    assert got(variants.variants(df)) == brute(vocabulary)


def test_texts(spark):
    rng = random.Random(2)
    pool = ["planet", "planets", "plänet", "Planet", "galaxy", "galaxi", "galaxies", "short", "PLANETÉ", "planeté"]
    rows = [(i % 50 if i % 9 else None, " ".join(rng.choice(pool) for _ in range(60)) + rng.choice(["", "1", "’s", "İstanbul"])) for i in range(80)]
    rows += [(3, None), (4, ""), (5, "galaxy " * 5000), (5, "galaxy " * 5000), (6, "x" * 20_000)] + [(7, "x" * 20_000)] * 4
    df = spark.createDataFrame([(*r, "w", 1, "c", 2, "f") for r in rows], DOCS).repartition(4)
    assert got(variants.variants(variants.count_words(df))) == brute(count(rows))


def test_no_words(spark):
    empty = spark.createDataFrame([], DOCS)
    assert got(variants.variants(variants.count_words(empty))) == []
    assert got(variants.variants(spark.createDataFrame([("lonely", 5)], "word string, n long"))) == [("lonely", None, "lonely", 5, 0, None)]
