"""Bit-sliced top-k on odd vectors against sorted inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fabspark.llm import bitslices

VECTORS = "vec_id long, embedding array<double>, label int, block long, slot int, score long, rank int, width int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 1, 2, 3, 4, 5, 6) for i, v in rows], VECTORS).repartition(3)


def brute(rows, every, k):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows
            if v and all(x is not None and np.isfinite(x) and abs(x) * 64 < bitslices.LARGEST for x in v)]
    out = []
    for a, (q, x) in enumerate(good):
        if q is not None and q % every == 0:
            found = [(-sum(s * t for s, t in zip(x, y)), i is None, i or 0, i) for b, (i, y) in enumerate(good) if b != a and len(y) == len(x)]
            out += [(q, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=repr)


def got(df, every, k, **sizes):
    index = bitslices.build_index(df, block=sizes.get("block", bitslices.BLOCK))
    out = bitslices.search(index, bitslices.index_queries(index, every), k, sizes.get("group", bitslices.GROUP), sizes.get("cell", bitslices.BLOCK))
    assert [f.name for f in out.schema] == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=5) * rng.choice([0.001, 0.3, 40])).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(90)]  # a third of all: ties
    rows += [(20, rows[7][1]), (20, rows[20][1]), (None, rows[3][1]), (-40, rows[5][1]), (None, None)]
    rows += [(400, None), (420, []), (440, [float("nan")] * 5), (460, [float("inf"), 0, 0, 0, 0.0]), (480, [0.0, None, 0, 0, 0]),
             (500, [0.0] * 5), (520, [1.0, 2.0]), (521, [3.0, -1.0]), (540, [2.0] * 3), (560, [1e30] * 5), (580, [-0.001] * 5)]
    df = frame(spark, rows)
    want = brute(rows, 20, 20)
    assert got(df, 20, 20) == want
    for block, cell in ((37, 30), (8, 100), (8, 1000)):
        assert got(df, 20, 20, block=block, group=3, cell=cell) == want
    assert got(df, 20, 1000) == brute(rows, 20, 1000)
    assert not [r for r in want if r[0] == 540]  # alone of its length


def test_no_rows(spark):
    assert got(frame(spark, []), 20, 20) == [] and got(frame(spark, [(20, None), (1, [1.0])]), 20, 20) == []


def test_long_vectors_and_sums():
    rng = np.random.default_rng(5)
    values = rng.integers(-bitslices.LARGEST + 1, bitslices.LARGEST, (130, 300))
    low, digits, maps = bitslices.slice_rows(values)
    assert (bitslices.row_values(low, digits, maps, np.arange(130)) == values).all()
    for query in (values[3], -values[4], np.zeros(300, np.int64)):
        slices, base = bitslices.scores(low, digits, maps, query)
        total = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << p for p, s in enumerate(slices)) + base
        assert (total == values @ query).all()


@pytest.mark.parametrize("k", [1, 5, 63, 500])
def test_best(k):
    rng = np.random.default_rng(k)
    total = rng.integers(0, 12, 200)
    slices = [np.packbits(np.pad(total >> p & 1, (0, 56)).astype(bool), bitorder="little").view(np.uint64) for p in range(4)]
    among = np.packbits(np.pad(np.arange(200) % 3 != 0, (0, 56)), bitorder="little").view(np.uint64)
    rows = [r for r in np.lexsort([np.arange(200), -total]) if r % 3][:k]
    assert sorted(bitslices.best(slices, among, k).tolist()) == sorted(rows)
