"""What a task of the text operators holds at once, on batches larger than a test table gives."""

import tracemalloc

import numpy as np
import pyarrow as pa

from fabspark.llm import jaccard
from fabspark.llm.text import shingle_sets


class Frame:
    """Takes the place of a data frame and keeps the functions given to its tasks."""

    def __init__(self):
        self.runs = []

    def select(self, *columns):
        return self

    def join(self, *other):
        return self

    def mapInArrow(self, run, schema):
        self.runs.append(run)
        return self


def peak_mb(fn):
    tracemalloc.start()
    try:
        out = fn()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def texts(seed, rows, length, names=1 << 30):
    rng = np.random.default_rng(seed)
    return pa.array([" ".join(map(str, rng.integers(0, names, length))) for _ in range(rows)])


def test_shingles_of_a_large_batch_are_made_a_piece_at_a_time():
    some = texts(1, 1200, 400)
    assert some.nbytes > 4e6
    most, n = peak_mb(lambda: sum(len(found) for found in shingle_sets(some, 5)))
    assert n == 1200 * 396 and most < 30


def test_suffix_filter_of_a_large_batch(spark):
    rng, frame, n = np.random.default_rng(2), Frame(), 4000
    slots = pa.array([rng.integers(0, 3, jaccard.SLOTS).astype(np.uint8).tobytes() for _ in range(n)], pa.binary())
    batch = pa.record_batch([pa.array(range(n)), pa.array(range(n)), slots, slots, pa.array([1000] * n, pa.int32()), pa.array([1000] * n, pa.int32())],
                            ["a", "b", "slots_a", "slots_b", "n_a", "n_b"])
    jaccard.verify(frame, frame, 5, 75)
    most, kept = peak_mb(lambda: [x for out in frame.runs[0](iter([batch])) for x in out["a"].to_pylist()])
    sums = [sum(x) for x in slots.to_pylist()]
    assert kept == [i for i, x in enumerate(sums) if x >= jaccard.overlap_needed(np.int64(1000), np.int64(1000), 75)]
    assert most < 15


def test_shingles_to_count_are_let_go_within_a_batch(monkeypatch):
    frame, rows = Frame(), 600
    monkeypatch.setattr(jaccard, "HELD", 50_000)
    alike = pa.array([t + end for t in texts(3, rows // 2, 1000).to_pylist() for end in (" x", " y")])
    batch = pa.record_batch([pa.array(range(rows)), pa.array(range(rows)), alike], ["doc_id", "row", "text"])
    jaccard.describe(frame, 5)
    most, out = peak_mb(lambda: list(frame.runs[0](iter([batch]))))
    assert [x for b in out for x in b["doc_id"].to_pylist() if x is not None] == list(range(rows))
    assert sum(x for b in out for x in b["n"].to_pylist() if x is not None) == 997 * rows
    counts = [x for b in out for x in b["count"].to_pylist() if x is not None]
    assert set(counts) == {2} and len(counts) > 0.9 * 996 * rows // 2  # a pair of texts may be cut apart
    assert most < 25


def test_repeated_values():
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 1), (2, 1), (2, 9), (50, 3), (1000, 700)):
        values = rng.integers(0, top, n).astype(np.uint64)
        each, count = np.unique(values, return_counts=True)
        found, often = jaccard._repeated(values.copy())
        assert found.tolist() == each[count > 1].tolist() and often.tolist() == count[count > 1].tolist()


def test_rows_that_a_join_needs_are_told_before_they_are_shuffled(spark):
    keys = [0, 1, -1, (1 << 24) - 1, 1 << 24, 7 * 32768, 32768 * 5 - 1, (1 << 63) - 1, -(1 << 63), 123456789123456789]
    some = spark.createDataFrame([(k, str(k)) for k in keys] + [(k, "other") for k in range(100, 4100)], "k long, v string")
    near = jaccard.among(some, spark.createDataFrame([(k,) for k in keys], "k long"), "k").collect()
    assert sorted(r["v"] for r in near if r["v"] != "other") == sorted(map(str, keys)) and len(near) == len(keys)
    one = jaccard.among(some, spark.createDataFrame([(-5,)], "k long"), "k")
    assert one.columns == ["k", "v"] and one.count() == 0 and jaccard.among(some, some.limit(0).select("k"), "k").count() == 0


def test_texts_of_a_join_are_shuffled_once_and_only_if_needed(spark, tmp_path, monkeypatch):
    plans, kept = [], jaccard.saved

    def saved(df, name, path=None):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return kept(df, name, path)

    monkeypatch.setattr(jaccard, "saved", saved)
    rng = np.random.default_rng(3)
    rows = [(i % 40, " ".join(map(str, rng.integers(0, 1 << 30, 60)))) for i in range(300)]
    rows += [(i, t + f" {i}") for i, t in rows[:60]] + rows[:20]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard.jaccard_rows(spark.read.parquet(str(tmp_path / "docs"))).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len({r["root"] for r in out}) == 300 and len(out) == 380
    plan = next(p for name, p in plans if name == "sets")
    moved = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert [x for x in moved if x[0] != "_"] == ["row", "row"]  # documents and keys; beside them only the bitmap


def test_only_texts_that_the_slots_leave_are_shuffled(spark, tmp_path, monkeypatch):
    read, plans, found, kept = jaccard.texts_of, [], [], jaccard.saved

    def texts_of(docs, rows, repeats):
        out = read(docs, rows, repeats)
        found.append((repeats, sorted(r["text"] for r in out.collect())))
        return out

    def saved(df, name, path=None):
        plans.append((name, df.columns))
        return kept(df, name, path)

    monkeypatch.setattr(jaccard, "texts_of", texts_of)
    monkeypatch.setattr(jaccard, "saved", saved)
    rng = np.random.default_rng(6)
    near, far = ([" ".join(map(str, rng.integers(0, 1 << 30, 60))) for _ in range(20)] for _ in range(2))
    near = [x for t in near for x in (t, t + " end")]
    # Half of each text is its neighbour's, so they share prefix shingles, but the slots bound the overlap.
    far = [x for t in far for x in (t, " ".join(t.split()[:30] + list(map(str, rng.integers(0, 1 << 30, 30)))))]
    rows = list(enumerate(near + far))
    for again in (0, 2):
        path, n = str(tmp_path / f"docs{again}"), len(plans)
        found.clear()
        spark.createDataFrame(rows * (1 + again), "doc_id long, text string").write.parquet(path)
        out = jaccard.jaccard_components(spark.read.parquet(path)).collect()
        assert len(out) == 80 * (1 + again)
        assert {r["doc_id"]: r["component_id"] for r in out} == {i: i - i % 2 if i < 40 else i for i, _ in rows}
        assert ("sets", ["row", "class", "n", "slots"]) in plans[n:]
        assert found and {r for r, _ in found} == {again > 0} and sorted(x for _, t in found for x in t) == sorted(near)


def test_prefixes_of_a_large_batch_are_sent_in_parts(spark):
    frame = Frame()
    frame.sparkSession = spark
    jaccard.prefixes(frame, np.zeros(0, np.uint64), 5, 75)
    sent = [b.num_rows for b in frame.runs[0](iter([pa.record_batch([texts(5, 800, 1000)], ["text"])]))]
    assert sum(sent) == 800 * jaccard.prefix_length(996, 75) and max(sent) < 101_000
