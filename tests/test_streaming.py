"""Streams over several files against the batch result; late rows; drift state."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fabspark.streaming import drift, rates

SCHEMA = "id long, ts timestamp, cls string, bad int"
T0 = dt.datetime(2024, 1, 1)


def events(n, seed=0, days=12):
    rng = np.random.default_rng(seed)
    minutes = np.sort(rng.integers(0, days * 1440, n))
    return [(i, T0 + dt.timedelta(minutes=int(m)), "ab"[int(rng.random() < 0.3)], int(rng.random() < (0.1 if m < 8 * 1440 else 0.6)))
            for i, m in enumerate(minutes)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("events")
    rows = events(900)
    for k in range(5):
        spark.createDataFrame(rows[k * 180:(k + 1) * 180], SCHEMA).coalesce(1).write.mode("append").parquet(str(root))
    return str(root)


def stream(spark, folder, per_batch=1):
    schema = spark.read.parquet(folder).schema
    return rates.read_stream(spark, folder, schema, files_per_batch=per_batch)


def test_updates_equal_batch(spark, folder, tmp_path):
    flag = F.col("bad") == 1
    live = rates.windowed_rate(stream(spark, folder), "ts", flag, "6 hours", "2 hours", ["cls"], "30 days")
    rates.start_updates(live, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    keys = ["window_start", "window_end", "cls"]
    got = rates.latest(spark, str(tmp_path / "t"), keys)
    want = rates.windowed_rate(spark.read.parquet(folder), "ts", flag, "6 hours", "2 hours", ["cls"])
    cols = [*keys, "n", "n_flagged", "rate"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    assert spark.read.parquet(str(tmp_path / "t")).select("batch_id").distinct().count() > 1


def test_late_rows_are_dropped_past_the_watermark(spark, tmp_path):
    src = tmp_path / "src"
    batches = [[(1, T0 + dt.timedelta(days=5), "a", 0)], [(2, T0 + dt.timedelta(days=6), "a", 0)],
               [(3, T0, "a", 1), (4, T0 + dt.timedelta(days=6, minutes=1), "a", 1)]]
    for i, rows in enumerate(batches):
        live = None
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(src))
        live = rates.windowed_rate(stream(spark, str(src)), "ts", F.col("bad") == 1, "1 day", watermark="1 day")
        rates.start_updates(live, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    out = {r["window_start"]: r["n"] for r in rates.latest(spark, str(tmp_path / "t"), ["window_start", "window_end"]).collect()}
    assert out == {T0 + dt.timedelta(days=5): 1, T0 + dt.timedelta(days=6): 2}


def test_alarm_levels(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.25,), (0.3,), (None,)], "r double")
    assert [r[0] for r in df.select(rates.alarm_level(F.col("r"))).collect()] == [0, 1, 2, 3, 0]


def test_batch_drift(spark):
    rows = [("Scratch", i, 0.1 if i < 5 else 0.4) for i in range(7)] + [("Loc", i, 0.2) for i in range(7)]
    df = spark.createDataFrame(rows, "cls string, window_start int, rate double")
    out = drift.with_suggestion(drift.rate_drift(df, "cls", 3, 3.0).filter("drift = 1"), "cls").collect()
    assert [(r["cls"], r["window_start"]) for r in out] == [("Scratch", 5)]
    assert "handler" in out[0]["suggestion"]


def run_drift(spark, tmp_path, name, parts, expiry=None):
    """The stream over each part in turn, from the same checkpoint; rows of its table."""
    src, seen = tmp_path / name, []
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(src))
        live = drift.drift_stream(stream(spark, str(src)), "ts", F.col("bad") == 1, "cls", "1 day", "1 hour", 3, 2.0, expiry)
        drift.start_drift(live, str(tmp_path / f"{name}-o"), str(tmp_path / f"{name}-c")).awaitTermination()
        seen.append(spark.read.parquet(str(tmp_path / f"{name}-o")).count())
    out = {(r["cls"], r["window_start"]): (r["n"], r["rate"], r["baseline"], r["ratio"], r["drift"])
           for r in spark.read.parquet(str(tmp_path / f"{name}-o")).collect()}
    assert len(out) == seen[-1]
    return out, seen


def test_stateful_drift_equals_batch_and_restarts(spark, folder, tmp_path):
    rows = events(900)
    whole, _ = run_drift(spark, tmp_path, "whole", [rows])
    restarted, seen = run_drift(spark, tmp_path, "again", [rows[:300], rows[300:310], rows[310:700], rows[700:]])
    assert whole == restarted and 0 < seen[0] < seen[-1]
    batch = drift.rate_drift(
        rates.windowed_rate(spark.read.parquet(folder), "ts", F.col("bad") == 1, "1 day", keys=["cls"]), "cls", 3, 2.0)
    want = {(r["cls"], r["window_start"]): r for r in batch.collect()}
    assert len(want) - 2 <= len(whole) < len(want)  # the last windows are still open
    for key, (n, rate, base, ratio, flag) in whole.items():
        assert (n, flag) == (want[key]["n"], want[key]["drift"]) and rate == pytest.approx(want[key]["rate"])
        assert base == (want[key]["baseline"] and pytest.approx(want[key]["baseline"])) and ratio == (want[key]["ratio"] and pytest.approx(want[key]["ratio"]))


def test_a_class_that_stays_away_starts_over(spark, tmp_path):
    rows = [(d * 10 + i, T0 + dt.timedelta(days=d, minutes=i), "a", int(i < 1 + d % 3)) for d in (0, 1, 2, 8, 9) for i in range(4)]
    rows += [(1000 + d, T0 + dt.timedelta(days=d), "b", 0) for d in range(12)]
    rows.sort(key=lambda r: r[1])
    whole, _ = run_drift(spark, tmp_path, "w", [rows], 3 * 86400)
    parts, _ = run_drift(spark, tmp_path, "p", [rows[:9], rows[9:14], rows[14:18], rows[18:]], 3 * 86400)
    assert whole == parts
    base = {k[1].day: v[2] for k, v in whole.items() if k[0] == "a"}
    assert base[1] is None and base[3] == pytest.approx(0.375) and base[9] is None and base[10] == pytest.approx(0.75)
