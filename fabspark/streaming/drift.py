"""Drift of windowed class rates against their own recent past."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fabspark.streaming.rates import start_closed

# What to inspect when the rate of a class rises.
SUGGESTIONS = {
    "Edge-Ring": "check furnace temperature profile",
    "Scratch": "inspect wafer handler for wear",
    "Edge-Loc": "check polishing pressure drift",
}


def rate_drift(
    rates: DataFrame, key: str, baseline_windows: int = 7, factor: float = 3.0, start: str = "window_start",
    rate: str = "rate",
) -> DataFrame:
    """Ratio of each window's rate to the mean of the windows before it, and the alarm flag.

    Input is one row per window and class, so a class holds as many rows as there are windows.
    """
    past = Window.partitionBy(key).orderBy(start).rowsBetween(-baseline_windows, -1)
    return rates.withColumn("baseline", F.avg(rate).over(past)).withColumns({
        "ratio": F.try_divide(rate, "baseline"),
        "drift": F.coalesce(F.col(rate) >= factor * F.col("baseline"), F.lit(False)).cast("int"),
    })


def with_suggestion(alarms: DataFrame, key: str) -> DataFrame:
    out = None
    for cls, text in SUGGESTIONS.items():
        hit = F.col(key) == cls
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return alarms.withColumn("suggestion", out)


class DriftProcessor(StatefulProcessor):
    """The last rates of a class as list state, its last window as value state, and a timer that forgets both.

    A class without windows for ``expiry_ms`` starts over. Whether it has is decided from the
    windows themselves, so results do not depend on how windows fall into batches; the timer only
    frees the state of classes that never come back.
    """

    def __init__(self, baseline_windows: int, factor: float, expiry_ms: int | None) -> None:
        self.keep, self.factor, self.expiry_ms = baseline_windows, factor, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rates = handle.getListState("rates", "rate double")
        self.last = handle.getValueState("last", "ends long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values("ends")
        past = [r[0] for r in self.rates.get()] if self.rates.exists() else []
        before = self.last.get()[0] if self.last.exists() else None
        base, ratio, drift = [], [], []
        for rate, starts, ends in zip(found["rate"].astype(float), found["starts"], found["ends"]):
            if before is not None and self.expiry_ms is not None and starts - before > self.expiry_ms:
                past = []
            mean = sum(past) / len(past) if past else None
            base.append(mean)
            ratio.append(rate / mean if mean else None)
            drift.append(int(mean is not None and rate >= self.factor * mean))
            past, before = (past + [rate])[-self.keep:], int(ends)
        self.rates.put([(r,) for r in past])
        self.last.update((before,))
        if self.expiry_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(before + self.expiry_ms + 1)
        yield pd.DataFrame({
            "_class": [key[0]] * len(found), "window_start": found["window_start"].to_numpy(), "n": found["n"].to_numpy(),
            "rate": found["rate"].to_numpy(), "baseline": pd.array(base, "Float64"), "ratio": pd.array(ratio, "Float64"), "drift": drift})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rates.clear()
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def drift_stream(
    events: DataFrame, ts: str, flag: Column, key: str, size: str, watermark: str, baseline_windows: int = 7, factor: float = 3.0,
    expiry_seconds: int | None = None,
) -> DataFrame:
    """Streaming form of ``rate_drift``: windowed rates and the drift state behind them in one query.

    A window counts once the watermark has closed it. State per class is the list of its last
    rates; windows arrive aggregated, so even a class with a third of all events sends one row per
    window to its task. A class without a window for ``expiry_seconds`` has no baseline when it
    comes back. Run it with :func:`start_drift`.
    """
    kind = events.schema[key].dataType.simpleString()
    closed = events.withWatermark(ts, watermark).groupBy(F.window(ts, size).alias("w"), key).agg(
        F.count("*").alias("n"), F.count_if(flag).alias("_flagged"))
    closed = closed.select(  # rows become keyword arguments in the worker, so the caller's name of the key is kept out
        F.col(key).alias("_class"), F.window_time("w").alias("at"), F.col("w.start").alias("window_start"), F.unix_millis("w.start").alias("starts"),
        F.unix_millis("w.end").alias("ends"), "n", (F.col("_flagged") / F.col("n")).alias("rate"))
    expiry = None if expiry_seconds is None else 1000 * expiry_seconds
    out = closed.groupBy("_class").transformWithStateInPandas(
        statefulProcessor=DriftProcessor(baseline_windows, factor, expiry),
        outputStructType=f"_class {kind}, window_start timestamp, n long, rate double, baseline double, ratio double, drift int",
        outputMode="Append", timeMode="EventTime")
    return out.withColumnRenamed("_class", key)


def start_drift(result: DataFrame, table: str, checkpoint: str, available_now: bool = True):
    """Append every row of ``drift_stream`` to ``table`` once. List state and timers need the embedded key-value state store."""
    conf, name = result.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return start_closed(result, table, checkpoint, available_now)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)
