"""Windowed defect rates over event streams, alarm levels and their result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, ts: str = "ts", glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream; the event time becomes a session-zone timestamp."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn(ts, F.col(ts).cast("timestamp"))


def windowed_rate(
    events: DataFrame, ts: str, flag: Column, size: str, slide: str | None = None, keys: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Readings, flagged readings and rate per window and key; works on batches and streams."""
    if watermark and events.isStreaming:
        events = events.withWatermark(ts, watermark)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.groupBy(window.alias("w"), *keys).agg(
        F.count("*").alias("n"), F.count_if(flag).alias("n_flagged"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "n_flagged",
        (F.col("n_flagged") / F.col("n")).alias("rate"),
    )


def alarm_level(rate: Column, levels: Sequence[float] = (0.1, 0.2, 0.3)) -> Column:
    """0 below the first threshold, then one level per threshold reached."""
    level = F.lit(0)
    for i, threshold in enumerate(levels, start=1):
        level = F.when(rate >= threshold, i).otherwise(level)
    return level


def start_updates(result: DataFrame, table: str, checkpoint: str, available_now: bool = True):
    """Write every changed result row to ``table``, one folder per micro-batch.

    A batch that runs again replaces its own folder. Nothing passes through the driver.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    writer = result.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_closed(result: DataFrame, table: str, checkpoint: str, available_now: bool = True):
    """Append every row to ``table`` once, when the watermark has closed its window."""
    writer = result.writeStream.outputMode("append").format("parquet").option("path", table).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Last written version of each result row."""
    rows = spark.read.parquet(table)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v")).select(*keys, "v.*")
