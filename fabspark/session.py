"""Session set-up and lineage cuts."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def get_spark(app_name: str = "fabspark", master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on, which joins small shuffle partitions.

    ``shuffle_partitions`` is the number that shuffles start from: about the bytes of the largest
    shuffle over 128 MB, as the default of 200 suits some 25 GB. ``conf`` entries use ``__`` for the dot, e.g. ``spark__sql__shuffle__partitions=8``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.session.timeZone", "UTC")
        # Partitioned writes keep one open file per class or split instead of sorting the maps.
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees: the cluster's checkpoint folder, or on one machine one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):  # local, local[n], local-cluster[...]: one machine
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="fabspark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and is computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A small frame from Python rows, held as a local relation: no Python task reads it."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [()] * len(kind.fields)
    arrow = to_arrow_schema(kind)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, kind)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after counting that it fits; otherwise leave the join to Spark.

    The rows are fetched once, so an aggregate is not computed again for the join.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, df.schema))


def settled(df: DataFrame, max_rows: int = 100_000) -> tuple[DataFrame, bool]:
    """``df`` computed once, and whether it is a local relation of at most ``max_rows``; else it is a checkpoint.

    For results that must not differ between two uses, as those of randomised sketches would.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return cut_lineage(df), False
    return df.sparkSession.createDataFrame(table, df.schema), True
