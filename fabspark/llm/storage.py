"""Tables that an operator writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fabspark.session import shared_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet and read again: later plans start from the files."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
