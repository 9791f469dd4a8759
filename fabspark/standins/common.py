"""Stand-in columns and limits for the domain's parameters on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LIMITS = {
    "l_quantity": (5.0, 45.0),
    "l_extendedprice": (10000.0, 90000.0),
    "l_discount": (0.01, 0.09),
    "l_tax": (0.0, 0.07),
}
PARAMS = list(LIMITS)
FLAGS = ["A", "N", "R"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# Small enough that the order operators cut even the small tables into several ranges.
ROWS_PER_BUCKET = 1_000


class Registry:
    """Query functions and SQL texts under one name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(fn):
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn
        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round doubles for comparison; adding 0.0 removes negative zeros."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in cols})


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return rounded(df, digits, *doubles)


def split_by_rule(event_id: Column) -> Column:
    k = event_id % 20
    return F.when(k < 14, "train").when(k < 17, "val").otherwise("test")


SPLIT_SQL = "CASE WHEN event_id % 20 < 14 THEN 'train' WHEN event_id % 20 < 17 THEN 'val' ELSE 'test' END"
