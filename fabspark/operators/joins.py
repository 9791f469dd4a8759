"""Joins that keep rows with missing keys together, as grouping does."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the key columns come from the left."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
    return left.join(other, condition, how).drop(*[f"_right_{k}" for k in keys])
