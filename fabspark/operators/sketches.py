"""Mergeable quantile sketches: one per key and column, stored and merged like any other column.

A sketch of size ``k`` answers any quantile within a rank error that depends on ``k`` alone, so
daily tables can be merged to months without their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.operators.joins import null_safe_join
from fabspark.session import broadcast_if_small

SIZE = 8192
SMALLEST, LARGEST = 8, 65_535


def rank_error(k: int = SIZE) -> float:
    """Share of rows by which a quantile's rank is off at most, in 99 of 100 cases; four times this is beyond ten standard deviations."""
    return min(1.0, 2.296 / k ** 0.9723)


def number(df: DataFrame, col: str) -> Column:
    """The column as a double that a sketch can take; NaN, the largest value, counts as infinite."""
    value = F.col(col).cast("double")
    return F.when(F.isnan(value), float("inf")).otherwise(value) if df.schema[col].dataType.typeName() in ("double", "float") else value


def quantiles(sketch: Column, shares: Sequence[float]) -> Column:
    """Array of the values at ``shares``, each within [0, 1]; the sketch must not be empty."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in shares]))


def sketch_table(df: DataFrame, keys: Sequence[str], cols: Sequence[str], k: int = SIZE) -> DataFrame:
    """Keys, ``param``, ``n`` and ``sketch``; a column without values has no row. One scan, partial sketches per task."""
    wide = df.groupBy(*keys).agg(*[F.struct(
        F.lit(c).alias("param"), F.count(c).alias("n"), F.kll_sketch_agg_double(number(df, c), F.lit(k)).alias("sketch")).alias(f"_s{i}")
        for i, c in enumerate(cols)])
    long = wide.select(*keys, F.explode(F.array(*[f"_s{i}" for i in range(len(cols))])).alias("s"))
    return long.select(*keys, "s.*").filter("n > 0")


def merge_sketches(table: DataFrame, keys: Sequence[str], k: int = SIZE) -> DataFrame:
    """Sketches of coarser ``keys`` from a sketch table (or several, as their union), without the rows."""
    return table.groupBy(*keys, "param").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(table: DataFrame, probs: dict[str, float]) -> DataFrame:
    """The table with one column per wanted share in place of the sketch."""
    values = quantiles(F.col("sketch"), list(probs.values()))
    return table.withColumn("_q", values).drop("sketch").select(
        "*", *[F.get("_q", F.lit(j)).alias(name) for j, name in enumerate(probs)]).drop("_q")


def rank_of(df: DataFrame, keys: Sequence[str], col: str, values: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per key and name of a quantile: share of rows below its value and up to it, counted in one scan.

    ``values`` has one row per key.
    """
    by = list(keys) or ["_all"]
    one = [] if keys else [F.lit(0).alias("_all")]
    rows = df.select(*keys, *one, number(df, col).alias("_x")).filter("_x IS NOT NULL")
    rows = null_safe_join(rows, broadcast_if_small(values.select(*keys, *one, *names)), by)
    wide = rows.groupBy(*by).agg(*[F.struct(
        F.lit(n).alias("quantile"), (F.count_if(F.col("_x") < F.col(n)) / F.count("*")).alias("below"),
        (F.count_if(F.col("_x") <= F.col(n)) / F.count("*")).alias("upto")).alias(f"_r{i}") for i, n in enumerate(names)])
    return wide.select(*keys, F.explode(F.array(*[f"_r{i}" for i in range(len(names))])).alias("r")).select(*keys, "r.*")
