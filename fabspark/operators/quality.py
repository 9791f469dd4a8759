"""Data-quality expectations, evaluated together in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named row condition; rows where it is not true violate the rule."""

    name: str
    condition: Column | None
    column: str = ""


def exists(column: str) -> Rule:
    return Rule(f"{column}_exists", None, column)


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.col(column).isNotNull(), column)


def between(column: str, lo, hi) -> Rule:
    """NULLs pass, as a value check says nothing about them."""
    return Rule(f"{column}_between", F.col(column).isNull() | F.col(column).between(lo, hi), column)


def in_set(column: str, values: Sequence) -> Rule:
    return Rule(f"{column}_in_set", F.col(column).isNull() | F.col(column).isin(list(values)), column)


def quality_report(df: DataFrame, rules: Sequence[Rule], row_range: tuple[int, int] | None = None) -> DataFrame:
    """One row per rule: name, rows checked, violations, passed."""
    missing = {r.name for r in rules if r.column and r.column not in df.columns}
    checks = [r for r in rules if r.condition is not None and r.name not in missing]
    aggs = [F.count_if(~F.coalesce(r.condition, F.lit(False))).alias(f"v{i}") for i, r in enumerate(checks)]
    totals = df.agg(F.count("*").alias("n"), *aggs)
    n = F.col("n")
    structs = [_result(r.name, n, F.col(f"v{i}")) for i, r in enumerate(checks)]
    structs += [
        _result(r.name, n, F.when(F.lit(r.name in missing), n).otherwise(0).cast("long"), F.lit(r.name not in missing))
        for r in rules if r.condition is None or r.name in missing
    ]
    if row_range:
        structs.append(_result("row_count_between", n, F.lit(0).cast("long"), n.between(*row_range)))
    return totals.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _result(name: str, n: Column, violations: Column, passed: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("rule"), n.alias("n_rows"), violations.alias("violations"),
        (violations == 0 if passed is None else passed).cast("int").alias("passed"),
    )


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with the names of the rules they violate."""
    failed = F.array_compact(F.array(*[
        F.when(~F.coalesce(r.condition, F.lit(False)), F.lit(r.name)) for r in rules if r.condition is not None
    ]))
    marked = df.withColumn("violations", failed)
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def unknown_keys(df: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """Distinct keys that the dimension lacks."""
    return df.select(key).distinct().join(dim.select(key), key, "left_anti")
