"""Lot-level statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.functions.limits import cpk
from fabspark.operators import ordered as O


def lot_spc(
    df: DataFrame, lot: str, class_col: str, param: str, lcl: float, ucl: float, normal: str = "none",
    width: int = 25, rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Mean, spread, Cpk and defect rate per lot and class, with the mean over the last lots of the class."""
    bad = F.col(class_col) != normal
    per_lot = df.groupBy(lot, class_col).agg(
        F.avg(param).alias("avg_param"), F.stddev_samp(param).alias("std_param"),
        cpk(F.avg(param), F.stddev_samp(param), lcl, ucl).alias("cpk_param"),
        F.count("*").alias("wafer_count"), F.count_if(bad).alias("defect_count"),
        F.avg(bad.cast("double")).alias("defect_rate"),
    )
    cuts = O.range_cuts(df, lot, rows_per_bucket)
    return O.rolling_mean(per_lot, lot, ["avg_param"], width, [class_col], cuts=cuts)


def period_trend(df: DataFrame, period: Column, class_col: str, measure: str) -> DataFrame:
    return df.groupBy(period.alias("period"), class_col).agg(
        F.count("*").alias("wafer_count"), F.avg(measure).alias("avg_measure")
    )


def high_defect_lots(df: DataFrame, lot: str, class_col: str, normal: str = "none", above: float = 0.2) -> DataFrame:
    """Lots over the defect rate, with the sorted classes they hold."""
    return df.groupBy(lot).agg(
        F.avg((F.col(class_col) != normal).cast("double")).alias("defect_rate"),
        F.sort_array(F.collect_set(class_col)).alias("defect_types"),
    ).filter(F.col("defect_rate") > above)


def lot_distribution(df: DataFrame, lot: str, class_col: str, classes: Sequence[str]) -> DataFrame:
    return df.groupBy(lot).agg(
        F.count("*").alias("n"), *[F.count_if(F.col(class_col) == c).alias(f"n_{c}") for c in classes]
    )
