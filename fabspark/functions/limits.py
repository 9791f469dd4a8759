"""Control-limit flags, capability indices and status bands as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.constants import ALERT_LEVELS, CPK_EPS, DISPLAY_PARAMS, SPC_LIMITS


def ooc_flag(value: Column, lcl: float, ucl: float) -> Column:
    """1 outside the limits, else 0. NULL and NaN readings count as in control."""
    outside = (value < lcl) | ((value > ucl) & ~F.isnan(value))
    return F.coalesce(outside, F.lit(False)).cast("int")


def with_ooc_flags(df: DataFrame, limits: Mapping[str, tuple[float, float]] = SPC_LIMITS) -> DataFrame:
    present = {p: lim for p, lim in limits.items() if p in df.columns}
    return df.withColumns({f"{p}_ooc": ooc_flag(F.col(p), *lim) for p, lim in present.items()})


def any_ooc(flags: Sequence[str]) -> Column:
    """1 if any flag of the row is set; missing flags count as 0."""
    return F.greatest(F.lit(0), *[F.coalesce(F.col(c), F.lit(0)) for c in flags]).cast("int")


def cpk(mean: Column, sd: Column, lcl: float, ucl: float, eps: float = CPK_EPS) -> Column:
    spread = 3 * sd + eps
    return F.when(
        mean.isNotNull() & sd.isNotNull(), F.least((ucl - mean) / spread, (mean - lcl) / spread)
    )


def point_cpk(value: Column, normal_min: float, normal_max: float, sd: float) -> Column:
    return F.least((normal_max - value) / (3 * sd), (value - normal_min) / (3 * sd))


def cpk_band(value: Column) -> Column:
    return F.when(value >= 1.33, "good").when(value >= 1.0, "marginal").otherwise("poor")


def cpk_alarm(value: Column) -> Column:
    return F.when(value < 1.0, "CRITICAL").when(value < 1.33, "WARNING").otherwise("OK")


def alert_status(
    particles: Column, pressure: Column, levels: Mapping[str, tuple[float, float]] = ALERT_LEVELS
) -> Column:
    """First level whose particle or pressure threshold is exceeded, else OK."""
    status = F.lit("OK")
    for level, (count, force) in reversed(levels.items()):
        status = F.when((particles > count) | (pressure > force), level).otherwise(status)
    return status


def param_status(value: Column, normal_min: float, normal_max: float) -> Column:
    """ok inside the normal range; crit when more than a quarter range outside it, else warn.

    A missing reading (NULL or NaN) has no status.
    """
    deviation = F.greatest(normal_min - value, value - normal_max, F.lit(0.0))
    relative = deviation / ((normal_max - normal_min) * 0.5 + 1e-9)
    return (
        F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None).cast("string"))
        .when((value >= normal_min) & (value <= normal_max), "ok")
        .when(relative > 0.5, "crit")
        .otherwise("warn")
    )


def status_array(ranges: Mapping[str, tuple[float, float]]) -> Column:
    """One struct per parameter: name, value and status; unpivots a row without a shuffle."""
    return F.array(*[
        F.struct(
            F.lit(p).alias("param"),
            F.col(p).cast("double").alias("value"),
            param_status(F.col(p), lo, hi).alias("status"),
        )
        for p, (lo, hi) in ranges.items()
    ])


DISPLAY_RANGES = {p: (v[2], v[3]) for p, v in DISPLAY_PARAMS.items()}
