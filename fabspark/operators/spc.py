"""Process-control statistics: capability, limits, run rules and EWMA."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.constants import SPC_LIMITS
from fabspark.functions.limits import cpk
from fabspark.operators import ordered as O
from fabspark.operators.joins import null_safe_join
from fabspark.operators.sketches import SIZE, number, quantiles
from fabspark.session import broadcast_if_small, settled

POWER_RANGE = 575.0  # natural logarithm of 1e250: powers of the decay within a block stay above its inverse


def spc_summary(
    df: DataFrame,
    class_col: str = "failure_type",
    density_col: str | None = "defect_density",
    limits: Mapping[str, tuple[float, float]] = SPC_LIMITS,
    normal_class: str = "none",
) -> DataFrame:
    """Counts, defect rate, mean density and Cpk per class, in one aggregation."""
    bad = F.col(class_col) != normal_class
    density = [F.avg(density_col).alias("avg_defect_density")] if density_col else []
    return df.groupBy(class_col).agg(
        F.count("*").alias("wafer_count"), F.count_if(bad).alias("defect_count"),
        F.avg(bad.cast("double")).alias("defect_rate"), *density,
        *[cpk(F.avg(p), F.stddev_samp(p), *lim).alias(f"cpk_{p}") for p, lim in limits.items()],
    )


def defect_process_stats(
    df: DataFrame, class_col: str, pressure: str, particles: str, density: str, normal_class: str = "none",
    exact: bool = False, rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Mean and spread of the key parameters per defect class, with density percentiles.

    The percentiles are read from quantile sketches of the same single aggregation, unless ``exact``.
    """
    defects = df.filter(F.col(class_col) != normal_class)
    probs = {"median_defect_density": 0.5, "p95_defect_density": 0.95}
    values = F.when(F.count(density) > 0, quantiles(F.kll_sketch_agg_double(number(defects, density), F.lit(SIZE)), list(probs.values())))
    rough = [] if exact else [F.get(values, F.lit(j)).alias(name) for j, name in enumerate(probs)]
    stats = defects.groupBy(class_col).agg(
        F.count("*").alias("n"), F.avg(pressure).alias("avg_cmp"), F.stddev_samp(pressure).alias("std_cmp"),
        F.avg(particles).alias("avg_particles"), *rough,
    )
    if not exact:
        return stats
    exact_part = O.exact_quantiles(defects, [class_col], density, probs, rows_per_bucket, discrete=True)
    return null_safe_join(stats, exact_part, [class_col])


def spc_alerts(
    df: DataFrame, status: Column, class_col: str = "failure_type", normal_class: str = "none"
) -> DataFrame:
    return df.filter(F.col(class_col) != normal_class).withColumn("spc_status", status)


def anomalies(df: DataFrame, condition: Column, order: Sequence[Column], limit: int) -> DataFrame:
    """Worst rows that meet ``condition``; a top-k, so each task keeps only ``limit`` rows."""
    return df.filter(condition).orderBy(*order).limit(limit)


def control_limits(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), sigmas: float = 3.0) -> DataFrame:
    """Mean and mean +- ``sigmas`` standard deviations per column (and key), in wide form."""
    aggs = []
    for c in cols:
        mu, sd = F.avg(c), F.stddev_samp(c)
        aggs += [mu.alias(f"{c}_mean"), sd.alias(f"{c}_sd"),
                 (mu - sigmas * sd).alias(f"{c}_lcl"), (mu + sigmas * sd).alias(f"{c}_ucl")]
    return df.groupBy(*keys).agg(*aggs)


def limit_alarms(df: DataFrame, value: str, series: Sequence[str] = (), sigmas: float = 3.0) -> DataFrame:
    """Rows outside the mean +- 3 sigma of their series."""
    return (
        with_series_stats(df, value, series)
        .filter(F.abs(F.col(value) - F.col("_mean")) > sigmas * F.col("_sd"))
        .withColumn("side", F.when(F.col(value) > F.col("_mean"), "high").otherwise("low"))
        .drop("_mean", "_sd")
    )


def with_series_stats(df: DataFrame, value: str, series: Sequence[str]) -> DataFrame:
    """Add the mean and sample spread of the row's series."""
    stats = df.groupBy(*series).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    if not series:
        mean, sd = stats.first()
        return df.withColumns({"_mean": F.lit(mean).cast("double"), "_sd": F.lit(sd).cast("double")})
    return null_safe_join(df, broadcast_if_small(stats), series)


def run_rules(
    df: DataFrame,
    order_col: str,
    value: str,
    series: Sequence[str] = (),
    trend: int = 7,
    rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Run rules per point: beyond 3 sigma, 2 of 3 beyond 2 sigma on one side, 7 in one direction."""
    rows = with_series_stats(df, value, series)
    z = (F.col(value) - F.col("_mean")) / F.col("_sd")
    rows = rows.withColumn("_z", F.when(F.col("_sd") > 0, z).otherwise(0.0))
    frame, window = O.halo_frames(rows, order_col, trend, series, rows_per_bucket)
    step = F.signum(F.col(value) - F.lag(value).over(window))
    last3 = window.rowsBetween(-2, 0)
    steps = window.rowsBetween(-(trend - 2), 0)

    def two_of_three(sign: int) -> Column:
        return (F.sum((sign * F.col("_z") > 2).cast("int")).over(last3) >= 2) & (sign * F.col("_z") > 2)

    return (
        frame.withColumn("_step", step)
        .withColumns({
            "rule_3sigma": (F.abs(F.col("_z")) > 3).cast("int"),
            "rule_2of3": (two_of_three(1) | two_of_three(-1)).cast("int"),
            "rule_trend": F.coalesce(
                F.abs(F.sum("_step").over(steps)) == trend - 1, F.lit(False)
            ).cast("int"),
        })
        .filter(~F.col("_halo"))
        .drop("_halo", O.BUCKET, "_step", "_z", "_mean", "_sd")
    )


def ewma(
    df: DataFrame,
    order_col: str,
    value: str,
    series: Sequence[str] = (),
    weight: float = 0.2,
    rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Exponentially weighted mean per series: ``s = w x + (1 - w) s_before``, from the first value.

    A reading is the map ``s -> d s + w x`` with ``d = 1 - w``, and such maps compose: after ``k``
    readings of a block the state is ``d^k s_0`` plus a windowed sum of readings scaled by powers of
    ``d``. A range of the order is cut into blocks so short that the powers do not underflow; the
    maps of all blocks, a small table, are composed in the same way to each block's start. NULL and
    NaN readings repeat the smoothed value before them; a series without readings has NULL.
    """
    series = list(series)
    decay = 1.0 - weight
    block = max(1, min(1 << 17, int(POWER_RANGE / -math.log(decay)))) if 0 < decay < 1 else (1 if decay <= 0 else 1 << 17)
    cuts = O.range_cuts(df, order_col, rows_per_bucket)
    rows = O.with_buckets(df.select(*series, order_col, F.col(value).cast("double").alias(value)), order_col, cuts)
    keys = [*series, O.BUCKET]

    def power(exponent: Column) -> Column:
        return F.pow(F.lit(decay), exponent)

    known = F.col(value).isNotNull() & ~F.isnan(value)
    upto = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_k", F.count(F.when(known, 1)).over(upto))
    rows = rows.withColumn("_block", F.floor(F.greatest(F.col("_k") - 1, F.lit(0)) / block))
    rows = rows.withColumn("_i", F.col("_k") - F.col("_block") * block)
    # The latest reading of a full block has power 0, so a sum only shrinks and is scaled back at each row.
    rows = rows.withColumn("_term", F.when(known, weight * F.col(value) * power(block - F.col("_i"))).otherwise(0.0))

    ends = rows.groupBy(*keys, "_block").agg(
        F.max("_i").alias("_m"), F.sum("_term").alias("_sum"), F.min_by(F.when(known, F.col(value)), F.when(known, F.col(order_col))).alias("_first"))
    starts, small = settled(block_starts(settled(ends)[0], series, block, power))
    inside = Window.partitionBy(*keys, "_block").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = F.when(F.col("_i") > 0, F.sum("_term").over(inside) / power(block - F.col("_i"))).otherwise(0.0)
    rows = rows.withColumn("_local", local).drop("_term", "_k")
    return null_safe_join(rows, F.broadcast(starts) if small else starts, [*keys, "_block"]).select(
        *series, order_col, value, (F.col("_local") + power(F.col("_i")) * F.col("_start")).alias("ewma"))


def block_starts(ends: DataFrame, series: list[str], block: int, power) -> DataFrame:
    """State before each block, from the blocks' lengths ``_m``, scaled sums and first readings.

    Blocks end at reading ``_k`` of their series. Ends are grouped by ``block`` readings; within a
    group sums are scaled to its last place, and of earlier groups two are enough, since a third
    power of a group's decay is below the smallest double.
    """
    order, group = [O.BUCKET, "_block"], [*series, "_g"]
    every = Window.partitionBy(*(series or [F.lit(0)])).orderBy(*order)
    ends = ends.withColumn("_k", F.sum("_m").over(every)).withColumn("_g", F.floor((F.col("_k") - 1) / block))
    ends = ends.withColumn("_left", (F.col("_g") + 1) * block - F.col("_k"))
    # The block's own state change, scaled from its length to its group's last place.
    ends = ends.withColumn("_part", F.when(F.col("_m") > 0, F.col("_sum") / power(block - F.col("_m")) * power(F.col("_left"))).otherwise(0.0))
    totals = ends.groupBy(*group).agg(F.sum("_part").alias("_t"))
    before = Window.partitionBy(*(series or [F.lit(0)])).orderBy("_g")
    carried = F.coalesce(F.lag("_t").over(before), F.lit(0.0)) + F.coalesce(F.lag("_t", 2).over(before), F.lit(0.0)) * power(F.lit(block))
    ends = null_safe_join(ends, totals.select(*group, carried.alias("_carried")), group)
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*(series or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first("_first", ignorenulls=True).over(whole)
    after = F.sum("_part").over(within) / power(F.col("_left")) + power(block - F.col("_left")) * F.col("_carried") + power(F.col("_k")) * first
    ends = ends.withColumns({"_after": after, "_x1": first})
    return ends.select(*series, *order, F.coalesce(F.lag("_after").over(every), F.col("_x1")).alias("_start"))
