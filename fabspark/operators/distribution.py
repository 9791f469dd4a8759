"""Class counts, shares, describe tables and shape counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.operators import ordered as O
from fabspark.operators.joins import null_safe_join
from fabspark.session import broadcast_if_small


def class_distribution(df: DataFrame, class_col: str, measures: dict[str, str] | None = None) -> DataFrame:
    """Count and share per class, plus the mean of each ``{output: column}`` measure.

    The total comes from the counts themselves: the window runs over one row per class.
    """
    counts = df.groupBy(class_col).agg(
        F.count("*").alias("n"), *[F.avg(col).alias(out) for out, col in (measures or {}).items()]
    )
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def cumulative_share(counts: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Cumulative percent over a class-count table, in the given order."""
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("cum_pct", 100.0 * F.sum("n").over(upto) / F.sum("n").over(Window.partitionBy()))


def label_coverage(df: DataFrame, label: str, unknown: str = "unknown") -> DataFrame:
    labelled = F.count_if(F.col(label) != unknown)
    return df.agg(
        F.count("*").alias("total"), labelled.alias("labelled"),
        (F.count("*") - labelled).alias("unlabelled"),
        (100.0 * labelled / F.count("*")).alias("labelled_pct"),
    )


def imbalance(df: DataFrame, class_col: str) -> DataFrame:
    """Largest to smallest class ratio, with the class names; ties go to the first name."""
    counts = df.groupBy(class_col).agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", class_col))
    dominant = F.min(F.struct((-F.col("n")).alias("m"), class_col))
    return counts.agg(
        F.max("n").alias("max_n"), F.min("n").alias("min_n"),
        (F.max("n") / F.min("n")).alias("imbalance_ratio"),
        dominant[class_col].alias("dominant_class"), rarest[class_col].alias("rarest_class"),
        F.count("*").alias("n_classes"),
    )


def rare_classes(df: DataFrame, class_col: str, below: int = 1000) -> DataFrame:
    return df.groupBy(class_col).agg(F.count("*").alias("n")).filter(F.col("n") < below)


def class_moments(df: DataFrame, class_col: str, value_col: str) -> DataFrame:
    """Mean, sample std, range, population skew and excess kurtosis per class."""
    v = F.col(value_col)
    return df.groupBy(class_col).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.skewness(v).alias("skew"), F.kurtosis(v).alias("kurt"),
    )


def describe(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), rows_per_bucket: int = O.ROWS_PER_BUCKET
) -> DataFrame:
    """Count, mean, std, min, quartiles and max per column (and key); NULL for a column without values."""
    basics, quartiles = O.summarised_quantiles(df, keys, cols, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, {
        "mean": F.avg, "std": F.stddev_samp, "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
    }, rows_per_bucket)
    return null_safe_join(basics, quartiles, [*keys, "param"], "left")


def box_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Quartiles and whisker ends (last value within 1.5 IQR) per key and column.

    The fences of a group are one row, so the whiskers are a filtered minimum and maximum of the rows.
    """
    names, by = list(cols), list(keys) or ["_all"]
    rows = df.select(*keys, *names) if keys else df.select(F.lit(0).alias("_all"), *names)
    quartiles = O.exact_quantiles(rows, by, names, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = quartiles.select(*by, F.struct(
        "param", "q1", "median", "q3",
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi"),
    ).alias("f"))
    wide = broadcast_if_small(fences.groupBy(*by).agg(*[
        F.max(F.when(F.col("f.param") == c, F.col("f"))).alias(f"_f{i}") for i, c in enumerate(names)]))
    fenced = null_safe_join(rows, wide, by)

    def whiskers(i: int, c: str) -> Column:
        inside = F.col(c).between(F.col(f"_f{i}.lo"), F.col(f"_f{i}.hi"))
        fence = F.first(f"_f{i}")
        return F.struct(
            F.lit(c).alias("param"), *[fence[q].alias(q) for q in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col(c))).cast("double").alias("whisker_lo"),
            F.max(F.when(inside, F.col(c))).cast("double").alias("whisker_hi"),
            F.count_if(~inside).alias("n_outliers")).alias(f"_w{i}")

    out = fenced.groupBy(*by).agg(*[whiskers(i, c) for i, c in enumerate(names)])
    out = out.select(*by, F.explode(F.array(*[f"_w{i}" for i in range(len(names))])).alias("w")).select(*by, "w.*")
    out = out.filter("q1 IS NOT NULL")
    return out if keys else out.drop("_all")


def param_baseline(df: DataFrame, params: Sequence[str], flag: Column | None = None) -> DataFrame:
    """Mean of every parameter and the overall defect rate, as one row."""
    aggs = [F.avg(p).alias(p) for p in params]
    if flag is not None:
        aggs.append(F.avg(flag.cast("double")).alias("defect_rate"))
    return df.agg(*aggs)


def ooc_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(f).alias(f) for f in flags])


def shape_counts(df: DataFrame, rows: str, cols: str) -> DataFrame:
    return df.groupBy(rows, cols).agg(F.count("*").alias("n"))


def shape_summary(df: DataFrame, rows: str, cols: str) -> DataFrame:
    """Distinct shapes and the range, mean and median of each side, from the shape counts."""
    shapes = shape_counts(df, rows, cols)
    # A shape table has at most (max rows x max cols) entries, so the built-in weighted
    # percentile is safe on it.
    return shapes.agg(
        F.count("*").alias("n_shapes"),
        *[agg for side in (rows, cols) for agg in (
            F.min(side).alias(f"{side}_min"), F.max(side).alias(f"{side}_max"),
            (F.sum(F.col(side) * F.col("n")) / F.sum("n")).alias(f"{side}_mean"),
            F.percentile(F.col(side), 0.5, F.col("n")).alias(f"{side}_median"),
        )],
    )


def two_key_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts per row key, one column per value; the value list is given, so no extra job."""
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values])


def top_classes(df: DataFrame, keys: Sequence[str], class_col: str, k: int) -> DataFrame:
    """Most frequent classes per key; ranks one row per (key, class)."""
    counts = df.groupBy(*keys, class_col).agg(F.count("*").alias("n"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc(class_col))
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
