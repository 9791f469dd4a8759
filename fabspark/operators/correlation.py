"""Parameter-to-class correlation, from per-class moments and shared value counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.constants import RISK_THRESHOLD, SIGNIFICANCE
from fabspark.functions.labels import direction
from fabspark.operators import ordered as O


def class_param_moments(df: DataFrame, class_col: str, params: Sequence[str]) -> DataFrame:
    """``(class, param, n, mean, m2)``: one aggregation with one output row per class.

    Rows are never unpivoted or repeated per class; only the class-level result is.
    """
    wide = df.groupBy(class_col).agg(*[
        F.struct(
            F.lit(p).alias("param"),
            F.count(p).alias("n"),
            F.avg(F.col(p).cast("double")).alias("mean"),
            (F.var_pop(F.col(p).cast("double")) * F.count(p)).alias("m2"),
        ).alias(p)
        for p in params
    ])
    return wide.select(class_col, F.explode(F.array(*params)).alias("s")).select(class_col, "s.*")


def pearson_from_moments(moments: DataFrame, class_col: str) -> DataFrame:
    """Pearson r of each parameter with membership of each class, over all rows."""
    of_param = Window.partitionBy("param")
    n_all = F.sum("n").over(of_param)
    mean_all = F.sum(F.col("n") * F.col("mean")).over(of_param) / n_all
    with_mean = moments.withColumns({"n_all": n_all, "mean_all": mean_all})
    shift = F.col("mean") - F.col("mean_all")
    m2_all = F.sum(F.coalesce(F.col("m2"), F.lit(0.0)) + F.col("n") * F.coalesce(shift * shift, F.lit(0.0))).over(of_param)
    share = F.col("n") / F.col("n_all")
    spread = F.sqrt(F.col("m2_all") / F.col("n_all") * share * (1 - share))
    return with_mean.withColumn("m2_all", m2_all).select(
        class_col, "param", "n_all", "mean_all",
        F.sqrt(F.try_divide(F.col("m2_all"), F.col("n_all") - 1)).alias("sd_all"),
        F.try_divide(share * shift, spread).alias("pearson_r"),
    )


def t_statistic(r: Column, n: Column) -> Column:
    """t of a correlation; NULL below three rows, infinite for a perfect one."""
    return F.when(
        n > 2,
        F.when(F.abs(r) >= 1, F.signum(r) * F.lit(float("inf")))
        .otherwise(r * F.sqrt(F.try_divide(n - 2, 1 - r * r))),
    )


FRACTION_STEPS = 200
TINY = 1e-300


def log_gamma_step(a: Column) -> Column:
    """``ln G(a + 1/2) - ln G(a)``: the series for large arguments, ten places up, and the product back down."""
    up = a + 10
    series = 0.5 * F.ln(up) - 1 / (8 * up) + 1 / (192 * up**3) - 1 / (640 * up**5) + 17 / (14336 * up**7)
    down = F.aggregate(F.array(*[F.lit(float(k)) for k in range(10)]), F.lit(0.0), lambda s, k: s + F.ln((a + k) / (a + k + 0.5)))
    return series + down


def beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, a fixed number of steps of Lentz's method."""
    def away(v: Column) -> Column:
        return F.when(F.abs(v) < TINY, TINY).otherwise(v)

    def turn(s: Column, coefficient: Column) -> Column:
        d, c = 1 / away(1 + coefficient * s["d"]), away(1 + coefficient / s["c"])
        return F.struct(d.alias("d"), c.alias("c"), (s["f"] * d * c).alias("f"))

    first = 1 / away(1 - (a + b) * x / (a + 1))
    start = F.struct(first.alias("d"), F.lit(1.0).alias("c"), first.alias("f"))
    steps = F.sequence(F.lit(2), F.lit(2 * FRACTION_STEPS + 1))  # even and odd coefficients in turn

    def step(s: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return turn(s, F.when(k % 2 == 0, even).otherwise(odd))

    return F.aggregate(steps, start, step, lambda s: s["f"])


def two_sided_p(t: Column, dof: Column) -> Column:
    """Student-t tail as the regularised incomplete beta function ``I_x(dof / 2, 1 / 2)`` at ``x = dof / (dof + t^2)``.

    One for t = 0, zero for an infinite t, NULL without degrees of freedom. For rows of one class
    and parameter each; the fraction is some hundred steps.
    """
    a, b, n = dof / F.lit(2.0), F.lit(0.5), dof.cast("double")
    x, rest = n / (n + t * t), t * t / (n + t * t)
    front = F.exp(log_gamma_step(a) - 0.5 * F.ln(F.lit(math.pi)) + a * F.ln(x) + 0.5 * F.ln(rest))
    tail = F.when(x < (a + 1) / (a + 2.5), front * beta_fraction(x, a, b) / a).otherwise(1 - front * beta_fraction(rest, b, a) / b)
    return F.when((dof <= 0) | t.isNull() | F.isnan(t), None).when(F.abs(t) == float("inf"), 0.0).when(t == 0, 1.0).otherwise(tail)


def spearman(
    df: DataFrame, class_col: str, params: Sequence[str], classes: Sequence[str],
    rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Spearman rho of each parameter with class membership, ties at their mean rank.

    Ranks are worked out on distinct values. The rank of a 0/1 target is linear in it, so
    rho is the Pearson r between the value rank and membership.
    """
    members = {f"_c{i}": F.count_if(F.col(class_col) == c) for i, c in enumerate(classes)}
    counts, cut = O.long_value_counts(df.select(class_col, *params), [], params, members, rows_per_bucket)
    rank = F.col("avg_rank")
    totals = O.average_ranks(counts, ["param"], cut).groupBy("param").agg(
        F.sum("n").alias("n_all"),
        F.sum(F.col("n") * rank).alias("s_rank"),
        F.sum(F.col("n") * rank * rank).alias("s_rank2"),
        *[F.sum(f"_c{i}").alias(f"n{i}") for i in range(len(classes))],
        *[F.sum(F.col(f"_c{i}") * rank).alias(f"s{i}") for i in range(len(classes))],
    )
    out = totals.select("param", "n_all", "s_rank", "s_rank2", F.explode(F.array(*[
        F.struct(F.lit(c).alias(class_col), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("s"))
        for i, c in enumerate(classes)
    ])).alias("k")).select("param", "n_all", "s_rank", "s_rank2", "k.*")
    n = F.col("n_all")
    cov = F.col("s") / n - F.col("s_rank") / n * F.col("n") / n
    var_rank = F.col("s_rank2") / n - (F.col("s_rank") / n) ** 2
    share = F.col("n") / n
    return out.select(
        class_col, "param", "n_all",
        F.try_divide(cov, F.sqrt(F.greatest(var_rank * share * (1 - share), F.lit(0.0)))).alias("spearman_r"),
    )


def correlation_table(
    df: DataFrame, class_col: str, params: Sequence[str], classes: Sequence[str],
    rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Pearson and Spearman with p-values per class and parameter, ranked by |r| within a class."""
    pearson = pearson_from_moments(class_param_moments(df, class_col, params), class_col)
    both = pearson.filter(F.col(class_col).isin(list(classes))).join(
        spearman(df, class_col, params, classes, rows_per_bucket).drop("n_all"), [class_col, "param"]
    )
    dof = F.col("n_all") - 2
    tested = both.withColumns({
        "_pp": two_sided_p(t_statistic(F.col("pearson_r"), F.col("n_all")), dof),
        "_ps": two_sided_p(t_statistic(F.col("spearman_r"), F.col("n_all")), dof),
    })
    table = tested.select(
        class_col, "param",
        F.round("pearson_r", 4).alias("pearson_r"), F.round("_pp", 4).alias("pearson_p"),
        F.round("spearman_r", 4).alias("spearman_r"), F.round("_ps", 4).alias("spearman_p"),
        F.round(F.abs("pearson_r"), 4).alias("abs_pearson"),
        F.when(F.col("_pp") < SIGNIFICANCE, "Yes").otherwise("No").alias("significant"),
    )
    return rank_by_strength(table, class_col)


def rank_by_strength(table: DataFrame, class_col: str) -> DataFrame:
    """Add ``rank`` by |r| within a class; one row per class and parameter goes in."""
    order = Window.partitionBy(class_col).orderBy(F.desc("abs_pearson"), F.asc("param"))
    return table.withColumn("rank", F.row_number().over(order))


def pearson_matrix(pearson: DataFrame, class_col: str, params: Sequence[str], value: str = "pearson_r") -> DataFrame:
    return pearson.groupBy(class_col).agg(
        *[F.max(F.when(F.col("param") == p, F.col(value))).alias(p) for p in params]
    )


def critical_parameters(table: DataFrame, threshold: float = RISK_THRESHOLD) -> DataFrame:
    return table.filter((F.col("abs_pearson") >= threshold) & (F.col("significant") == "Yes")).withColumn(
        "direction", direction(F.col("pearson_r"))
    )


def correlation_report(table: DataFrame, class_col: str, threshold: float = RISK_THRESHOLD) -> DataFrame:
    """Per class: number, names and r of the critical parameters, strongest first."""
    critical = (F.col("abs_pearson") >= threshold) & (F.col("significant") == "Yes")
    listed = F.array_sort(F.collect_list(F.when(critical, F.struct("rank", "param", "pearson_r"))))
    return table.groupBy(class_col).agg(listed.alias("c")).select(
        class_col, F.size("c").alias("n_critical"), F.col("c.param").alias("critical_params"),
        F.col("c.pearson_r").alias("top_pearson_r"), F.get("c", F.lit(0))["param"].alias("top_param"),
        F.coalesce(F.get("c", F.lit(0))["pearson_r"], F.lit(0.0)).alias("top_r"),
    )


def pairwise_pearson(df: DataFrame, class_col: str, params: Sequence[str], cls: str, normal: str = "none") -> DataFrame:
    """Pearson r between the parameters and one class, against normal rows only."""
    two = df.filter(F.col(class_col).isin(normal, cls))
    pearson = pearson_from_moments(class_param_moments(two, class_col, params), class_col)
    return pearson.filter(F.col(class_col) == cls)


def standardise(df: DataFrame, cols: Sequence[str], eps: float = 1e-10) -> DataFrame:
    """Add ``<col>_z``, using the sample spread; one aggregate row is read back."""
    stats = df.agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return df.withColumns({
        f"{c}_z": (F.col(c) - F.lit(stats[f"{c}_m"]).cast("double")) / (F.lit(stats[f"{c}_s"]).cast("double") + eps)
        for c in cols
    })


def risk_coefficients(df: DataFrame, class_col: str, params: Sequence[str]) -> tuple[dict, dict]:
    """Rounded r per class and critical parameter, and (mean, spread) per parameter.

    One aggregation over the table; what reaches the driver is classes x parameters values.
    Significance is not asked for here.
    """
    rows = pearson_from_moments(class_param_moments(df, class_col, params), class_col).select(
        class_col, "param", F.round("pearson_r", 4).alias("r"), "mean_all", "sd_all"
    ).collect()
    coefficients: dict = {row[class_col]: {} for row in rows}
    for row in rows:
        if row["r"] is not None and abs(row["r"]) >= RISK_THRESHOLD:
            coefficients[row[class_col]][row["param"]] = row["r"]
    stats = {row["param"]: (row["mean_all"], (row["sd_all"] or 0.0) + 1e-10) for row in rows}
    return coefficients, stats
