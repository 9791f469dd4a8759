"""What-if scans, candidate search and return on investment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabspark import constants as C
from fabspark.functions import risk
from fabspark.operators.splitting import uniform
from fabspark.session import local_frame


def whatif_scan(
    spark: SparkSession,
    pairs: Sequence[tuple[str, str]],
    coefficients: Mapping[str, Mapping[str, float]],
    stats: Mapping[str, tuple[float, float]],
    bounds: Mapping[str, tuple[float, float]] = C.PARAM_BOUNDS,
    unit_cost: Mapping[str, float] = C.PARAM_COST,
    defect_rate: float = 0.0,
    steps: int = 50,
) -> DataFrame:
    """Move one parameter over its range, the others at their mean.

    One row per (class, parameter, step). ``yield_gain_ref`` is the published measure, which
    cannot be above 0; ``yield_gain`` is the gain over the current defect rate.
    """
    rows = []
    for cls, p in pairs:
        critical = coefficients.get(cls, {})
        mean, sd = stats[p]
        rows.append((cls, p, *bounds[p], float(critical.get(p, 0.0)), bool(critical), mean, sd, unit_cost[p]))
    scan = local_frame(
        spark,
        rows,
        "defect_class string, parameter string, lo double, hi double, r double, has_critical boolean, "
        "mean double, sd double, unit_cost double",
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("step") / (steps - 1)
    prob = F.when(F.col("has_critical"), risk.sigmoid(F.col("r") * (F.col("param_value") - F.col("mean")) / F.col("sd")))
    return (
        scan.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
        .withColumn("param_value", value)
        .withColumn("defect_prob", prob.otherwise(0.0))
        .select(
            "defect_class", "parameter", "step", "param_value", "defect_prob",
            (F.abs(F.col("param_value") - F.col("mean")) * F.col("unit_cost")).alias("adj_cost_usd"),
            F.greatest(F.lit(0.0), defect_rate * (F.col("defect_prob") - 1)).alias("yield_gain_ref"),
            (defect_rate * (1 - F.col("defect_prob"))).alias("yield_gain"),
        )
    )


def score_rows(
    df: DataFrame, coefficients: Mapping[str, Mapping[str, float]], stats: Mapping[str, tuple[float, float]],
    prefix: str = "risk_",
) -> DataFrame:
    """Risk of every class for every row, as one projection."""
    return df.withColumns({f"{prefix}{c}": risk.risk_probability(coefs, stats) for c, coefs in coefficients.items()})


def objective_columns(
    cls: str, coefficients, stats, baseline, bounds, unit_cost, values=None
) -> dict[str, Column]:
    prob = risk.risk_probability(coefficients.get(cls, {}), stats, values)
    cost = risk.adjustment_cost(baseline, unit_cost, values)
    return {
        "prob": prob, "cost": cost,
        "objective": risk.objective(prob, cost, risk.range_violation(bounds, values)),
    }


def search_settings(
    spark: SparkSession,
    classes: Sequence[str],
    coefficients: Mapping[str, Mapping[str, float]],
    stats: Mapping[str, tuple[float, float]],
    bounds: Mapping[str, tuple[float, float]] = C.PARAM_BOUNDS,
    unit_cost: Mapping[str, float] = C.PARAM_COST,
    candidates: int = 20_000,
    rounds: int = 4,
    shrink: float = 0.35,
    seed: int = 42,
) -> DataFrame:
    """Best parameter setting per class, by distributed random search.

    Every round draws settings around the best so far, each parameter kept at that best value
    with probability one half, and keeps the lowest objective per class. The baseline is the
    first setting, so the result is never worse than it. Rows per round: candidates x classes.
    """
    params = list(bounds)
    baseline = {p: stats[p][0] for p in params}
    best = {c: dict(baseline) for c in classes}
    result = None
    for step in range(rounds):
        width = shrink ** step
        centre = local_frame(
            spark,
            [(c, i, *[float(best[c][p]) for p in params]) for i, c in enumerate(classes)],
            "defect_class string, _ci int, " + ", ".join(f"`_c_{p}` double" for p in params),
        )
        ids = spark.range(candidates).withColumn("_ci", F.explode(F.sequence(F.lit(0), F.lit(len(classes) - 1))))
        drawn = ids.join(F.broadcast(centre), "_ci")
        cols = {}
        for j, p in enumerate(params):
            lo, hi = bounds[p]
            u = uniform("id", "_ci", F.lit(seed + 1000 * step + 2 * j))
            keep = uniform("id", "_ci", F.lit(seed + 1000 * step + 2 * j + 1)) < 0.5
            at = F.col(f"_c_{p}")
            offset = at + (u - 0.5) * 2 * width * (hi - lo)
            clipped = F.least(F.greatest(offset if step else lo + u * (hi - lo), F.lit(lo)), F.lit(hi))
            cols[p] = F.when((F.col("id") == 0) | keep, at).otherwise(clipped)
        settings = drawn.select("defect_class", "id", *[cols[p].alias(p) for p in params])
        scored = settings.withColumns({
            "prob": _by_class(classes, lambda c: risk.risk_probability(coefficients.get(c, {}), stats)),
            "cost": risk.adjustment_cost(baseline, unit_cost),
            "violation": risk.range_violation(bounds),
        }).withColumn("objective", risk.objective(F.col("prob"), F.col("cost"), F.col("violation")))
        result = scored.groupBy("defect_class").agg(
            F.min(F.struct("objective", "id", "prob", "cost", *params)).alias("b")
        ).select("defect_class", "b.objective", "b.prob", "b.cost", *[f"b.{p}" for p in params])
        rows = result.collect()  # one row per class
        best = {row["defect_class"]: {p: row[p] for p in params} for row in rows}
    found = local_frame(spark, rows, result.schema)
    base_prob = _by_class(classes, lambda c: F.lit(0.5 if coefficients.get(c) else 0.0))
    return found.select(
        "defect_class", base_prob.alias("baseline_prob"), F.col("prob").alias("optimal_prob"),
        ((base_prob - F.col("prob")) / (base_prob + 1e-8) * 100).alias("prob_reduction_pct"),
        F.col("cost").alias("adj_cost_usd"), "objective", *params,
        *[(F.col(p) - baseline[p]).alias(f"delta_{p}") for p in params],
    )


def best_settings(
    spark: SparkSession,
    classes: Sequence[str],
    coefficients: Mapping[str, Mapping[str, float]],
    stats: Mapping[str, tuple[float, float]],
    bounds: Mapping[str, tuple[float, float]] = C.PARAM_BOUNDS,
    unit_cost: Mapping[str, float] = C.PARAM_COST,
) -> DataFrame:
    """The setting within ``bounds`` with the lowest objective per class, in the columns of ``search_settings``.

    The risk depends on one weighted sum of the parameters, so the cheapest way to lower that sum
    by ``x`` is to move parameters in the order of their cost per unit of the sum. Along this
    frontier the cost is linear between break points, and between two of them the objective is
    lowest at an end or where the risk falls as fast as the cost rises, which has a closed form.
    A parameter whose mean lies outside its bounds starts at the nearer one. All candidates are
    scored: some parameters times four per class.
    """
    rows = []
    for cls in classes:
        for p, (lo, hi) in bounds.items():
            mean, sd = stats[p]
            rows.append((cls, p, float(coefficients.get(cls, {}).get(p, 0.0)), mean, sd, lo, hi, unit_cost[p], bool(coefficients.get(cls))))
    moves = local_frame(spark, rows, "defect_class string, param string, r double, mean double, sd double, lo double, hi double, unit_cost double, critical boolean")
    start, r = F.least(F.greatest("mean", "lo"), F.col("hi")), F.col("r")
    moves = moves.withColumn("start", start).withColumn("way", -F.signum(r))
    reach = F.when(r > 0, F.col("start") - F.col("lo")).when(r < 0, F.col("hi") - F.col("start")).otherwise(0.0)
    moves = moves.withColumn("room", F.abs(r) / F.col("sd") * reach)
    moves = moves.withColumn("slope", F.when(F.col("room") > 0, F.col("unit_cost") * F.col("sd") / F.abs(r)))
    of_class = Window.partitionBy("defect_class")
    ahead = of_class.orderBy(F.col("slope").asc_nulls_last(), "param").rowsBetween(Window.unboundedPreceding, -1)
    moves = moves.withColumns({
        "sum0": F.sum(r * (F.col("start") - F.col("mean")) / F.col("sd")).over(of_class),
        "cost0": F.sum(F.abs(F.col("start") - F.col("mean")) * F.col("unit_cost")).over(of_class),
        "before": F.coalesce(F.sum("room").over(ahead), F.lit(0.0)),
        "paid": F.coalesce(F.sum(F.col("room") * F.coalesce("slope", F.lit(0.0))).over(ahead), F.lit(0.0)),
    })
    # The slope of the risk equals that of the cost where s (1 - s) = q; of the two the lower s is the minimum.
    q = (0.2 / 0.7) * F.col("slope") / 1_000_000
    low = (1 - F.sqrt(F.greatest(1 - 4 * q, F.lit(0.0)))) / 2
    flat = F.col("sum0") - F.ln(low / (1 - low)) - F.col("before")
    capped = (1_000_000 - F.col("cost0") - F.col("paid")) / F.col("slope")
    steps = F.array(F.lit(0.0), F.col("room"), *[F.least(F.greatest(F.coalesce(v, F.lit(0.0)), F.lit(0.0)), F.col("room")) for v in (flat, capped)])
    tried = moves.withColumn("x", F.explode(F.array_distinct(steps)))
    cost = F.col("cost0") + F.col("paid") + F.col("x") * F.coalesce("slope", F.lit(0.0))
    prob = F.when(F.col("critical"), risk.sigmoid(F.col("sum0") - F.col("before") - F.col("x"))).otherwise(0.0)
    tried = tried.withColumns({"cost": cost, "prob": prob, "objective": risk.objective(prob, cost, F.lit(0.0))})
    best = tried.groupBy("defect_class").agg(F.min(F.struct("objective", (F.col("before") + F.col("x")).alias("x"), "prob", "cost")).alias("_best"))
    placed = moves.join(best, "defect_class")
    moved = F.least(F.greatest(F.col("_best.x") - F.col("before"), F.lit(0.0)), F.col("room"))
    placed = placed.withColumn("value", F.col("start") + F.when(F.col("room") > 0, F.col("way") * moved * F.col("sd") / F.abs(r)).otherwise(0.0))
    wide = placed.groupBy("defect_class").agg(
        F.first("critical").alias("critical"), F.first("_best").alias("_best"), *[F.max(F.when(F.col("param") == p, F.col("value"))).alias(p) for p in bounds])
    base = F.when(F.col("critical"), 0.5).otherwise(0.0)
    return wide.select(
        "defect_class", base.alias("baseline_prob"), F.col("_best.prob").alias("optimal_prob"),
        ((base - F.col("_best.prob")) / (base + 1e-8) * 100).alias("prob_reduction_pct"), F.col("_best.cost").alias("adj_cost_usd"),
        F.col("_best.objective").alias("objective"), *bounds, *[(F.col(p) - F.lit(stats[p][0])).alias(f"delta_{p}") for p in bounds])


def _by_class(classes: Sequence[str], build) -> Column:
    out = None
    for c in classes:
        hit = F.col("defect_class") == c
        out = F.when(hit, build(c)) if out is None else out.when(hit, build(c))
    return out


def solver_record(found: DataFrame, monthly_revenue: float = C.MONTHLY_REVENUE) -> DataFrame:
    """Gain, ROI and payback of a found setting when the whole risk is the loss base."""
    gain = F.col("prob_reduction_pct") / 100 * F.col("baseline_prob") * monthly_revenue
    return found.withColumns({
        "monthly_gain_usd": F.round(gain, 0), "annual_gain_usd": F.round(gain * 12, 0),
        "roi_pct": F.round((gain * 12 - F.col("adj_cost_usd")) / (F.col("adj_cost_usd") + 1) * 100, 1),
        "payback_months": F.round(F.col("adj_cost_usd") / (gain + 1), 2),
    })


def class_roi(df: DataFrame, monthly_revenue: float = C.MONTHLY_REVENUE) -> DataFrame:
    """ROI per class from ``class_ratio, yield_impact, prob_reduction_pct, adj_cost_usd``."""
    loss = F.col("class_ratio") * F.col("yield_impact") * monthly_revenue
    improved = loss * (1 - F.col("prob_reduction_pct") / 100)
    gain = loss - improved
    cost = F.col("adj_cost_usd")
    return df.select(
        "defect_class",
        F.round(loss, 0).alias("current_monthly_loss_usd"), F.round(improved, 0).alias("improved_monthly_loss_usd"),
        F.round(gain, 0).alias("monthly_gain_usd"), F.round(gain * 12, 0).alias("annual_gain_usd"),
        F.round(cost, 0).alias("adj_cost_usd"),
        F.when(gain > 0, F.round(F.try_divide(cost, gain), 1)).otherwise(F.lit(float("inf"))).alias("payback_months"),
        F.round((gain * 12 - cost) / (cost + 1) * 100, 1).alias("roi_pct"),
        F.round(gain * 60 - cost, 0).alias("npv_5yr_usd"),
        "yield_impact", F.round(F.col("class_ratio") * 100, 3).alias("class_ratio_pct"),
    )


def roi_of_settings(found: DataFrame, labels: DataFrame, class_col: str, impact: DataFrame,
                    monthly_revenue: float = C.MONTHLY_REVENUE) -> DataFrame:
    """ROI per class from found settings, the share of each class in ``labels`` and its yield impact.

    ``found`` has ``defect_class``, ``prob_reduction_pct`` and ``adj_cost_usd``, as the search
    returns them; ``impact`` has ``failure_type`` and ``yield_impact``, as the class dimension has.
    A class without rows in ``labels`` has a ratio of 0. All three sides are one row per class.
    """
    share = labels.groupBy(F.col(class_col).alias("defect_class")).agg(F.count("*").alias("n"))
    share = share.withColumn("class_ratio", F.col("n") / F.sum("n").over(Window.partitionBy())).drop("n")
    known = impact.select(F.col("failure_type").alias("defect_class"), "yield_impact")
    joined = found.join(share, "defect_class", "left").join(known, "defect_class")
    return class_roi(joined.withColumn("class_ratio", F.coalesce("class_ratio", F.lit(0.0))), monthly_revenue)


def roi_rollup(roi: DataFrame) -> DataFrame:
    gain, cost = F.sum("annual_gain_usd"), F.sum("adj_cost_usd")
    return roi.agg(
        gain.alias("total_annual_gain"), cost.alias("total_adj_cost"),
        ((gain - cost) / (cost + 1) * 100).alias("combined_roi_pct"), F.sum("npv_5yr_usd").alias("total_npv_5yr"),
    )


def change_matrix(found: DataFrame, baseline: Mapping[str, float]) -> DataFrame:
    """Relative change of each parameter, in percent of the baseline."""
    return found.select(
        "defect_class",
        *[(F.col(f"delta_{p}") / (abs(b) + 1e-12) * 100).alias(p) for p, b in baseline.items()],
    )


def top_changes(found: DataFrame, baseline: Mapping[str, float], k: int = 5) -> DataFrame:
    """Largest relative changes above 1% of the baseline, ranked per class."""
    changes = F.array(*[
        F.struct(
            (-F.abs(F.col(f"delta_{p}") / (abs(b) + 1e-12))).alias("order"), F.lit(p).alias("param"),
            F.col(f"delta_{p}").alias("delta"), (F.col(f"delta_{p}") / (abs(b) + 1e-12) * 100).alias("pct"),
        )
        for p, b in baseline.items()
    ])
    # The array has one entry per parameter, so ranking inside the row needs no shuffle.
    kept = F.slice(F.array_sort(F.filter(changes, lambda c: c["order"] < -0.01)), 1, k)
    return found.select("defect_class", F.posexplode(kept).alias("pos", "c")).select(
        "defect_class", (F.col("pos") + 1).alias("rank"), "c.param", "c.delta", "c.pct",
        F.when(F.col("c.delta") > 0, "up").otherwise("down").alias("direction"),
    )
