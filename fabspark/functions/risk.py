"""Risk, yield and adjustment-cost arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fabspark import constants as C


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _total(terms: list[Column]) -> Column:
    total = F.lit(0.0)
    for term in terms:
        total = total + term
    return total


def linear_score(coefficients: Mapping[str, float], stats: Mapping[str, tuple[float, float]], values=None) -> Column:
    """Sum of ``r * z`` over the parameters; ``stats`` holds mean and spread, NULL readings add 0."""
    values = values or {}
    return _total([
        F.coalesce(r * (values.get(p, F.col(p)) - stats[p][0]) / stats[p][1], F.lit(0.0))
        for p, r in coefficients.items() if p in stats
    ])


def risk_probability(coefficients, stats, values=None) -> Column:
    """Relative risk of one class; 0 if no parameter is critical for it."""
    if not coefficients:
        return F.lit(0.0)
    return sigmoid(linear_score(coefficients, stats, values))


def panel_probability(coefficients, stats) -> Column:
    """0 at the set point, up to 1 when far off it in the harmful direction."""
    return F.greatest(F.lit(0.0), (sigmoid(linear_score(coefficients, stats)) - 0.5) * 2)


PANEL_STATS = {p: (v[4], v[5]) for p, v in C.DISPLAY_PARAMS.items()}


def panel_probabilities(correlations=C.DISPLAY_CORRELATIONS, stats=None) -> dict[str, Column]:
    stats = stats or PANEL_STATS
    return {cls: panel_probability(coefs, stats) for cls, coefs in correlations.items()}


def dominant_class(probs: Mapping[str, Column], threshold: float = 0.3) -> Column:
    """Class with the highest probability above ``threshold``, first listed on ties; else none."""
    ranked = F.array_max(F.array(*[
        F.struct(p.alias("p"), F.lit(-i).alias("i"), F.lit(cls).alias("cls"))
        for i, (cls, p) in enumerate(probs.items())
    ]))
    return F.when(ranked["p"] > threshold, ranked["cls"]).otherwise("none")


def total_yield_loss(probs: Mapping[str, Column], impacts: Mapping[str, float]) -> Column:
    return F.least(_total([impacts[c] * F.greatest(p, F.lit(0.0)) for c, p in probs.items()]), F.lit(0.99))


def estimated_yield_pct(loss: Column) -> Column:
    return F.greatest(F.lit(1.0), (1 - loss) * 100)


def monthly_loss_musd(loss: Column) -> Column:
    return 25 * loss


def stage_risk(dominant: Column, probs: Mapping[str, Column], defects: list[str]) -> Column:
    """crit if the stage can cause the dominant class, warn if any of its classes is above 0.15."""
    if not defects:
        return F.lit("")
    warn = F.greatest(F.lit(0.0), *[probs.get(d, F.lit(0.0)) for d in defects]) > 0.15
    return F.when(dominant.isin(defects), "crit").when(warn, "warn").otherwise("")


def adjustment_cost(baseline: Mapping[str, float], unit_cost: Mapping[str, float], values=None) -> Column:
    """Cost of moving every listed parameter from its baseline; missing readings cost nothing."""
    values = values or {}
    return _total([
        F.coalesce(F.abs(values.get(p, F.col(p)) - baseline[p]) * unit_cost[p], F.lit(0.0)) for p in baseline
    ])


def range_violation(bounds: Mapping[str, tuple[float, float]], values=None) -> Column:
    values = values or {}
    terms = []
    for p, (lo, hi) in bounds.items():
        v = values.get(p, F.col(p))
        terms.append((F.greatest(lo - v, F.lit(0.0)) + F.greatest(v - hi, F.lit(0.0))) / (hi - lo))
    return _total(terms)


def objective(prob: Column, cost: Column, violation: Column, weights=(0.7, 0.2, 0.1)) -> Column:
    return (
        weights[0] * prob
        + weights[1] * F.least(cost / 1_000_000, F.lit(1.0))
        + weights[2] * F.least(violation, F.lit(1.0))
    )
