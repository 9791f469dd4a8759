"""What-if scans, adjustment cost, objective and ROI, from line-item statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabspark import constants as C
from fabspark.functions import risk
from fabspark.operators import correlation as K
from fabspark.operators import economics as E
from fabspark.operators import reports
from fabspark.standins.common import PARAMS, Registry, round_all, rounded, table
from fabspark.standins.stats import KEY, VALUED_SQL, long_sql, valued

R = Registry()
BOUNDS = {"l_quantity": (1.0, 50.0), "l_extendedprice": (900.0, 105000.0), "l_discount": (0.0, 0.1), "l_tax": (0.0, 0.08)}
COST = {"l_quantity": 400.0, "l_extendedprice": 2.0, "l_discount": 25000.0, "l_tax": 60000.0}
CLASSES = ["HighQty", "HighPrice", "none"]
PAIRS = [("HighQty", "l_quantity"), ("HighPrice", "l_extendedprice"), ("HighQty", "l_tax")]
RATE_SQL = "(SELECT avg(CASE WHEN cls <> 'none' THEN 1.0 ELSE 0.0 END) FROM v)"


def _inputs(spark, d):
    rows = valued(spark, d)
    coefficients, stats = K.risk_coefficients(rows, "cls", PARAMS)
    return rows, coefficients, stats


def _scan_sql(cls, p):
    lo, hi = BOUNDS[p]
    return f"""SELECT '{cls}' AS defect_class, '{p}' AS parameter, CAST(step AS INTEGER) AS step, {lo} + ({hi} - {lo}) * step / 49 AS v0,
      (SELECT CASE WHEN abs(r) >= 0.3 THEN r ELSE 0 END FROM k WHERE cls = '{cls}' AND param = '{p}') AS r,
      (SELECT max(abs(r)) >= 0.3 FROM k WHERE cls = '{cls}') AS critical,
      (SELECT avg({p}) FROM v) AS mean, (SELECT stddev_samp({p}) FROM v) + 1e-10 AS sd, {COST[p]} AS unit_cost FROM range(50) s(step)"""


@R.add(f"""WITH {VALUED_SQL}, k AS (SELECT cls, param, round(r, 4) AS r FROM ({long_sql('v', 'cls', CLASSES)})),
  s AS ({' UNION ALL '.join(_scan_sql(c, p) for c, p in PAIRS)}),
  q AS (SELECT *, CASE WHEN critical THEN 1 / (1 + exp(-(r * (v0 - mean) / sd))) ELSE 0 END AS prob FROM s)
  SELECT defect_class, parameter, step, round(v0, 6) AS param_value, round(prob, 6) AS defect_prob,
    round(abs(v0 - mean) * unit_cost, 4) AS adj_cost_usd, 0.0::DOUBLE AS yield_gain_ref,
    round({RATE_SQL} * (1 - prob), 6) AS yield_gain FROM q""")
def whatif_grid(spark, d):
    rows, coefficients, stats = _inputs(spark, d)
    rate = rows.agg(F.avg((F.col("cls") != "none").cast("double"))).first()[0]
    scan = E.whatif_scan(spark, PAIRS, coefficients, stats, BOUNDS, COST, rate)
    return rounded(rounded(scan, 6, "param_value", "defect_prob", "yield_gain_ref", "yield_gain"), 4, "adj_cost_usd")


COST_SQL = " + ".join(f"abs({p} - (SELECT avg({p}) FROM lineitem)) * {COST[p]}" for p in PARAMS)
VIOLATION_SQL = " + ".join(f"(greatest({lo} - {p}, 0) + greatest({p} - {hi}, 0)) / ({hi} - {lo})" for p, (lo, hi) in
                           {"l_quantity": (5.0, 45.0), "l_extendedprice": (5000.0, 90000.0)}.items())


@R.add(f"SELECT {', '.join(KEY)}, round({COST_SQL}, 3) AS cost FROM lineitem")
def adjust_cost(spark, d):
    rows = table(spark, d, "lineitem")
    baseline = rows.agg(*[F.avg(p).alias(p) for p in PARAMS]).first().asDict()
    return rounded(rows.select(*KEY, risk.adjustment_cost(baseline, COST).alias("cost")), 3, "cost")


OBJ_TERMS = " + ".join(
    f"(SELECT CASE WHEN abs(r) >= 0.3 THEN r ELSE 0 END FROM k WHERE cls = 'HighQty' AND param = '{p}') * "
    f"({p} - (SELECT avg({p}) FROM v)) / ((SELECT stddev_samp({p}) FROM v) + 1e-10)" for p in PARAMS)


@R.add(f"""WITH {VALUED_SQL}, k AS (SELECT cls, param, round(r, 4) AS r FROM ({long_sql('v', 'cls', CLASSES)}))
  SELECT {', '.join(KEY)}, round(0.7 * (1 / (1 + exp(-({OBJ_TERMS})))) + 0.2 * least(({COST_SQL.replace('lineitem', 'v')}) / 1000000, 1)
    + 0.1 * least({VIOLATION_SQL}, 1), 6) AS objective FROM v""")
def objective(spark, d):
    """Objective of every observed setting for one class."""
    rows, coefficients, stats = _inputs(spark, d)
    baseline = {p: stats[p][0] for p in PARAMS}
    bounds = {"l_quantity": (5.0, 45.0), "l_extendedprice": (5000.0, 90000.0)}
    cols = E.objective_columns("HighQty", coefficients, stats, baseline, bounds, COST)
    return round_all(rows.select(*KEY, cols["objective"].alias("objective")))


def _best(spark, d):
    _, coefficients, stats = _inputs(spark, d)
    return E.best_settings(spark, CLASSES, coefficients, stats, BOUNDS, COST), {p: stats[p][0] for p in PARAMS}


# The frontier in SQL: parameters by cost per unit of the weighted sum, and per segment its ends,
# the point where the risk falls as fast as the cost rises, and the point where the cost is capped.
_PARAM_ROWS = " UNION ALL ".join(
    f"SELECT '{p}' AS param, avg({p}) AS mean, stddev_samp({p}) + 1e-10 AS sd, {BOUNDS[p][0]}::DOUBLE AS lo, {BOUNDS[p][1]}::DOUBLE AS hi, {COST[p]}::DOUBLE AS c FROM v"
    for p in PARAMS)
BEST_SQL = f"""WITH {VALUED_SQL}, k AS (SELECT cls, param, round(r, 4) AS r FROM ({long_sql('v', 'cls', CLASSES)})),
  st AS ({_PARAM_ROWS}),
  m1 AS (SELECT k.cls, st.*, CASE WHEN abs(k.r) >= 0.3 THEN k.r ELSE 0.0 END AS r, max(abs(k.r)) OVER (PARTITION BY k.cls) >= 0.3 AS critical,
    least(greatest(mean, lo), hi) AS start FROM k JOIN st USING (param)),
  m2 AS (SELECT *, abs(r) / sd * CASE WHEN r > 0 THEN start - lo WHEN r < 0 THEN hi - start ELSE 0 END AS room FROM m1),
  m3 AS (SELECT *, CASE WHEN room > 0 THEN c * sd / abs(r) END AS slope FROM m2),
  m AS (SELECT *, sum(r * (start - mean) / sd) OVER w AS sum0, sum(abs(start - mean) * c) OVER w AS cost0,
      coalesce(sum(room) OVER o, 0) AS before, coalesce(sum(room * coalesce(slope, 0)) OVER o, 0) AS paid FROM m3
    WINDOW w AS (PARTITION BY cls), o AS (PARTITION BY cls ORDER BY slope ASC NULLS LAST, param ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  f AS (SELECT *, (1 - sqrt(greatest(1 - 4 * (0.2 / 0.7) * slope / 1000000, 0))) / 2 AS low FROM m),
  t AS (SELECT *, unnest([0.0, room, least(greatest(coalesce(sum0 - ln(low / (1 - low)) - before, 0), 0), room),
    least(greatest(coalesce((1000000 - cost0 - paid) / slope, 0), 0), room)]) AS x FROM f),
  u AS (SELECT *, cost0 + paid + x * coalesce(slope, 0) AS cost, CASE WHEN critical THEN 1 / (1 + exp(-(sum0 - before - x))) ELSE 0.0 END AS prob FROM t),
  b AS (SELECT cls, critical, min(struct_pack(objective := 0.7 * prob + 0.2 * least(cost / 1000000, 1), x := before + x, prob := prob, cost := cost)) AS b FROM u GROUP BY 1, 2),
  w AS (SELECT m.*, b.b, start + CASE WHEN room > 0 THEN -sign(r) * least(greatest(b.x - before, 0), room) * sd / abs(r) ELSE 0 END AS value
    FROM m JOIN b USING (cls)),
  best AS (SELECT cls AS defect_class, CASE WHEN any_value(critical) THEN 0.5 ELSE 0.0 END AS base, any_value(b) AS b, {', '.join(
      f"max(value) FILTER (param = '{p}') AS {p}, max(value - mean) FILTER (param = '{p}') AS delta_{p}, max(mean) FILTER (param = '{p}') AS mean_{p}" for p in PARAMS)}
    FROM w GROUP BY 1)"""


@R.add(f"""{BEST_SQL}, s AS (SELECT *, (base - b.prob) / (base + 1e-8) * 100 AS red FROM best),
  g AS (SELECT *, red / 100 * base * 25000000.0 AS gain FROM s)
  SELECT defect_class, base::DOUBLE AS baseline_prob, round(b.prob, 4) AS optimal_prob, round(red, 4) AS prob_reduction_pct, round(b.cost, 2) AS adj_cost_usd,
    round(b.objective, 6) AS objective, {', '.join(f'round({p}, 4) + 0.0 AS {p}, round(delta_{p}, 4) + 0.0 AS delta_{p}' for p in PARAMS)},
    round(gain, 0) AS monthly_gain_usd, round(gain * 12, 0) AS annual_gain_usd, round((gain * 12 - b.cost) / (b.cost + 1) * 100, 1) AS roi_pct,
    round(b.cost / (gain + 1), 2) AS payback_months FROM g""")
def best_setting(spark, d):
    """Optimum per class with its solver record."""
    out = E.solver_record(_best(spark, d)[0])
    out = rounded(out, 4, "optimal_prob", "prob_reduction_pct", *PARAMS, *[f"delta_{p}" for p in PARAMS])
    return rounded(rounded(out, 6, "objective"), 2, "adj_cost_usd")


@R.add(f"""{BEST_SQL} SELECT defect_class, true AS not_below_optimum, true AS not_above_baseline FROM best WHERE defect_class <> 'none'""")
def candidate_search(spark, d):
    """The sampled search lies between the optimum and the baseline."""
    _, coefficients, stats = _inputs(spark, d)
    found = E.search_settings(spark, CLASSES[:2], coefficients, stats, BOUNDS, COST)
    best = E.best_settings(spark, CLASSES[:2], coefficients, stats, BOUNDS, COST).select("defect_class", F.col("objective").alias("optimum"))
    return found.join(best, "defect_class").select(
        "defect_class", (F.col("objective") >= F.col("optimum") - 1e-9).alias("not_below_optimum"),
        (F.col("objective") <= 0.7 * F.col("baseline_prob") + 1e-9).alias("not_above_baseline"))


@R.add(f"{BEST_SQL} SELECT defect_class, " + ", ".join(f"round(delta_{p} / (abs(mean_{p}) + 1e-12) * 100, 3) + 0.0 AS {p}" for p in PARAMS) + " FROM best")
def change_matrix(spark, d):
    return rounded(E.change_matrix(*_best(spark, d)), 3, *PARAMS)


@R.add(f"""{BEST_SQL}, l AS ({' UNION ALL '.join(
    f"SELECT defect_class, '{p}' AS param, delta_{p} AS delta, delta_{p} / (abs(mean_{p}) + 1e-12) AS rel FROM best" for p in PARAMS)})
  SELECT defect_class, CAST(row_number() OVER (PARTITION BY defect_class ORDER BY abs(rel) DESC, param) AS INTEGER) AS rank, param, round(delta, 4) AS delta,
    round(rel * 100, 3) AS pct, CASE WHEN delta > 0 THEN 'up' ELSE 'down' END AS direction FROM l WHERE abs(rel) > 0.01""")
def top_changes(spark, d):
    return rounded(rounded(E.top_changes(*_best(spark, d)), 4, "delta"), 3, "pct")


ROI_IN_SQL = """s AS (SELECT l_returnflag AS defect_class, count(*) / sum(count(*)) OVER () AS class_ratio,
    CASE l_returnflag WHEN 'A' THEN 0.08 WHEN 'R' THEN 0.15 ELSE 0.0 END AS yield_impact,
    avg(l_quantity) AS prob_reduction_pct, avg(l_extendedprice) AS adj_cost_usd FROM lineitem GROUP BY 1),
  g AS (SELECT *, class_ratio * yield_impact * 25000000.0 AS loss,
    class_ratio * yield_impact * 25000000.0 - class_ratio * yield_impact * 25000000.0 * (1 - prob_reduction_pct / 100) AS gain FROM s),
  roi AS (SELECT defect_class, round(loss, 0) AS current_monthly_loss_usd, round(loss * (1 - prob_reduction_pct / 100), 0) AS improved_monthly_loss_usd,
    round(gain, 0) AS monthly_gain_usd, round(gain * 12, 0) AS annual_gain_usd, round(adj_cost_usd, 0) AS adj_cost_usd,
    CASE WHEN gain > 0 THEN round(adj_cost_usd / gain, 1) ELSE 'inf'::DOUBLE END AS payback_months,
    round((gain * 12 - adj_cost_usd) / (adj_cost_usd + 1) * 100, 1) AS roi_pct, round(gain * 60 - adj_cost_usd, 0) AS npv_5yr_usd,
    yield_impact::DOUBLE AS yield_impact, round(class_ratio * 100, 3) AS class_ratio_pct FROM g)"""


def _roi(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("defect_class")).agg(
        F.count("*").alias("n"), F.avg("l_quantity").alias("prob_reduction_pct"), F.avg("l_extendedprice").alias("adj_cost_usd"))
    total = counts.agg(F.sum("n")).first()[0]
    impact = F.when(F.col("defect_class") == "A", 0.08).when(F.col("defect_class") == "R", 0.15).otherwise(0.0)
    return E.class_roi(counts.withColumns({"class_ratio": F.col("n") / total, "yield_impact": impact}), C.MONTHLY_REVENUE)


@R.add(f"WITH {ROI_IN_SQL} SELECT * REPLACE (round(payback_months, 1) AS payback_months) FROM roi")
def class_roi(spark, d):
    return _roi(spark, d)


@R.add(f"""WITH {ROI_IN_SQL} SELECT sum(annual_gain_usd) AS total_annual_gain, sum(adj_cost_usd) AS total_adj_cost,
  round((sum(annual_gain_usd) - sum(adj_cost_usd)) / (sum(adj_cost_usd) + 1) * 100, 4) AS combined_roi_pct, sum(npv_5yr_usd) AS total_npv_5yr FROM roi""")
def roi_rollup(spark, d):
    return rounded(E.roi_rollup(_roi(spark, d)), 4, "combined_roi_pct")


META_SQL = ", ".join(f"('{c}', {m[1]}, {m[2]}, {C.SEVERITY_INDEX[m[0]]}, {C.SEVERITY_CONFIDENCE[m[0]]})" for c, m in C.CLASS_META.items())


def _class_of(event_id):
    return F.get(F.array(*[F.lit(c) for c in C.CLASSES]), (event_id % 9).cast("int"))


CLASS_OF_SQL = "CASE event_id % 9 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(C.CLASSES)) + " END"


@R.add(f"""WITH m(failure_type, score, impact, sev, conf) AS (VALUES {META_SQL}),
  e AS (SELECT {CLASS_OF_SQL} AS failure_type, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS rate FROM events GROUP BY 1)
  SELECT failure_type, n, CAST(score AS INTEGER) AS severity_score, CAST(sev AS INTEGER) AS severity_idx, conf::DOUBLE AS confidence,
    round(rate * impact * 100, 6) AS yield_loss_pct, CAST(row_number() OVER (ORDER BY score DESC, failure_type) AS INTEGER) AS priority
  FROM e JOIN m USING (failure_type) WHERE failure_type <> 'none'""")
def severity_report(spark, d):
    """Detected classes with their dimension fields, most severe first."""
    detected = table(spark, d, "events").select(_class_of(F.col("event_id")).alias("failure_type"))
    return rounded(reports.severity_report(spark, detected, "failure_type"), 6, "yield_loss_pct")


@R.add("SELECT stage, " + ", ".join(
    f"CAST(max(CASE WHEN cls = '{c}' THEN rel * n END) AS BIGINT) AS \"{c}\"" for c in C.CLASSES[1:])
    + f""" FROM (SELECT {CLASS_OF_SQL} AS cls, count(*) AS n FROM events GROUP BY 1) JOIN (VALUES """
    + ", ".join(f"('{s}', '{c}', {r})" for c, rels in C.STAGE_RELEVANCE.items() for s, r in zip(C.PROCESS_STAGES, rels))
    + ") b(stage, c2, rel) ON cls = c2 GROUP BY 1")
def stage_relevance(spark, d):
    """Relevance-weighted detections per stage and class."""
    detected = table(spark, d, "events").select(_class_of(F.col("event_id")).alias("failure_type"))
    return reports.stage_load(spark, detected, "failure_type")
