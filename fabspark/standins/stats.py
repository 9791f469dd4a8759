"""Correlation, significance and risk scoring on line-item measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabspark import constants as C
from fabspark.functions import limits as lim
from fabspark.functions import risk
from fabspark.operators import correlation as K
from fabspark.operators import economics, models
from fabspark.standins.common import FLAGS, PARAMS, ROWS_PER_BUCKET, Registry, round_all, rounded, table

R = Registry()
CLS = "l_returnflag"


def lineitem(spark, d):
    return table(spark, d, "lineitem")


def valued(spark, d):
    """Line items with a class that depends on the measures, so that some are critical."""
    return lineitem(spark, d).withColumn("cls", (
        F.when((F.col("l_quantity") > 35) & (F.col("l_discount") > 0.03), "HighQty")
        .when(F.col("l_extendedprice") > 80000, "HighPrice").otherwise("none")
    )).select("cls", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *PARAMS)


VALUED_SQL = """v AS (SELECT *, CASE WHEN l_quantity > 35 AND l_discount > 0.03 THEN 'HighQty'
  WHEN l_extendedprice > 80000 THEN 'HighPrice' ELSE 'none' END AS cls FROM lineitem)"""


def long_sql(source, cls, classes):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS cls, '{p}' AS param, corr({p}, CASE WHEN {cls} = '{c}' THEN 1.0 ELSE 0.0 END) AS r, count(*) AS n FROM {source}"
        for c in classes for p in PARAMS
    )


@R.add(f"SELECT cls AS l_returnflag, param, n AS n_all, round(r, 6) AS pearson_r FROM ({long_sql('lineitem', CLS, FLAGS)})")
def pearson_long(spark, d):
    out = K.pearson_from_moments(K.class_param_moments(lineitem(spark, d), CLS, PARAMS), CLS)
    return round_all(out.select(CLS, "param", "n_all", "pearson_r"))


@R.add("SELECT cls, " + ", ".join(f"round(max(r) FILTER (param = '{p}'), 6) AS {p}" for p in PARAMS)
       + f" FROM (WITH {VALUED_SQL} {long_sql('v', 'cls', ['HighQty', 'HighPrice', 'none'])}) GROUP BY 1")
def pearson_matrix(spark, d):
    out = K.pearson_from_moments(K.class_param_moments(valued(spark, d), "cls", PARAMS), "cls")
    return round_all(K.pearson_matrix(out, "cls", PARAMS))


@R.add(f"""WITH {VALUED_SQL}, l AS ({long_sql('v', 'cls', ['HighQty', 'HighPrice', 'none'])})
  SELECT cls, param, round(r, 4) AS pearson_r, round(abs(r), 4) AS abs_pearson,
    CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction,
    CAST(row_number() OVER (PARTITION BY cls ORDER BY abs(r) DESC) AS INTEGER) AS rank
  FROM l WHERE round(abs(r), 4) >= 0.3""")
def critical_params(spark, d):
    tbl = K.correlation_table(valued(spark, d), "cls", PARAMS, ["HighQty", "HighPrice", "none"], ROWS_PER_BUCKET)
    return rounded(K.critical_parameters(tbl).select("cls", "param", "pearson_r", "abs_pearson", "direction", "rank"),
                   4, "pearson_r", "abs_pearson")


@R.add(f"""WITH {VALUED_SQL}, l AS ({long_sql('v', 'cls', ['HighQty', 'HighPrice', 'none'])}),
  c AS (SELECT cls, param, round(r, 4) AS r FROM l WHERE round(abs(r), 4) >= 0.3)
  SELECT k.cls, CAST(count(c.param) AS INTEGER) AS n_critical, coalesce(string_agg(c.param, ',' ORDER BY abs(c.r) DESC), '') AS critical_params,
    arg_max(c.param, abs(c.r)) AS top_param, coalesce(arg_max(c.r, abs(c.r)), 0.0) AS top_r
  FROM (SELECT DISTINCT cls FROM v) k LEFT JOIN c ON k.cls = c.cls GROUP BY 1""")
def correlation_report(spark, d):
    tbl = K.correlation_table(valued(spark, d), "cls", PARAMS, ["HighQty", "HighPrice", "none"], ROWS_PER_BUCKET)
    out = K.correlation_report(tbl, "cls").withColumn("critical_params", F.array_join("critical_params", ","))
    return rounded(out.select("cls", "n_critical", "critical_params", "top_param", "top_r"), 4, "top_r")


SPEARMAN_SQL = " UNION ALL ".join(
    f"""SELECT '{p}' AS param, l_returnflag AS f, rank() OVER (ORDER BY {p}) + (count(*) OVER (PARTITION BY {p}) - 1) / 2.0 AS rk FROM lineitem"""
    for p in PARAMS
)


@R.add(f"WITH r AS ({SPEARMAN_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS l_returnflag, param, count(*) AS n_all, round(corr(rk, CASE WHEN f = '{c}' THEN 1.0 ELSE 0.0 END), 6) AS spearman_r FROM r GROUP BY param"
    for c in FLAGS))
def spearman_long(spark, d):
    return round_all(K.spearman(lineitem(spark, d), CLS, PARAMS, FLAGS, ROWS_PER_BUCKET))


@R.add(f"""SELECT cls AS l_returnflag, param, round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t
  FROM ({long_sql('lineitem', CLS, FLAGS)})""")
def corr_tstat(spark, d):
    out = K.pearson_from_moments(K.class_param_moments(lineitem(spark, d), CLS, PARAMS), CLS)
    return rounded(out.select(CLS, "param", K.t_statistic(F.col("pearson_r"), F.col("n_all")).alias("t")), 5, "t")


# Student-t tail by the continued fraction of the incomplete beta function; t = 0 and |r| = 1 do not occur.
def p_sql(r, n):
    """Two-sided p of correlation ``r`` over ``n`` rows, from columns of one row each."""
    x, rest = f"(({n} - 2) / ({n} - 2 + {t2_sql(r, n)}))", f"({t2_sql(r, n)} / ({n} - 2 + {t2_sql(r, n)}))"
    a = f"(({n} - 2) / 2.0)"
    front = f"exp(lgamma({a} + 0.5) - lgamma({a}) - lgamma(0.5::DOUBLE) + {a} * ln({x}) + 0.5 * ln({rest}))"
    return (f"CASE WHEN {x} < ({a} + 1) / ({a} + 2.5) THEN {front} * {fraction_sql(x, a, '0.5')} / {a} "
            f"ELSE 1 - {front} * {fraction_sql(rest, '0.5', a)} / 0.5 END")


def t2_sql(r, n):
    return f"({r} * {r} * ({n} - 2) / (1 - {r} * {r}))"


def fraction_sql(x, a, b):
    """The same fraction from its far end inwards, 60 levels deep."""
    even = f"m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m))"
    odd = f"-({a} + m) * ({a} + {b} + m) * {x} / (({a} + 2 * m) * ({a} + 2 * m + 1))"
    inner = f"list_reduce(list_prepend(0.0::DOUBLE, range(120, -1, -1)::DOUBLE[]), lambda s, k: (CASE WHEN k % 2 = 0 THEN {odd} ELSE {even} END) / (1 + s))"
    return f"(1 / (1 + {inner.replace('m ', 'floor((k + 1) / 2) ').replace('m)', 'floor((k + 1) / 2))')}))"


def correlation_sql():
    pearson = long_sql("lineitem", CLS, FLAGS)
    spear = " UNION ALL ".join(
        f"SELECT '{c}' AS cls, param, corr(rk, CASE WHEN f = '{c}' THEN 1.0 ELSE 0.0 END) AS rs FROM w GROUP BY param" for c in FLAGS)
    return f"""WITH w AS ({SPEARMAN_SQL}), b AS (SELECT cls, param, r, rs, n::DOUBLE AS n FROM ({pearson}) JOIN ({spear}) USING (cls, param)),
  q AS (SELECT *, {p_sql('r', 'n')} AS pp, {p_sql('rs', 'n')} AS ps FROM b)
  SELECT cls AS l_returnflag, param, round(r, 4) AS pearson_r, round(pp, 4) AS pearson_p, round(rs, 4) AS spearman_r, round(ps, 4) AS spearman_p,
    round(abs(r), 4) AS abs_pearson, CASE WHEN pp < 0.05 THEN 'Yes' ELSE 'No' END AS significant,
    CAST(row_number() OVER (PARTITION BY cls ORDER BY round(abs(r), 4) DESC, param) AS INTEGER) AS rank FROM q"""


@R.add(correlation_sql())
def correlation_table(spark, d):
    return round_all(K.correlation_table(lineitem(spark, d), CLS, PARAMS, FLAGS, ROWS_PER_BUCKET), 4)


@R.add(f"WITH {VALUED_SQL}, w AS (SELECT * FROM v WHERE cls IN ('none', 'HighQty')) SELECT cls, param, round(r, 6) AS pearson_r FROM ({long_sql('w', 'cls', ['HighQty'])})")
def pairwise_pearson(spark, d):
    out = K.pairwise_pearson(valued(spark, d), "cls", PARAMS, "HighQty")
    return round_all(out.select("cls", "param", "pearson_r"))


@R.add("""SELECT l_returnflag, round(avg(z), 6) + 0.0 AS mean_z, round(stddev_samp(z), 6) AS sd_z, round(max(z), 6) AS max_z
  FROM (SELECT l_returnflag, (l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / ((SELECT stddev_samp(l_quantity) FROM lineitem) + 1e-10) AS z FROM lineitem) GROUP BY 1""")
def standardise(spark, d):
    z = K.standardise(lineitem(spark, d), ["l_quantity"])
    return round_all(z.groupBy(CLS).agg(
        F.avg("l_quantity_z").alias("mean_z"), F.stddev_samp("l_quantity_z").alias("sd_z"), F.max("l_quantity_z").alias("max_z")))


# Newton's method on three coefficients. The normal tail is the usual rational approximation, good to seven places.
LOGISTIC_SQL = """WITH RECURSIVE d AS (SELECT CASE WHEN quality = 1 THEN 0.0 ELSE 1.0 END AS y, n_chars::DOUBLE AS c, len(string_split(text, ' '))::DOUBLE AS w
    FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
  z AS (SELECT y, (c - avg(c) OVER ()) / (stddev_samp(c) OVER () + 1e-10) AS x, (w - avg(w) OVER ()) / (stddev_samp(w) OVER () + 1e-10) AS u FROM d),
  it AS (SELECT 0 AS k, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 UNION ALL
    SELECT k + 1, b0 + (g0 * (e * f - h * h) - g1 * (b * f - h * c) + g2 * (b * h - e * c)) / det,
      b1 + (-g0 * (b * f - c * h) + g1 * (a * f - c * c) - g2 * (a * h - b * c)) / det, b2 + (g0 * (b * h - c * e) - g1 * (a * h - b * c) + g2 * (a * e - b * b)) / det
    FROM (SELECT *, a * (e * f - h * h) - b * (b * f - h * c) + c * (b * h - e * c) AS det FROM (
      SELECT k, b0, b1, b2, sum(q) AS a, sum(q * x) AS b, sum(q * u) AS c, sum(q * x * x) AS e, sum(q * x * u) AS h, sum(q * u * u) AS f,
        sum(y - p) AS g0, sum((y - p) * x) AS g1, sum((y - p) * u) AS g2
      FROM (SELECT *, p * (1 - p) AS q FROM (SELECT it.*, z.*, 1 / (1 + exp(-(b0 + b1 * x + b2 * u))) AS p FROM it, z)) GROUP BY k, b0, b1, b2)) WHERE k < 25),
  fit AS (SELECT * FROM it WHERE k = 25),
  t AS (SELECT b0, b1, b2, sum(q) AS a, sum(q * x) AS b, sum(q * u) AS c, sum(q * x * x) AS e, sum(q * x * u) AS h, sum(q * u * u) AS f, sum(ll) AS loglik
    FROM (SELECT *, p * (1 - p) AS q, y * ln(p) + (1 - y) * ln(1 - p) AS ll FROM (SELECT fit.*, z.*, 1 / (1 + exp(-(b0 + b1 * x + b2 * u))) AS p FROM fit, z)) GROUP BY b0, b1, b2),
  v AS (SELECT *, a * (e * f - h * h) - b * (b * f - h * c) + c * (b * h - e * c) AS det FROM t),
  r AS (SELECT 'n_chars' AS parameter, b1 AS coef, abs(b1) / sqrt((a * f - c * c) / det) AS s, loglik FROM v UNION ALL
    SELECT 'n_words', b2, abs(b2) / sqrt((a * e - b * b) / det), loglik FROM v),
  m AS (SELECT *, 1 / (1 + 0.3275911 * s / sqrt(2)) AS j FROM r),
  o AS (SELECT *, (0.254829592 * j - 0.284496736 * j ** 2 + 1.421413741 * j ** 3 - 1.453152027 * j ** 4 + 1.061405429 * j ** 5) * exp(-s * s / 2) AS pvalue FROM m)
  SELECT parameter, round(coef, 3) AS coef, round(pvalue, 3) AS pvalue, CASE WHEN pvalue < 0.05 THEN 'Yes' ELSE 'No' END AS significant,
    round(6 - 2 * loglik, 3) AS aic, round(loglik, 3) AS loglik FROM o"""


@R.add(LOGISTIC_SQL)
def logistic_significance(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels").filter("quality IS NOT NULL"), "doc_id").select(
        F.when(F.col("quality") == 1, "none").otherwise("poor").alias("cls"),
        F.col("n_chars").cast("double"), F.size(F.split("text", " ")).cast("double").alias("n_words"),
    )
    return round_all(models.logistic_significance(rows, "cls", "poor", ["n_chars", "n_words"]), 3)


# ---- risk ------------------------------------------------------------------------
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _risk_sql(c):
    terms = " + ".join(
        f"(SELECT CASE WHEN abs(r) >= 0.3 THEN r ELSE 0 END FROM k WHERE cls = '{c}' AND param = '{p}') * "
        f"({p} - (SELECT avg({p}) FROM lineitem)) / ((SELECT stddev_samp({p}) FROM lineitem) + 1e-10)"
        for p in PARAMS
    )
    return (f"round(CASE WHEN (SELECT max(abs(r)) FROM k WHERE cls = '{c}') >= 0.3 THEN 1 / (1 + exp(-({terms}))) ELSE 0 END, 6) AS risk_{c}")


@R.add(f"""WITH {VALUED_SQL}, k AS (SELECT cls, param, round(r, 4) AS r FROM ({long_sql('v', 'cls', ['HighQty', 'HighPrice', 'none'])}))
  SELECT {', '.join(KEY)}, {_risk_sql('HighQty')}, {_risk_sql('HighPrice')} FROM v""")
def risk_score(spark, d):
    rows = valued(spark, d)
    coefficients, stats = K.risk_coefficients(rows, "cls", PARAMS)
    wanted = {c: coefficients[c] for c in ("HighQty", "HighPrice")}
    return round_all(economics.score_rows(rows, wanted, stats).select(*KEY, "risk_HighQty", "risk_HighPrice"))


# Panel readings: line-item measures stretched over the panel ranges.
READINGS = {
    "cmp_pressure": "60 + l_quantity * 1.6",
    "polish_time": "10 + l_tax * 800",
    "annealing_temp": "1000 + l_discount * 2000",
    "temp_gradient": "l_linenumber * 0.4",
    "particle_count": "l_extendedprice / 4000",
}


def readings(spark, d):
    return lineitem(spark, d).select(*KEY, *[F.expr(e).cast("double").alias(p) for p, e in READINGS.items()])


READINGS_SQL = f"x AS (SELECT {', '.join(KEY)}, {', '.join(f'CAST({e} AS DOUBLE) AS {p}' for p, e in READINGS.items())} FROM lineitem)"


def present():
    """Panel coefficients limited to the readings at hand; others are skipped."""
    return {c: {p: r for p, r in k.items() if p in READINGS} for c, k in C.DISPLAY_CORRELATIONS.items()}


def _panel_sql(c):
    terms = " + ".join(f"({r}) * ({p} - {C.DISPLAY_PARAMS[p][4]}) / {C.DISPLAY_PARAMS[p][5]}" for p, r in present()[c].items()) or "0"
    return f"greatest(0, (1 / (1 + exp(-({terms}))) - 0.5) * 2)"


NAMES = {c: "p_" + c.replace("-", "_") for c in C.DISPLAY_CORRELATIONS}
PROBS_SQL = f"{READINGS_SQL}, p AS (SELECT *, {', '.join(f'{_panel_sql(c)} AS {n}' for c, n in NAMES.items())} FROM x)"
BEST_SQL = f"greatest(0.3, {', '.join(NAMES.values())})"
DOM_SQL = "CASE " + " ".join(f"WHEN {n} > 0.3 AND {n} = {BEST_SQL} THEN '{c}'" for c, n in NAMES.items()) + " ELSE 'none' END"


@R.add(f"WITH {PROBS_SQL} SELECT {', '.join(KEY)}, " + ", ".join(f"round({n}, 6) AS {n}" for n in NAMES.values()) + " FROM p")
def panel_probabilities(spark, d):
    probs = risk.panel_probabilities(present())
    return round_all(readings(spark, d).select(*KEY, *[probs[c].alias(n) for c, n in NAMES.items()]))


@R.add(f"WITH {PROBS_SQL} SELECT {DOM_SQL} AS dominant, count(*) AS n FROM p GROUP BY 1")
def dominant_class(spark, d):
    probs = risk.panel_probabilities(present())
    return readings(spark, d).groupBy(risk.dominant_class(probs).alias("dominant")).agg(F.count("*").alias("n"))


LOSS_SQL = "least(" + " + ".join(f"{C.CLASS_META[c][2]} * {n}" for c, n in NAMES.items()) + ", 0.99)"


@R.add(f"""WITH {PROBS_SQL} SELECT {', '.join(KEY)}, round({LOSS_SQL}, 6) AS yield_loss,
  round(greatest(1, (1 - {LOSS_SQL}) * 100), 6) AS yield_pct, round(25 * {LOSS_SQL}, 6) AS monthly_loss FROM p""")
def yield_loss(spark, d):
    probs = risk.panel_probabilities(present())
    loss = risk.total_yield_loss(probs, {c: C.CLASS_META[c][2] for c in probs})
    return round_all(readings(spark, d).select(
        *KEY, loss.alias("yield_loss"), risk.estimated_yield_pct(loss).alias("yield_pct"),
        risk.monthly_loss_musd(loss).alias("monthly_loss")))


STAGE_SQL = " UNION ALL ".join(
    f"SELECT '{stage}' AS stage, CASE WHEN {DOM_SQL} IN ({', '.join(repr(x) for x in defects)}) THEN 'crit' "
    f"WHEN greatest({', '.join(NAMES[x] for x in defects)}) > 0.15 THEN 'warn' ELSE '' END AS risk FROM p"
    if defects else f"SELECT '{stage}' AS stage, '' AS risk FROM p"
    for stage, defects in C.STAGE_DEFECTS.items()
)


@R.add(f"WITH {PROBS_SQL} SELECT stage, risk, count(*) AS n FROM ({STAGE_SQL}) GROUP BY 1, 2")
def stage_risk(spark, d):
    """The stage of a row is unpivoted inside the row; nothing is joined."""
    probs = risk.panel_probabilities(present())
    rows = readings(spark, d).select(
        risk.dominant_class(probs).alias("dominant"), *[probs[c].alias(n) for c, n in NAMES.items()])
    named = {c: F.col(n) for c, n in NAMES.items()}
    stages = F.array(*[
        F.struct(F.lit(s).alias("stage"), risk.stage_risk(F.col("dominant"), named, defects).alias("risk"))
        for s, defects in C.STAGE_DEFECTS.items()
    ])
    return rows.select(F.explode(stages).alias("s")).groupBy("s.stage", "s.risk").agg(F.count("*").alias("n"))


@R.add(f"""WITH {READINGS_SQL}, c AS (SELECT least((120 - cmp_pressure) / 30, (cmp_pressure - 80) / 30) AS cpk FROM x)
  SELECT CASE WHEN cpk >= 1.33 THEN 'good' WHEN cpk >= 1.0 THEN 'marginal' ELSE 'poor' END AS band, count(*) AS n, round(avg(cpk), 6) AS avg_cpk
  FROM c GROUP BY 1""")
def point_cpk(spark, d):
    v = C.DISPLAY_PARAMS["cmp_pressure"]
    value = lim.point_cpk(F.col("cmp_pressure"), v[2], v[3], v[5])
    rows = readings(spark, d).select(value.alias("cpk"))
    return round_all(rows.groupBy(lim.cpk_band(F.col("cpk")).alias("band")).agg(
        F.count("*").alias("n"), F.avg("cpk").alias("avg_cpk")))
