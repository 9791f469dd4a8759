"""Correlation, splits, weights, evaluation and economics against numpy and published figures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fabspark import constants as C
from fabspark.functions import kernels as K
from fabspark.operators import correlation, distribution, economics, evaluation, models, splitting

CLASSES = ["none", "a", "b"]


@pytest.fixture(scope="module")
def measured(spark):
    rng = np.random.default_rng(7)
    n = 600
    cls = rng.choice(CLASSES, n, p=[0.6, 0.3, 0.1])
    x = rng.normal(100, 10, n) + 12 * (cls == "a")
    y = np.round(rng.normal(1e-6, 1e-7, n) - 1.5e-7 * (cls == "b"), 8)
    z = rng.normal(size=n)
    rows = [(i, str(c), float(a), float(b), float(d)) for i, (c, a, b, d) in enumerate(zip(cls, x, y, z))]
    return spark.createDataFrame(rows, "id int, cls string, x double, y double, z double")


def ranks(v):
    _, inverse, counts = np.unique(v, return_inverse=True, return_counts=True)
    upto = np.cumsum(counts)
    return (upto - counts + (counts + 1) / 2)[inverse]


@pytest.mark.parametrize("bucket", [50, 10_000])
def test_correlations(measured, bucket):
    pdf = measured.toPandas()
    table = correlation.correlation_table(measured, "cls", ["x", "y", "z"], CLASSES, bucket).collect()
    assert len(table) == 9
    for row in table:
        target, v = (pdf.cls == row["cls"]).astype(float), pdf[row["param"]].to_numpy()
        r, rho = np.corrcoef(v, target)[0, 1], np.corrcoef(ranks(v), target)[0, 1]
        assert row["pearson_r"] == pytest.approx(r, abs=6e-5) and row["spearman_r"] == pytest.approx(rho, abs=6e-5)
        t = r * math.sqrt(598 / (1 - r * r))
        assert row["pearson_p"] == pytest.approx(math.erfc(abs(t) / math.sqrt(2)), abs=2e-3)
    order = sorted((r["rank"], r["param"]) for r in table if r["cls"] == "a")
    assert order[0] == (1, "x")
    report = {r["cls"]: r for r in correlation.correlation_report(
        correlation.correlation_table(measured, "cls", ["x", "y", "z"], CLASSES, bucket), "cls").collect()}
    assert report["a"]["top_param"] == "x" and report["a"]["n_critical"] == 1


def test_correlation_skips_missing_readings(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0), ("a", 0.0)], "cls string, x double")
    out = {r["cls"]: r["pearson_r"] for r in
           correlation.pearson_from_moments(correlation.class_param_moments(df, "cls", ["x"]), "cls").collect()}
    assert out["a"] == pytest.approx(np.corrcoef([1, 2, 4, 0], [1, 0, 0, 1])[0, 1])


# Two-sided tails from standard t tables.
@pytest.mark.parametrize("t,dof,p", [(12.7062, 1, 0.05), (2.2281, 10, 0.05), (-2.2281, 10, 0.05), (1.9600, 1e7, 0.05),
                                     (0.0, 5, 1.0), (3.1693, 10, 0.01), (0.6998, 10, 0.5), (math.inf, 5, 0.0)])
def test_student_tail(t, dof, p):
    assert K.beta_tail(np.array([t]), np.array([dof]))[0] == pytest.approx(p, abs=2e-5)


def test_logistic_against_newton(measured):
    pdf = measured.toPandas()
    pdf = pdf[pdf.cls.isin(["none", "a"])]
    v = pdf[["x", "z"]].to_numpy()
    v = np.column_stack([np.ones(len(v)), (v - v.mean(0)) / v.std(0, ddof=1)])
    y, beta = (pdf.cls == "a").to_numpy(float), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-v @ beta))
        hess = (v * (p * (1 - p))[:, None]).T @ v
        beta += np.linalg.solve(hess, v.T @ (y - p))
    loglik = (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    rows = {r["parameter"]: r for r in models.logistic_significance(measured, "cls", "a", ["x", "z"]).collect()}
    assert rows["x"]["coef"] == pytest.approx(beta[1], rel=1e-4) and rows["z"]["coef"] == pytest.approx(beta[2], abs=1e-4)
    assert rows["x"]["loglik"] == pytest.approx(loglik, rel=1e-6)
    assert rows["x"]["aic"] == pytest.approx(2 * 3 - 2 * loglik, rel=1e-6) and rows["x"]["significant"] == "Yes"


# ---- splits -----------------------------------------------------------------------
PUBLISHED = {"none": 147431, "Edge-Ring": 9680, "Edge-Loc": 5189, "Center": 4294, "Loc": 3593, "Scratch": 1193,
             "Random": 866, "Donut": 555, "Near-full": 149}


def sizes_of(spark, counts):
    rows = spark.createDataFrame(list(counts.items()), "cls string, n long")
    rows = rows.select("cls", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    return {r["cls"]: (r["train"], r["val"], r["test"]) for r in splitting.split_sizes(rows, "cls").collect()}


def test_published_split_sizes(spark):
    sizes = sizes_of(spark, PUBLISHED)
    assert [sum(s[i] for s in sizes.values()) for i in range(3)] == [121065, 25942, 25943]
    for c, (a, b, d) in sizes.items():
        assert a + b + d == PUBLISHED[c]
        assert abs(a - 0.7 * PUBLISHED[c]) <= 1 and abs(b - 0.15 * PUBLISHED[c]) <= 1.5


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_stratified_split_is_exact(spark, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
                               .otherwise(F.concat(F.lit("c"), F.col("id") % 4)).alias("cls"))
    counts = {r["cls"]: r["count"] for r in df.groupBy("cls").count().collect()}
    tagged = splitting.stratified_split(df, "id", "cls")
    got = {(r["cls"], r["split"]): r["count"] for r in tagged.groupBy("cls", "split").count().collect()}
    assert {r["cls"]: r["n"] for r in splitting.split_sizes(df, "cls").collect()} == counts
    for c, sizes in ((r["cls"], (r["train"], r["val"], r["test"])) for r in splitting.split_sizes(df, "cls").collect()):
        assert [got.get((c, s), 0) for s in C.SPLITS] == list(sizes)
    again = splitting.stratified_split(df.repartition(7), "id", "cls")
    assert sorted(map(str, again.collect())) == sorted(map(str, tagged.collect()))


@pytest.mark.parametrize("cell_rows", [100_000, 30])
def test_resample(spark, cell_rows):
    df = spark.range(4000).select("id", F.when(F.col("id") < 3800, "big").when(F.col("id") < 3900, None).otherwise("small").alias("cls"), F.lit("x").alias("extra"))
    for seed in range(3):
        drawn = splitting.weighted_resample(df, "id", "cls", seed=seed, cell_rows=cell_rows).cache()
        counts = {r["cls"]: r["count"] for r in drawn.groupBy("cls").count().collect()}
        assert sum(counts.values()) == 4000 and drawn.columns == df.columns
        for n in counts.values():  # a third each, binomial spread
            assert abs(n - 4000 / 3) < 6 * math.sqrt(4000 * 2 / 9)
        assert drawn.filter("cls = 'small'").distinct().count() == 100
        per_row = [r["count"] for r in drawn.filter("cls = 'small'").groupBy("id").count().collect()]
        assert abs(np.var(per_row) - np.mean(per_row)) < 0.8 * np.mean(per_row)  # as independent draws spread
    again = splitting.weighted_resample(df.repartition(6), "id", "cls", seed=2, cell_rows=cell_rows)
    assert sorted(r[0] for r in drawn.select("id").collect()) == sorted(r[0] for r in again.select("id").collect())
    exact = lambda *a, **k: splitting.weighted_resample(*a, cell_rows=cell_rows, **k)
    assert exact(df.filter("id < 1"), "id", "cls", draws=5000).count() == 5000
    weighed = {r["cls"]: r["count"] for r in exact(df, "id", "cls", {"big": 1.0, "small": 19.0}, 999).groupBy("cls").count().collect()}
    assert sum(weighed.values()) == 999 and set(weighed) == {"big", "small"} and abs(weighed["small"] - 1900 / 5700 * 999) < 90
    assert exact(df, "id", "cls", {"gone": 1.0}).count() == 0 and exact(df.limit(0), "id", "cls").count() == 0
    assert exact(df, "id", "cls", draws=0).count() == 0
    twice = df.filter("id < 10").unionByName(df.filter("id < 10"))
    assert exact(twice, "id", "cls", draws=321).count() == 321


def test_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "cls string")
    w = {r["cls"]: r["weight"] for r in splitting.class_weights(df, "cls").collect()}
    assert w == pytest.approx({"a": 10 / 18, "b": 10 / 9, "c": 10 / 3})
    for kind in ("inverse", "balanced_norm"):
        assert sum(r["weight"] for r in splitting.class_weights(df, "cls", kind).collect()) == pytest.approx(3)


def test_split_check_finds_overlap_and_gap(spark):
    whole = spark.range(10)
    row = splitting.splits_ok([whole.filter("id < 6"), whole.filter("id between 5 and 8")], whole, "id").first()
    assert (row["part_rows"], row["whole_rows"], row["overlapping"], row["missing"]) == (10, 10, 1, 1)


# ---- distributions and evaluation --------------------------------------------------
def test_imbalance_of_published_counts(spark):
    df = spark.createDataFrame(list(PUBLISHED.items()), "cls string, n long").select(
        "cls", F.explode(F.sequence(F.lit(1), (F.col("n") / 100 + 1).cast("int"))))
    row = distribution.imbalance(df, "cls").first()
    assert row["dominant_class"] == "none" and row["rarest_class"] == "Near-full" and row["n_classes"] == 9


def test_report_with_absent_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "y int, p int")
    out = {r["cls"]: r for r in evaluation.classification_report(df, "y", "p", [0, 1, 2, 3]).collect()}
    assert (out["2"]["precision"], out["2"]["recall"], out["2"]["f1"], out["2"]["support"]) == (0, 0, 0, 1)
    assert (out["3"]["f1"], out["3"]["support"]) == (0, 0)
    assert out["1"]["precision"] == pytest.approx(2 / 3) and out["1"]["recall"] == 1.0
    assert out["macro avg"]["f1"] == pytest.approx((0.5 + 0.8) / 4)
    assert out["weighted avg"]["recall"] == pytest.approx((0.5 * 2 + 1 * 2) / 5)


def test_keyed_scores(spark):
    df = spark.createDataFrame([("m1", 0, 0), ("m1", 1, 0), ("m2", 0, 0), ("m2", 1, 1)], "m string, y int, p int")
    scores = evaluation.summary_scores(evaluation.class_scores(df, "y", "p", [0, 1], ["m"]), ["m"])
    board = evaluation.leaderboard(scores, "m", "macro_f1", 0.9).orderBy("rank").collect()
    assert [(r["m"], r["target_met"], r["is_best"]) for r in board] == [("m2", 1, 1), ("m1", 0, 0)]


@pytest.mark.parametrize("bucket", [5, 1000])
def test_average_precision(spark, bucket):
    rng = np.random.default_rng(2)
    score, truth = np.round(rng.random(80), 1), (rng.random(80) < 0.4).astype(int)
    df = spark.createDataFrame([(0, int(t), float(s)) for t, s in zip(truth, score)], "k int, t int, s double")
    want, recall = 0.0, 0.0
    for s in sorted(set(score), reverse=True):
        hit = score >= s
        now = truth[hit].sum() / truth.sum()
        want, recall = want + (now - recall) * truth[hit].mean(), now
    assert evaluation.average_precision(df, ["k"], "t", "s", bucket).first()["average_precision"] == pytest.approx(want)


def test_drift_index(spark):
    df = spark.range(4000).select((F.col("id") % 100).cast("double").alias("v"), (F.col("id") >= 2000).alias("cur"))
    assert evaluation.drift_index(df, "v", "cur").first()["psi"] < 0.01
    moved = df.withColumn("v", F.when(F.col("cur"), F.col("v") / 4).otherwise(F.col("v")))
    assert evaluation.drift_index(moved, "v", "cur").first()["psi"] > 1


def test_pseudo_labels(spark):
    scored = spark.createDataFrame([(1, 0.95), (2, 0.94)], "id int, prob double")
    labelled = spark.createDataFrame([(3,)], "id int")
    out = models.pseudo_labels(scored, labelled).collect()
    assert {(r["id"], r["origin"]) for r in out} == {(3, "label"), (1, "pseudo")}


# ---- economics --------------------------------------------------------------------
def test_published_what_if_curve(spark):
    """The first two published points give mean and slope; the third must follow."""
    (v0, p0, c0), (v1, p1, _), (v2, p2, c2) = (
        (80.0, 0.24571433915447372, 9042.698604227673), (81.0204081632653, 0.25521763025729544, 8634.535338921552),
        (82.04081632653062, 0.26495936199516185, 8226.372073615425))
    logit = lambda p: math.log(p / (1 - p))
    mean, slope = v0 + c0 / 400, (logit(p1) - logit(p0)) / (v1 - v0)
    scan = economics.whatif_scan(
        spark, [("Edge-Loc", "cmp_pressure"), ("Loc", "cmp_pressure")], {"Edge-Loc": {"cmp_pressure": 0.5}},
        {"cmp_pressure": (mean, 0.5 / slope)}, defect_rate=0.1)
    rows = {(r["defect_class"], r["step"]): r for r in scan.collect()}
    assert len(rows) == 100
    third = rows["Edge-Loc", 2]
    assert third["param_value"] == pytest.approx(v2) and third["adj_cost_usd"] == pytest.approx(c2)
    assert third["defect_prob"] == pytest.approx(p2, abs=1e-6)
    assert third["yield_gain_ref"] == 0.0 and third["yield_gain"] == pytest.approx(0.1 * (1 - third["defect_prob"]))
    assert rows["Loc", 2]["defect_prob"] == 0.0


# Published ROI rows: class, samples, monthly loss, monthly loss after, cost, payback, ROI %, 5-year value.
ROI = [
    ("Edge-Loc", 5189, 60006, 338, 34665, 0.6, 1965.5, 3545388), ("Center", 4294, 93105, 46853, 175526, 3.8, 216.2, 2599591),
    ("Edge-Ring", 9680, 125932, 67445, 6336, 0.1, 10975.5, 3502890), ("Near-full", 149, 20461, 5058, 227637, 14.8, -18.8, 696528),
    ("Donut", 555, 8023, 2335, 28619, 5.0, 138.5, 312623),
]


def test_published_roi(spark):
    rows = [(c, n / 172950, C.CLASS_META[c][2], (1 - after / (n / 172950 * C.CLASS_META[c][2] * 25e6)) * 100, float(cost))
            for c, n, _, after, cost, *_ in ROI]
    df = spark.createDataFrame(rows, "defect_class string, class_ratio double, yield_impact double, prob_reduction_pct double, adj_cost_usd double")
    out = {r["defect_class"]: r for r in economics.class_roi(df).collect()}
    for c, _, loss, after, cost, payback, roi, npv in ROI:
        r = out[c]
        assert r["current_monthly_loss_usd"] == loss and r["improved_monthly_loss_usd"] == after
        assert r["payback_months"] == pytest.approx(payback, abs=0.11)
        assert r["roi_pct"] == pytest.approx(roi, rel=2e-3, abs=0.1) and r["npv_5yr_usd"] == pytest.approx(npv, rel=1e-3)
    none = economics.class_roi(df.withColumn("prob_reduction_pct", F.lit(0.0))).first()
    assert math.isinf(none["payback_months"])
    total = economics.roi_rollup(economics.class_roi(df)).first()
    assert total["total_annual_gain"] == pytest.approx(2225961, rel=1e-4)


def test_search_improves_and_stays_in_bounds(spark):
    stats = {p: ((lo + hi) / 2, (hi - lo) / 4) for p, (lo, hi) in C.PARAM_BOUNDS.items()}
    coefficients = {"Center": {"annealing_temp": 0.5}, "Donut": {"pr_thickness_cv": 0.6, "etch_depth": 0.35}}
    found = economics.solver_record(economics.search_settings(spark, ["Center", "Donut"], coefficients, stats, candidates=3000))
    rows = found.collect()
    for r in rows:
        assert r["objective"] < 0.35 and r["optimal_prob"] < r["baseline_prob"] == 0.5
        assert all(lo <= r[p] <= hi for p, (lo, hi) in C.PARAM_BOUNDS.items())
    assert rows == economics.solver_record(
        economics.search_settings(spark, ["Center", "Donut"], coefficients, stats, candidates=3000)).collect()
    baseline = {p: s[0] for p, s in stats.items()}
    changes = economics.top_changes(found, baseline).filter("defect_class = 'Center' and rank = 1").first()
    assert changes["param"] == "annealing_temp" or abs(changes["pct"]) > 1


# ---- optimum and p-values ------------------------------------------------------------
def test_best_setting_against_random_settings(spark):
    rng = np.random.default_rng(8)
    params = ["a", "b", "c", "d"]
    stats = {"a": (10.0, 2.0), "b": (0.0, 1.0), "c": (200.0, 30.0), "d": (5.0, 0.5)}
    bounds = {"a": (4.0, 12.0), "b": (0.5, 3.0), "c": (100.0, 400.0), "d": (5.0, 5.0)}  # b starts outside, d cannot move
    cost = {"a": 20_000.0, "b": 150_000.0, "c": 900.0, "d": 10.0}
    coefs = {f"k{i}": {p: float(r) for p, r in zip(params, rng.uniform(-1, 1, 4)) if abs(r) >= 0.3} for i in range(25)} | {"none": {}}
    found = {r["defect_class"]: r for r in economics.best_settings(spark, list(coefs), coefs, stats, bounds, cost).collect()}

    def score(cls, values):
        k = coefs[cls]
        prob = 1 / (1 + np.exp(-sum(r * (values[p] - stats[p][0]) / stats[p][1] for p, r in k.items()))) if k else 0.0
        paid = sum(np.abs(values[p] - stats[p][0]) * cost[p] for p in params)
        return 0.7 * prob + 0.2 * np.minimum(paid / 1e6, 1), prob, paid

    draws = {p: np.concatenate([rng.uniform(*bounds[p], 40_000), np.full(40_000, np.clip(stats[p][0], *bounds[p]))]) for p in params}
    for p in params:
        rng.shuffle(draws[p])
    for cls, row in found.items():
        own = score(cls, {p: row[p] for p in params})
        assert np.allclose(own, (row["objective"], row["optimal_prob"], row["adj_cost_usd"]), atol=1e-9)
        assert all(lo - 1e-9 <= row[p] <= hi + 1e-9 for p, (lo, hi) in bounds.items())
        assert row["objective"] <= np.min(score(cls, draws)[0]) + 1e-12


def test_p_values(spark):
    rng = np.random.default_rng(4)
    rows = [(float(t), int(n)) for n in (1, 2, 3, 7, 30, 1000, 600_000, 10**9) for t in (0.0, 1e-9, 0.01, 0.5, 1.0, 1.7, 1.9, 2.5, 6.0, 40.0, -3.0)]
    rows += [(float(t), int(n)) for t, n in zip(rng.normal(0, 3, 60), rng.integers(1, 400, 60))]
    df = spark.createDataFrame(rows, "t double, n long").withColumn("p", correlation.two_sided_p(F.col("t"), F.col("n")))
    for r in df.collect():
        want = math.erfc(abs(r["t"]) / math.sqrt(2)) if r["n"] > 10**8 else float(K.beta_tail(np.array([r["t"]]), np.array([float(r["n"])]))[0])
        assert r["p"] == pytest.approx(want, rel=1e-6, abs=1e-12)
    odd = spark.createDataFrame([(None, 5), (float("inf"), 5), (float("-inf"), 5), (1.0, 0), (float("nan"), 5)], "t double, n long")
    assert [r[0] for r in odd.select(correlation.two_sided_p(F.col("t"), F.col("n"))).collect()] == [None, 0.0, 0.0, None, None]
