"""Labels, limits, panel rules and quality checks on edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from fabspark import dims
from fabspark.constants import CLASSES, CLASS_META, DISPLAY_CORRELATIONS, DISPLAY_PARAMS, SPC_LIMITS
from fabspark.functions import labels, limits, risk
from fabspark.operators import quality, reports, spc


def test_label_cells(spark):
    cells = [[], [[]], [["none"]], None, [["Edge-Ring"]], [[""]], [[None]]]
    df = spark.createDataFrame([(c,) for c in cells], "c array<array<string>>")
    got = [r[0] for r in df.select(labels.first_label(F.col("c"))).collect()]
    assert got == ["unknown", "unknown", "none", "unknown", "Edge-Ring", "unknown", "unknown"]


def test_label_codes(spark):
    df = spark.createDataFrame([(c,) for c in [*CLASSES, "unknown", None]], "c string")
    idx = labels.encode_label(F.col("c"))
    rows = df.select(idx.alias("i"), labels.decode_label(idx).alias("back")).collect()
    assert [r["i"] for r in rows] == [*range(9), None, None]
    assert [r["back"] for r in rows] == [*CLASSES, None, None]
    known, unknown = labels.split_labelled(df.na.drop(), "c")
    assert known.count() == 9 and unknown.count() == 1
    assert labels.keep_known_classes(df, "c").count() == 9


def test_out_of_control_edges(spark):
    values = [80.0, 120.0, 79.999, 120.001, None, float("nan"), float("inf"), 100.0]
    df = spark.createDataFrame([(v,) for v in values], "cmp_pressure double")
    flagged = limits.with_ooc_flags(df).collect()
    assert [r["cmp_pressure_ooc"] for r in flagged] == [0, 0, 1, 1, 0, 0, 1, 0]
    rows = spark.createDataFrame([(None, None), (0, None), (None, 1), (0, 0)], "a int, b int")
    assert [r[0] for r in rows.select(limits.any_ooc(["a", "b"])).collect()] == [0, 0, 1, 0]


def test_cpk_of_small_groups(spark):
    df = spark.createDataFrame(
        [("one", 1.0), ("flat", 2.0), ("flat", 2.0), ("two", 1.0), ("two", 3.0), ("empty", None)], "c string, v double")
    out = {r["c"]: r["cpk_v"] for r in spc.spc_summary(df, "c", None, {"v": (0.0, 4.0)}, "one").collect()}
    assert out["one"] is None and out["empty"] is None
    assert out["flat"] == pytest.approx(2.0 / 1e-9)
    assert out["two"] == pytest.approx(2.0 / (3 * math.sqrt(2) + 1e-9))


def test_status_bands(spark):
    df = spark.createDataFrame([(80.0,), (120.0,), (121.0,), (130.0,), (131.0,), (60.0,)], "v double")
    assert [r[0] for r in df.select(limits.param_status(F.col("v"), 80.0, 120.0)).collect()] == [
        "ok", "ok", "warn", "warn", "crit", "crit"]
    alerts = spark.createDataFrame([(16.0, 100.0), (1.0, 126.0), (11.0, 0.0), (0.0, 116.0), (10.0, 115.0)], "p double, c double")
    assert [r[0] for r in alerts.select(limits.alert_status(F.col("p"), F.col("c"))).collect()] == [
        "CRITICAL", "CRITICAL", "WARNING", "WARNING", "OK"]
    cpks = spark.createDataFrame([(0.9,), (1.0,), (1.33,)], "x double")
    assert [r[0] for r in cpks.select(limits.cpk_alarm(F.col("x"))).collect()] == ["CRITICAL", "WARNING", "OK"]
    assert [r[0] for r in cpks.select(limits.cpk_band(F.col("x"))).collect()] == ["poor", "marginal", "good"]


def panel(settings):
    """Plain arithmetic for one panel state."""
    probs = {}
    for cls, coefs in DISPLAY_CORRELATIONS.items():
        s = sum(r * (settings[p] - DISPLAY_PARAMS[p][4]) / DISPLAY_PARAMS[p][5] for p, r in coefs.items() if settings.get(p) is not None)
        probs[cls] = max(0.0, (1 / (1 + math.exp(-s)) - 0.5) * 2)
    return probs


SETTINGS = [
    dict(cmp_pressure=100.0, polish_time=40.0, slurry_ph=6.5, annealing_temp=1100.0, temp_gradient=1.0, etch_depth=500.0,
         vacuum_pressure=1.0, pr_thickness_cv=1.8, particle_count=5.0),
    dict(cmp_pressure=130.0, polish_time=13.0, slurry_ph=3.5, annealing_temp=1100.0, temp_gradient=1.0, etch_depth=500.0,
         vacuum_pressure=1.0, pr_thickness_cv=1.8, particle_count=5.0),
    dict(cmp_pressure=130.0, polish_time=11.0, slurry_ph=3.1, annealing_temp=1185.0, temp_gradient=2.8, etch_depth=556.0,
         vacuum_pressure=1.2, pr_thickness_cv=3.5, particle_count=24.0),
    dict(cmp_pressure=None, polish_time=75.0, slurry_ph=6.5, annealing_temp=1100.0, temp_gradient=1.0, etch_depth=500.0,
         vacuum_pressure=1.0, pr_thickness_cv=1.8, particle_count=5.0),
]


def test_panel(spark):
    cols = list(SETTINGS[0])
    df = spark.createDataFrame([(i, *[s[c] for c in cols]) for i, s in enumerate(SETTINGS)],
                               "i int, " + ", ".join(f"{c} double" for c in cols))
    probs = risk.panel_probabilities()
    loss = risk.total_yield_loss(probs, {c: CLASS_META[c][2] for c in probs})
    dominant = risk.dominant_class(probs)
    out = df.select("i", F.struct(*[p.alias(c) for c, p in probs.items()]).alias("p"), dominant.alias("dominant"),
                    loss.alias("loss"), risk.estimated_yield_pct(loss).alias("y"),
                    risk.stage_risk(dominant, probs, ["Edge-Loc", "Scratch"]).alias("cmp")).orderBy("i").collect()
    for row, settings in zip(out, SETTINGS):
        want = panel(settings)
        assert row["p"].asDict() == pytest.approx(want)
        assert row["loss"] == pytest.approx(min(sum(CLASS_META[c][2] * p for c, p in want.items()), 0.99))
        assert row["y"] == pytest.approx(max(1.0, (1 - row["loss"]) * 100))
    assert [r["dominant"] for r in out] == ["none", "Edge-Loc", "Near-full", "Scratch"]
    assert [r["cmp"] for r in out] == ["", "crit", "warn", "crit"]


def test_quality(spark):
    df = spark.createDataFrame([(1, "none", 64), (2, None, 64), (3, "odd", 63)], "id int, c string, rows int")
    rules = [quality.exists("id"), quality.exists("lot"), quality.not_null("c"), quality.between("rows", 64, 64),
             quality.in_set("c", CLASSES), quality.not_null("gone")]
    out = {r["rule"]: (r["violations"], r["passed"]) for r in quality.quality_report(df, rules, (1, 2)).collect()}
    assert out == {"id_exists": (0, 1), "lot_exists": (3, 0), "c_not_null": (1, 0), "rows_between": (1, 0),
                   "c_in_set": (1, 0), "gone_not_null": (3, 0), "row_count_between": (0, 0)}
    good, bad = quality.quarantine(df, rules[2:5])
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: r["violations"] for r in bad.collect()} == {2: ["c_not_null"], 3: ["rows_between", "c_in_set"]}
    with pytest.raises(ValueError, match="lot"):
        quality.require_columns(df, ["id", "lot"])


def test_dimensions(spark):
    dim = dims.class_dim(spark)
    assert dim.count() == 9 and dims.param_limits(spark).filter("limit_set = 'spc'").count() == len(SPC_LIMITS)
    assert dims.stage_relevance(spark).count() == 80 and dims.param_cost(spark).count() == 9
    detected = spark.createDataFrame([("Center",), ("none",), ("Scratch",), ("Center",)], "failure_type string")
    order = reports.severity_report(spark, detected, "failure_type").orderBy("priority").collect()
    assert [(r["failure_type"], r["n"]) for r in order] == [("Center", 2), ("Scratch", 1)]
    assert order[0]["yield_loss_pct"] == pytest.approx(0.5 * 0.15 * 100)
    targets = reports.with_targets(spark, detected.distinct(), "failure_type").collect()
    assert {r["failure_type"]: (r["severity_idx"], r["confidence"]) for r in targets} == {
        "Center": (0, 1.0), "none": (3, 0.0), "Scratch": (2, 0.4)}
    with pytest.raises(ValueError, match="odd"):
        reports.require_known(spark, spark.createDataFrame([("odd",)], "failure_type string"), "failure_type")


def test_missing_reading_has_no_status(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (9.0,), (2.2,)], "x double")
    got = [r[0] for r in rows.select(limits.param_status(F.col("x"), 0.0, 2.0)).collect()]
    assert got == ["ok", None, None, "crit", "warn"]
