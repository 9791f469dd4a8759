"""Order operators against plain single-partition windows and numpy."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fabspark.operators import evaluation, ordered, ordered as O, spc


def frame(spark, n, series=3, seed=0, hot=0.4):
    """Ids out of order, a hot series, a NULL series, NULL readings and repeated values."""
    rng = np.random.default_rng(seed)
    ids = rng.permutation(n * 3)[:n]
    kind = np.where(rng.random(n) < hot, 0, rng.integers(0, series, n))
    rows = [
        (int(i), None if k == 2 else int(k), None if rng.random() < 0.1 else float(np.round(rng.normal(), 1)))
        for i, k in zip(ids, kind)
    ]
    return spark.createDataFrame(rows, "id long, s int, v double")


def same(a, b, key="id", tol=1e-9):
    a = {r[0]: r[1] for r in a.collect()}
    b = {r[0]: r[1] for r in b.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None) == (b[k] is None), k
        if a[k] is not None:
            assert abs(a[k] - b[k]) <= tol, (k, a[k], b[k])


@pytest.mark.parametrize("n,bucket", [(10, 4), (25, 7), (26, 25), (300, 40), (300, 5)])
@pytest.mark.parametrize("series", [[], ["s"]])
def test_rolling_equals_global_window(spark, n, bucket, series):
    df = frame(spark, n)
    ours = ordered.rolling_mean(df, "id", ["v"], 25, series, rows_per_bucket=bucket)
    w = Window.partitionBy(*(series or [F.lit(0)])).orderBy("id").rowsBetween(-24, 0)
    same(ours.select("id", "v_roll25"), df.select("id", F.avg("v").over(w)))


@pytest.mark.parametrize("bucket", [7, 1000])
def test_running_sum_and_max(spark, bucket):
    df = frame(spark, 200)
    ours = ordered.running(df, "id", {"t": ("sum", F.col("v")), "m": ("max", F.col("v"))}, ["s"], rows_per_bucket=bucket)
    w = Window.partitionBy("s").orderBy("id")
    same(ours.select("id", F.coalesce("t", F.lit(0.0))), df.select("id", F.coalesce(F.sum("v").over(w), F.lit(0.0))))
    same(ours.select("id", "m"), df.select("id", F.max("v").over(w)))


def test_running_descending(spark):
    df = frame(spark, 150)
    ours = ordered.running(df, "id", {"t": ("sum", F.lit(1))}, descending=True, rows_per_bucket=9)
    same(ours.select("id", "t"), df.select("id", F.row_number().over(Window.orderBy(F.desc("id")))))


@pytest.mark.parametrize("bucket", [11, 1000])
def test_quantiles(spark, bucket):
    df = frame(spark, 400)
    rows = ordered.exact_quantiles(df, ["s"], "v", {"a": 0.25, "b": 0.5, "c": 0.95, "z": 0.0, "o": 1.0}, bucket).collect()
    pdf = df.toPandas().dropna(subset=["v"])
    assert len(rows) == 3
    for row in rows:
        values = pdf[pdf.s.isna() if row["s"] is None else pdf.s == row["s"]].v
        assert np.allclose([row[c] for c in "abczo"], np.quantile(values, [0.25, 0.5, 0.95, 0, 1]))


def test_quantiles_of_several_columns(spark):
    df = frame(spark, 200).withColumn("w", F.col("id") * 2.0)
    out = {r["param"]: r["m"] for r in ordered.exact_quantiles(df, [], ["v", "w"], {"m": 0.5}, 20).collect()}
    pdf = df.toPandas()
    assert np.isclose(out["v"], pdf.v.median()) and np.isclose(out["w"], pdf.w.median())


def test_one_hot_value_is_kept_whole(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") < 600, 1.0).otherwise(F.col("id").cast("double")))
    out = ordered.exact_quantiles(df, [], "v", {"m": 0.5, "p": 0.9}, 50).first()
    values = [1.0] * 600 + list(range(600, 1000))
    assert np.allclose([out["m"], out["p"]], np.quantile(values, [0.5, 0.9]))


def test_top_k_with_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"))
    got = {(r["k"], r["rank"]): r["id"] for r in ordered.top_k(df, ["k"], [F.desc("id")], 4, salts=5).collect()}
    w = Window.partitionBy("k").orderBy(F.desc("id"))
    want = {(r["k"], r["rank"]): r["id"] for r in
            df.withColumn("rank", F.row_number().over(w)).filter("rank <= 4").collect()}
    assert got == want


def test_running_best_before_first_completed_trial(spark):
    df = spark.createDataFrame([(0, 0.9, "PRUNED"), (1, 0.3, "COMPLETE"), (2, 0.8, "FAIL"), (3, 0.5, "COMPLETE"), (4, 0.4, "COMPLETE")],
                               "t int, v double, state string")
    out = evaluation.running_best(df, "t", "v", "state", rows_per_bucket=2).orderBy("t").collect()
    assert [r["best_so_far"] for r in out] == [0.0, 0.3, 0.3, 0.5, 0.5]


@pytest.mark.parametrize("bucket", [6, 1000])
@pytest.mark.parametrize("weight, reach", [(0.3, None), (0.9, 40.0), (0.6, 40.0), (1.0, None), (0.001, None)])
def test_ewma_equals_recursion(spark, monkeypatch, bucket, weight, reach):
    if reach:
        monkeypatch.setattr(spc, "POWER_RANGE", reach)  # blocks of a few readings
    df = frame(spark, 160).withColumn("v", F.when(F.col("id") % 50 == 7, float("nan")).otherwise(F.col("v")))
    df = df.unionByName(spark.createDataFrame([(9_000, 9, None), (9_001, 9, None)], df.schema))
    got = {r["id"]: r["ewma"] for r in spc.ewma(df, "id", "v", ["s"], weight, bucket).collect()}
    for _, g in df.toPandas().sort_values("id").groupby("s", dropna=False):
        known = g.v.dropna()
        state = known.iloc[0] if len(known) else None
        for i, v in zip(g.id, g.v):
            if v == v:
                state = weight * v + (1 - weight) * state
            assert got[i] is None if state is None else np.isclose(got[i], state)


def test_ewma_is_expressions_only(spark):
    plan = spc.ewma(frame(spark, 50), "id", "v", ["s"], 0.2, 10)._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan


@pytest.mark.parametrize("rows", [40, 700])
def test_quantiles_with_a_failing_bracket(spark, monkeypatch, rows):
    monkeypatch.setattr(ordered, "rank_error", lambda k: 1e-4)  # brackets that miss
    df = frame(spark, 2000).withColumn("w", F.when(F.col("id") % 9 == 0, float("nan")).otherwise(F.col("id") * 1.0))
    out = {(r["s"], r["param"]): r for r in ordered.exact_quantiles(df, ["s"], ["v", "w"], {"a": 0.1, "m": 0.5, "z": 0.97}, rows).collect()}
    pdf = df.toPandas()
    assert len(out) == 6
    for (s, p), r in out.items():
        values = np.sort(pdf[pdf.s.isna() if s is None else pdf.s == s][p].dropna() if p == "v" else
                         pdf[pdf.s.isna() if s is None else pdf.s == s][p].to_numpy())
        for name, share in (("a", 0.1), ("m", 0.5), ("z", 0.97)):
            place = share * (len(values) - 1)
            low, high = values[int(np.floor(place))], values[int(np.ceil(place))]
            assert np.isclose(r[name], low + (high - low) * (place % 1), equal_nan=True)


@pytest.mark.parametrize("bucket", [5, 1000])
def test_run_rules(spark, bucket):
    trend = [0.0, 1, 2, 3, 4, 5, 6, 7, 3, 9, 9, 0]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(trend)], "id int, v double")
    out = spc.run_rules(df, "id", "v", rows_per_bucket=bucket).orderBy("id").collect()
    assert [r["rule_trend"] for r in out] == [0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0]
    jump = spark.createDataFrame([(i, 0.0 if i not in (20, 22) else 10.0) for i in range(60)], "id int, v double")
    hits = spc.run_rules(jump, "id", "v", rows_per_bucket=bucket).filter("rule_2of3 = 1").collect()
    assert [r["id"] for r in hits] == [22]
    assert {r["id"] for r in spc.run_rules(jump, "id", "v").filter("rule_3sigma = 1").collect()} == {20, 22}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_order_by_time(spark, kind):
    step = "INTERVAL '7' MINUTES" if kind != "date" else "INTERVAL '1' DAYS"
    df = spark.range(90).select("id", F.expr(f"CAST(TIMESTAMP '2024-01-01 00:00:00' + id * {step} AS {kind})").alias("t"),
                                (F.col("id") * 37 % 11).cast("double").alias("v"))
    ours = ordered.rolling_mean(df, "t", ["v"], 25, rows_per_bucket=12)
    same(ours.select("id", "v_roll25"), df.select("id", F.avg("v").over(Window.orderBy("t").rowsBetween(-24, 0))))


@pytest.mark.parametrize("kind", ["string", "bigint", "decimal(30,2)", "date", "timestamp"])
def test_ranges_agree_for_every_order_type(spark, kind):
    base = spark.range(300).select(((F.col("id") * 7919) % 300).alias("i"), (F.col("id") % 13).cast("double").alias("x"))
    keys = {
        "string": F.concat(F.lit("LOT-"), F.lpad(F.col("i").cast("string"), 6, "0")),
        "bigint": F.lit(2**60) + F.col("i"), "decimal(30,2)": F.col("i").cast(kind) / 10,
        "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("i").cast("int")),
        "timestamp": F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i")),
    }
    df = base.select(keys[kind].alias("k"), "x")
    one = O.rolling_mean(df, "k", ["x"], 25, rows_per_bucket=10_000)
    many = O.rolling_mean(df, "k", ["x"], 25, rows_per_bucket=6)
    want = {r["k"]: r["x_roll25"] for r in one.collect()}
    assert len(want) == 300 and {r["k"]: r["x_roll25"] for r in many.collect()} == pytest.approx(want)
    best = O.running(df, "k", {"s": ("sum", F.col("x"))}, rows_per_bucket=6)
    plain = df.withColumn("s", F.sum("x").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(best.select("k", "s").collect()) == sorted(plain.select("k", "s").collect())


def test_columns_without_values_or_spread(spark):
    df = spark.range(200).select("id", F.lit(None).cast("double").alias("none"), F.lit(3.0).alias("same"),
                                 (F.lit(2**60) + F.col("id")).alias("large"))
    for rows in (1_000, 7):
        out = {r["param"]: r["m"] for r in O.exact_quantiles(df.select("none", "same"), [], ["none", "same"], {"m": 0.5}, rows).collect()}
        assert out == {"same": 3.0}
        counts, _ = O.long_value_counts(df, [], ["large"], rows_per_bucket=rows)
        assert counts.count() == 200  # neighbours beyond 2^53 stay apart
