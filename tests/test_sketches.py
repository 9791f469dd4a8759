"""Quantile sketches: ranks within the stated error, from rows and from merged tables."""

import numpy as np
from pyspark.sql import functions as F

from fabspark.operators import sketches, spc


def rows(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 5).alias("day"), F.when(F.col("id") % 3 > 0, "a").otherwise(None).alias("k"),
                                    F.when(F.col("id") % 50 == 0, None).otherwise((F.col("id") * 7919) % 40_009).cast("double").alias("x"),
                                    F.lit(None).cast("double").alias("none"))
    return df.withColumn("x", F.when(F.col("id") % 1000 == 1, float("nan")).otherwise(F.col("x")))


def test_merged_tables(spark):
    df, k, probs = rows(spark), 200, {"p01": 0.01, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    daily = sketches.sketch_table(df, ["day", "k"], ["x", "none"], k)
    assert daily.count() == 10 and {r["param"] for r in daily.collect()} == {"x"}
    for keys, groups in ((["k"], 2), ([], 1)):
        merged = sketches.merge_sketches(daily, keys, k)
        values = sketches.sketch_quantiles(merged, probs)
        ranks = {(r["k"] if keys else None, r["quantile"]): r for r in sketches.rank_of(df, keys, "x", values, list(probs)).collect()}
        assert len(ranks) == groups * 4 and sum(r["n"] for r in values.collect()) == df.filter("x IS NOT NULL").count()
        for (_, name), r in ranks.items():
            assert r["below"] - 4 * sketches.rank_error(k) <= probs[name] <= r["upto"] + 4 * sketches.rank_error(k)
    assert sketches.merge_sketches(daily.limit(0), ["k"], k).count() == 0


def test_group_without_values(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0), ("b", 1.0, 2.0, None), ("none", 1.0, 2.0, 3.0)], "c string, p double, q double, d double")
    out = {r["c"]: r["median_defect_density"] for r in spc.defect_process_stats(df, "c", "p", "q", "d").collect()}
    assert out == {"a": 3.0, "b": None} and np.isclose(sketches.rank_error(200), 0.0133, atol=2e-4)
