"""Classifier evaluation, latency, trial and leaderboard tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabspark.operators import ordered as O
from fabspark.operators.joins import null_safe_join


def confusion(df: DataFrame, label: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count per (label, prediction) and its share of the label's rows."""
    counts = df.groupBy(*keys, label, pred).agg(F.count("*").alias("n"))
    return counts.withColumn("row_share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys, label)))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: Sequence) -> DataFrame:
    return df.groupBy(label).agg(*[F.count_if(F.col(pred) == c).alias(f"pred_{c}") for c in classes])


def class_scores(
    df: DataFrame, label: str, pred: str, classes: Sequence, keys: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support for every listed class; 0 where undefined.

    One pass over the rows; everything after works on (label, prediction) counts.
    """
    counts = df.groupBy(*keys, label, pred).agg(F.count("*").alias("n"))
    kind = df.schema[label].dataType.simpleString()
    sides = counts.select(*keys, F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0).cast("long").alias("tp")),
        F.struct(F.col(pred).cast(kind).alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
    )).alias("s")).select(*keys, "s.*")
    # Every listed class appears, also one that is never true and never predicted.
    listed = counts.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    listed = listed.select(
        "*", F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("cls"),
        *[F.lit(0).cast("long").alias(c) for c in ("support", "predicted", "tp")],
    )
    totals = sides.unionByName(listed).filter(F.col("cls").isin(list(classes))).groupBy(*keys, "cls").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]
    )
    zero = F.lit(0.0)
    return totals.select(
        *keys, "cls", "support",
        F.coalesce(F.try_divide("tp", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted")), zero).alias("f1"),
        "tp",
    )


def summary_scores(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages from per-class scores."""
    def weighted(c: str):
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0))

    return scores.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.sum("tp"), F.sum("support")), F.lit(0.0)).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )


def classification_report(df: DataFrame, label: str, pred: str, classes: Sequence) -> DataFrame:
    """Per-class rows followed by the macro and weighted averages."""
    scores = class_scores(df, label, pred, classes)
    rows = scores.select(F.col("cls").cast("string").alias("cls"), "precision", "recall", "f1", "support")
    averages = summary_scores(scores).select(F.explode(F.array(*[
        F.struct(F.lit(f"{kind} avg").alias("cls"), *[F.col(f"{kind}_{c}").alias(c) for c in ("precision", "recall", "f1")],
                 "support")
        for kind in ("macro", "weighted")
    ])).alias("r")).select("r.*")
    return rows.unionByName(averages)


def misclassified(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.filter(F.col(pred) != F.col(label))


def latency_stats(
    df: DataFrame, runtime: str, ms: str, baseline, target_ms: float = 50.0,
    rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Mean, exact P50/P95/P99, throughput, target flag and speed-up over a baseline runtime."""
    basics = df.groupBy(runtime).agg(F.count("*").alias("n"), F.avg(ms).alias("avg_ms"))
    tails = O.exact_quantiles(df, [runtime], ms, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, rows_per_bucket)
    base = F.max(F.when(F.col(runtime) == baseline, F.col("avg_ms"))).over(Window.partitionBy())
    return null_safe_join(basics, tails, [runtime]).select(
        runtime, "n", "avg_ms", "p50", "p95", "p99",
        F.try_divide(F.lit(1000.0), F.col("avg_ms")).alias("throughput"),
        F.when(F.col("avg_ms") < target_ms, "PASS").otherwise("FAIL").alias("target"),
        F.try_divide(base, F.col("avg_ms")).alias("speedup"),
    )


def running_best(
    df: DataFrame, order_col: str, value: str, state: str, done: str = "COMPLETE",
    rows_per_bucket: int = O.ROWS_PER_BUCKET,
) -> DataFrame:
    """Best value of the completed trials so far; 0 before the first."""
    completed = F.when(F.col(state) == done, F.col(value))
    best = O.running(df, order_col, {"best_so_far": ("max", completed)}, rows_per_bucket=rows_per_bucket)
    return best.withColumn("best_so_far", F.coalesce("best_so_far", F.lit(0.0)))


def trial_states(df: DataFrame, state: str) -> DataFrame:
    return df.groupBy(state).agg(F.count("*").alias("n"))


def trial_groups(df: DataFrame, by: str, value: str, state: str, done: str = "COMPLETE") -> DataFrame:
    return df.filter(F.col(state) == done).groupBy(by).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean_value"), F.max(value).alias("best_value")
    )


def best_trial(df: DataFrame, trial: str, value: str, *keep: str) -> DataFrame:
    """The row with the highest value; the lowest trial number on ties."""
    best = F.min(F.struct((-F.col(value)).alias("v"), trial, value, *keep))
    return df.agg(best.alias("b")).select(f"b.{trial}", f"b.{value}", *[f"b.{c}" for c in keep])


def sorted_trials(df: DataFrame, trial: str, value: str, state: str, done: str = "COMPLETE") -> DataFrame:
    """All completed trials, best first; the lower trial number on ties."""
    return df.filter(F.col(state) == done).orderBy(F.desc(value), F.asc(trial))


def leaderboard(models: DataFrame, model: str, metric: str, target: float) -> DataFrame:
    """Rank per model with target flag and whether it is the best; one row per model goes in."""
    order = Window.orderBy(F.desc(metric), F.asc(model))
    return models.withColumns({
        "rank": F.row_number().over(order),
        "target_met": (F.col(metric) >= target).cast("int"),
    }).withColumn("is_best", (F.col("rank") == 1).cast("int"))


# ---- several labels per map ---------------------------------------------------------
def predict_labels(logits, threshold: float = 0.5):
    """Array of 0/1 from an array of logits."""
    return F.transform(logits, lambda x: (1 / (1 + F.exp(-x)) > threshold).cast("int"))


def multilabel_scores(df: DataFrame, truth: str, pred: str, n_labels: int) -> DataFrame:
    """Hamming loss, subset accuracy, and micro, macro and per-sample F1, in one aggregation."""
    t, p = [F.get(truth, F.lit(i)) for i in range(n_labels)], [F.get(pred, F.lit(i)) for i in range(n_labels)]
    both = [a * b for a, b in zip(t, p)]

    def row_sum(cols):
        total = F.lit(0)
        for c in cols:
            total = total + c
        return total

    def f1(tp, size):
        return F.coalesce(F.try_divide(2.0 * tp, size), F.lit(0.0))

    wrong = row_sum([(a != b).cast("int") for a, b in zip(t, p)])
    tps, sizes = [F.sum(b) for b in both], [F.sum(a) + F.sum(b) for a, b in zip(t, p)]
    return df.agg(
        F.count("*").alias("n"),
        (F.sum(wrong) / (F.count("*") * n_labels)).alias("hamming_loss"),
        F.avg((wrong == 0).cast("double")).alias("subset_accuracy"),
        f1(row_sum(tps), row_sum(sizes)).alias("f1_micro"),
        (row_sum([f1(a, b) for a, b in zip(tps, sizes)]) / n_labels).alias("f1_macro"),
        F.avg(f1(row_sum(both), row_sum(t) + row_sum(p))).alias("f1_sample"),
    )


def average_precision(
    df: DataFrame, keys: Sequence[str], truth: str, score: str, rows_per_bucket: int = O.ROWS_PER_BUCKET
) -> DataFrame:
    """Average precision per key: sum of precision times recall gain over the score thresholds.

    Rows with one score are counted together, and the counts are added up from the highest
    score down.
    """
    cuts = O.range_cuts(df, score, rows_per_bucket)
    counts = O.value_counts(df, keys, score, F.sum(F.col(truth).cast("long")).alias("hits"))
    upto = O.running(
        counts, score, {"seen": ("sum", F.col("n")), "found": ("sum", F.col("hits"))}, keys, descending=True, cuts=cuts
    )
    return upto.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.sum(F.col("found") / F.col("seen") * F.col("hits")), F.sum("hits")), F.lit(0.0))
        .alias("average_precision"),
        F.sum("hits").alias("positives"),
    )


def mean_average_precision(per_label: DataFrame) -> DataFrame:
    """One row: the mean of ``average_precision`` over the labels."""
    return per_label.agg(F.avg("average_precision").alias("mean_average_precision"), F.count("*").alias("labels"))


def drift_index(
    df: DataFrame, value: str, is_current: str, bins: int = 10, eps: float = 1e-6
) -> DataFrame:
    """Population-stability index between baseline and current rows, over baseline quantile bins."""
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    found = O.exact_quantiles(df.filter(~F.col(is_current)), [], value, probs, discrete=True).first()
    edges = sorted({float(q) for q in found or ()})  # bins - 1 numbers
    binned = O.with_buckets(df.filter(F.col(value).isNotNull()), value, edges)
    cur = F.col(is_current)
    per_bin = binned.groupBy(O.BUCKET).agg(F.count_if(~cur).alias("n_base"), F.count_if(cur).alias("n_cur"))
    everything = Window.partitionBy()
    share = {c: F.greatest(F.try_divide(F.col(c), F.sum(c).over(everything)), F.lit(eps)) for c in ("n_base", "n_cur")}
    return per_bin.withColumn("_psi", (share["n_cur"] - share["n_base"]) * F.ln(share["n_cur"] / share["n_base"])).agg(
        F.sum("_psi").alias("psi"), F.count("*").alias("bins")
    )
