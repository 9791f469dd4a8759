"""Classifier, latency, trial and drift evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabspark.constants import CLASS_META, CLASSES, SEVERITY_INDEX
from fabspark.operators import evaluation as V
from fabspark.standins.common import ROWS_PER_BUCKET, Registry, round_all, table

R = Registry()


def labels(spark, d):
    return table(spark, d, "labels")


def events(spark, d):
    return table(spark, d, "events")


@R.add("""SELECT quality, toxic, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY quality), 6) AS row_share
  FROM labels GROUP BY 1, 2""")
def confusion(spark, d):
    return round_all(V.confusion(labels(spark, d), "quality", "toxic"))


@R.add("SELECT quality, count(*) FILTER (toxic = 0) AS pred_0, count(*) FILTER (toxic = 1) AS pred_1 FROM labels GROUP BY 1")
def confusion_matrix(spark, d):
    return V.confusion_matrix(labels(spark, d), "quality", "toxic", [0, 1])


# Class 2 is listed but never true and never predicted.
SCORES_SQL = """c(cls) AS (VALUES (0), (1), (2)), s AS (SELECT cls, count(*) FILTER (quality = cls AND toxic = cls) AS tp,
    count(*) FILTER (quality = cls) AS support, count(*) FILTER (toxic = cls) AS predicted FROM c, labels GROUP BY 1),
  f AS (SELECT cls, tp, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
    CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f1 FROM s)"""


@R.add(f"""WITH {SCORES_SQL}
  SELECT CAST(cls AS VARCHAR) AS cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f UNION ALL
  SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f UNION ALL
  SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
    round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""")
def class_report(spark, d):
    return round_all(V.classification_report(labels(spark, d), "quality", "toxic", [0, 1, 2]))


@R.add(f"""WITH {SCORES_SQL} SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS macro_precision,
  round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1, round(sum(precision * support) / sum(support), 6) AS weighted_precision,
  round(sum(recall * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
  CAST(sum(support) AS BIGINT) AS support FROM f""")
def summary_scores(spark, d):
    return round_all(V.summary_scores(V.class_scores(labels(spark, d), "quality", "toxic", [0, 1, 2])))


SEVERITY = [SEVERITY_INDEX[CLASS_META[c][0]] for c in CLASSES]
_SEV_SQL = "CASE {} " + " ".join(f"WHEN {i} THEN {k}" for i, k in enumerate(SEVERITY)) + " END"


@R.add(f"""WITH e AS (SELECT {_SEV_SQL.format('event_id % 9')} AS t, {_SEV_SQL.format('(event_id + CASE WHEN value > 60 THEN 1 ELSE 0 END) % 9')} AS p FROM events),
  k AS (SELECT s, count(*) FILTER (t = s) AS support, count(*) FILTER (p = s) AS predicted, count(*) FILTER (t = s AND p = s) AS tp FROM e, range(4) r(s) GROUP BY 1)
  SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(coalesce(2 * tp / nullif(support + predicted, 0), 0)), 6) AS macro_f1,
    round(avg(coalesce(tp / nullif(support, 0), 0)), 6) AS macro_recall, CAST(sum(support) AS BIGINT) AS support FROM k""")
def severity_scores(spark, d):
    """The second head: severity levels of true and predicted classes."""
    level = F.array(*[F.lit(k) for k in SEVERITY])
    step = F.when(F.col("value") > 60, 1).otherwise(0)
    rows = table(spark, d, "events").select(
        F.get(level, (F.col("event_id") % 9).cast("int")).alias("t"), F.get(level, ((F.col("event_id") + step) % 9).cast("int")).alias("p"))
    scores = V.summary_scores(V.class_scores(rows, "t", "p", sorted(set(SEVERITY_INDEX.values()))))
    return round_all(scores.select("accuracy", "macro_f1", "macro_recall", "support"))


@R.add("SELECT doc_id, quality, toxic FROM labels WHERE quality <> toxic")
def misclassified_rows(spark, d):
    return V.misclassified(labels(spark, d), "quality", "toxic")


@R.add("""SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_ms, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(1000 / avg(value), 6) AS throughput,
  CASE WHEN avg(value) < 50 THEN 'PASS' ELSE 'FAIL' END AS target,
  round((SELECT avg(value) FROM events WHERE event_type = 'view') / avg(value), 6) AS speedup FROM events GROUP BY 1""")
def latency_stats(spark, d):
    return round_all(V.latency_stats(events(spark, d), "event_type", "value", "view", rows_per_bucket=ROWS_PER_BUCKET))


@R.add("""SELECT event_id, coalesce(max(CASE WHEN event_type = 'purchase' THEN value END)
  OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING), 0.0) AS best_so_far FROM events""")
def running_best(spark, d):
    rows = events(spark, d).select("event_id", "value", "event_type")
    return V.running_best(rows, "event_id", "value", "event_type", "purchase", ROWS_PER_BUCKET).select("event_id", "best_so_far")


@R.add("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def trial_states(spark, d):
    return V.trial_states(events(spark, d), "event_type")


@R.add("""SELECT user_id % 3 AS batch_size, count(*) AS n, round(avg(value), 6) AS mean_value, max(value) AS best_value
  FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def trial_groups(spark, d):
    rows = events(spark, d).withColumn("batch_size", F.col("user_id") % 3)
    return round_all(V.trial_groups(rows, "batch_size", "value", "event_type", "purchase"))


@R.add("SELECT event_id, value, event_type FROM events ORDER BY value DESC, event_id LIMIT 1")
def best_trial(spark, d):
    return V.best_trial(events(spark, d), "event_id", "value", "event_type")


@R.add("SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase' ORDER BY value DESC, event_id")
def sorted_trials(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "value")
    return V.sorted_trials(rows, "event_id", "value", "event_type", "purchase")


@R.add("""SELECT event_type, round(m, 6) AS metric, CAST(row_number() OVER (ORDER BY m DESC, event_type) AS INTEGER) AS rank,
  CAST(m >= 50 AS INTEGER) AS target_met, CAST(row_number() OVER (ORDER BY m DESC, event_type) = 1 AS INTEGER) AS is_best
  FROM (SELECT event_type, avg(value) AS m FROM events GROUP BY 1)""")
def leaderboard(spark, d):
    models = events(spark, d).groupBy("event_type").agg(F.avg("value").alias("metric"))
    return round_all(V.leaderboard(models, "event_type", "metric", 50.0))


# Three labels per document: what the table holds against what its length suggests.
MULTI_SQL = """m AS (SELECT l.doc_id, l.quality AS t0, l.toxic AS t1, CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END AS t2,
    (d.n_chars - 1000) / 500.0 AS z0, (d.doc_id % 11 - 7) / 2.0 AS z1, (d.doc_id % 5 - 2) / 1.0 AS z2 FROM labels l JOIN documents d USING (doc_id)),
  b AS (SELECT *, CAST(1 / (1 + exp(-z0)) > 0.5 AS INT) AS p0, CAST(1 / (1 + exp(-z1)) > 0.5 AS INT) AS p1, CAST(1 / (1 + exp(-z2)) > 0.5 AS INT) AS p2 FROM m)"""


def multi(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    rows = labels(spark, d).join(docs, "doc_id")
    z = F.array((F.col("n_chars") - 1000) / 500.0, (F.col("doc_id") % 11 - 7) / 2.0, (F.col("doc_id") % 5 - 2) / 1.0)
    return rows.select("doc_id", F.array("quality", "toxic", F.when(F.col("lang") == "en", 1).otherwise(0)).alias("truth"),
                       z.alias("logits")).withColumn("pred", V.predict_labels(F.col("logits")))


@R.add(f"""WITH {MULTI_SQL}, w AS (SELECT *, CAST(t0 <> p0 AS INT) + CAST(t1 <> p1 AS INT) + CAST(t2 <> p2 AS INT) AS wrong,
    t0 * p0 + t1 * p1 + t2 * p2 AS tp, t0 + t1 + t2 + p0 + p1 + p2 AS size FROM b),
  g AS (SELECT count(*) AS n, sum(wrong) / (count(*) * 3) AS hl, avg(CASE WHEN wrong = 0 THEN 1.0 ELSE 0.0 END) AS sa,
    2.0 * sum(tp) / sum(size) AS micro, (2.0 * sum(t0 * p0) / sum(t0 + p0) + 2.0 * sum(t1 * p1) / sum(t1 + p1) + 2.0 * sum(t2 * p2) / sum(t2 + p2)) / 3 AS macro,
    avg(CASE WHEN size > 0 THEN 2.0 * tp / size ELSE 0.0 END) AS sample FROM w)
  SELECT n, round(hl, 6) AS hamming_loss, round(sa, 6) AS subset_accuracy, round(micro, 6) AS f1_micro, round(macro, 6) AS f1_macro, round(sample, 6) AS f1_sample FROM g""")
def multilabel_scores(spark, d):
    return round_all(V.multilabel_scores(multi(spark, d), "truth", "pred", 3))


@R.add(f"""WITH {MULTI_SQL}, l AS (SELECT 0 AS label, t0 AS t, z0 AS z FROM b UNION ALL SELECT 1, t1, z1 FROM b UNION ALL SELECT 2, t2, z2 FROM b),
  c AS (SELECT label, z, count(*) AS n, sum(t) AS hits FROM l GROUP BY 1, 2),
  u AS (SELECT *, sum(n) OVER w AS seen, sum(hits) OVER w AS found FROM c WINDOW w AS (PARTITION BY label ORDER BY z DESC ROWS UNBOUNDED PRECEDING))
  SELECT CAST(label AS INTEGER) AS label, round(sum(found / seen * hits) / sum(hits), 6) AS average_precision, CAST(sum(hits) AS BIGINT) AS positives FROM u GROUP BY 1""")
def average_precision(spark, d):
    rows = multi(spark, d).select(F.posexplode(F.arrays_zip("truth", "logits")).alias("label", "z")).select("label", "z.truth", "z.logits")
    return round_all(V.average_precision(rows, ["label"], "truth", "logits", ROWS_PER_BUCKET))


@R.add(f"""WITH {MULTI_SQL}, l AS (SELECT 0 AS label, t0 AS t, z0 AS z FROM b UNION ALL SELECT 1, t1, z1 FROM b UNION ALL SELECT 2, t2, z2 FROM b),
  c AS (SELECT label, z, count(*) AS n, sum(t) AS hits FROM l GROUP BY 1, 2),
  u AS (SELECT *, sum(n) OVER w AS seen, sum(hits) OVER w AS found FROM c WINDOW w AS (PARTITION BY label ORDER BY z DESC ROWS UNBOUNDED PRECEDING)),
  a AS (SELECT label, sum(found / seen * hits) / sum(hits) AS ap FROM u GROUP BY 1)
  SELECT round(avg(ap), 6) AS mean_average_precision, count(*) AS labels FROM a""")
def mean_average_precision(spark, d):
    rows = multi(spark, d).select(F.posexplode(F.arrays_zip("truth", "logits")).alias("label", "z")).select("label", "z.truth", "z.logits")
    return round_all(V.mean_average_precision(V.average_precision(rows, ["label"], "truth", "logits", ROWS_PER_BUCKET)))


@R.add("""WITH e AS (SELECT value, ts >= TIMESTAMP '2024-01-20' AS cur FROM events),
  q AS (SELECT DISTINCT unnest(quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM e WHERE NOT cur),
  b AS (SELECT cur, (SELECT count(*) FROM q WHERE edge <= value) AS bin FROM e),
  s AS (SELECT bin, count(*) FILTER (NOT cur) / (SELECT count(*) FROM e WHERE NOT cur) AS p, count(*) FILTER (cur) / (SELECT count(*) FROM e WHERE cur) AS c FROM b GROUP BY 1)
  SELECT round(sum((greatest(c, 1e-6) - greatest(p, 1e-6)) * ln(greatest(c, 1e-6) / greatest(p, 1e-6))), 6) AS psi, count(*) AS bins FROM s""")
def drift_index(spark, d):
    rows = events(spark, d).withColumn("current", F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    return round_all(V.drift_index(rows, "value", "current"))
