"""Flags, joins, distributions, windows, limits and set checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fabspark.functions import labels as L
from fabspark.functions import limits as lim
from fabspark.operators import distribution as D
from fabspark.operators import lots, ordered, quality, sketches, spc, splitting
from fabspark.session import settled, shared_dir
from fabspark.sources import readers, writers
from fabspark.standins.common import (
    EVENT_TYPES, FLAGS, LIMITS, PARAMS, ROWS_PER_BUCKET, SPLIT_SQL, Registry, round_all, rounded,
    split_by_rule, table,
)

R = Registry()
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)


def _flag_sql(p):
    lo, hi = LIMITS[p]
    return f"CASE WHEN {p} < {lo} OR {p} > {hi} THEN 1 ELSE 0 END"


FLAGS_SQL = ", ".join(f"CAST({_flag_sql(p)} AS INTEGER) AS {p}_ooc" for p in PARAMS)
CPK_SQL = ", ".join(
    f"round(least(({hi} - avg({p})) / (3 * stddev_samp({p}) + 1e-9), "
    f"(avg({p}) - {lo}) / (3 * stddev_samp({p}) + 1e-9)), 6) AS cpk_{p}"
    for p, (lo, hi) in LIMITS.items()
)


def lineitem(spark, d):
    return table(spark, d, "lineitem")


def events(spark, d):
    return table(spark, d, "events")


@R.add(f"SELECT {KEY_SQL}, {FLAGS_SQL}, CAST(greatest({', '.join(_flag_sql(p) for p in PARAMS)}) AS INTEGER) AS any_ooc FROM lineitem")
def ooc_flags(spark, d):
    flagged = lim.with_ooc_flags(lineitem(spark, d), LIMITS)
    flags = [f"{p}_ooc" for p in PARAMS]
    return flagged.select(*KEY, *flags, lim.any_ooc(flags).alias("any_ooc"))


@R.add("SELECT " + ", ".join(f"CAST(sum({_flag_sql(p)}) AS BIGINT) AS {p}_ooc" for p in PARAMS) + " FROM lineitem")
def ooc_totals(spark, d):
    return D.ooc_totals(lim.with_ooc_flags(lineitem(spark, d), LIMITS), [f"{p}_ooc" for p in PARAMS])


@R.add("""SELECT d.doc_id, d.n_chars, l.quality, CAST(coalesce(l.toxic, 0) AS INTEGER) AS any_flag,
  coalesce(CASE WHEN l.quality = 1 THEN 'val' WHEN l.quality = 0 THEN 'test' END, 'train') AS split
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def partial_left_join_fill(spark, d):
    labels = table(spark, d, "labels")
    manifest = labels.select("doc_id", F.when(F.col("quality") == 1, "val").otherwise("test").alias("split"))
    docs = table(spark, d, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left")
    return readers.with_split(docs, manifest, "doc_id").select(
        "doc_id", "n_chars", "quality", lim.any_ooc(["toxic"]).alias("any_flag"), "split"
    )


@R.add("""SELECT o.o_orderpriority, count(*) AS n, round(avg(l.l_quantity), 4) AS avg_quantity,
  round(avg(l.l_extendedprice), 4) AS avg_price, round(avg(o.o_totalprice), 4) AS avg_total
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def inner_join_class_stats(spark, d):
    joined = lineitem(spark, d).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.avg("l_quantity").alias("avg_quantity"),
        F.avg("l_extendedprice").alias("avg_price"), F.avg("o_totalprice").alias("avg_total"),
    ), 4, "avg_quantity", "avg_price", "avg_total")


@R.add("""SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value,
  round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM events GROUP BY event_type""")
def class_distribution(spark, d):
    return round_all(D.class_distribution(events(spark, d), "event_type", {"avg_value": "value"}))


@R.add("""SELECT event_type, n, round(100.0 * n / sum(n) OVER (), 6) AS pct,
  round(100.0 * sum(n) OVER (ORDER BY n DESC, event_type ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 6) AS cum_pct
  FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""")
def cumulative_share(spark, d):
    counts = D.class_distribution(events(spark, d), "event_type")
    return round_all(D.cumulative_share(counts, [F.desc("n"), F.asc("event_type")]))


@R.add("""SELECT max(n) AS max_n, min(n) AS min_n, round(max(n) / min(n), 6) AS imbalance_ratio,
  (SELECT source FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 1) AS dominant_class,
  (SELECT source FROM documents GROUP BY 1 ORDER BY count(*), source LIMIT 1) AS rarest_class,
  count(*) AS n_classes FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)""")
def imbalance(spark, d):
    return round_all(D.imbalance(table(spark, d, "documents"), "source"))


@R.add("SELECT lang, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) < (SELECT 0.2 * count(*) FROM documents)")
def rare_classes(spark, d):
    docs = table(spark, d, "documents")
    return D.rare_classes(docs, "lang", 0.2 * docs.count())


@R.add("""SELECT count(*) AS total, count(l.doc_id) AS labelled, count(*) - count(l.doc_id) AS unlabelled,
  round(100.0 * count(l.doc_id) / count(*), 6) AS labelled_pct
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def label_coverage(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    label = F.coalesce(F.col("quality").cast("string"), F.lit("unknown"))
    return round_all(D.label_coverage(joined.withColumn("label", label), "label"))


@R.add(f"""SELECT l_returnflag, count(*) AS wafer_count, count(*) FILTER (l_returnflag <> 'N') AS defect_count,
  round(avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END), 6) AS defect_rate,
  round(avg(l_discount), 6) AS avg_defect_density, {CPK_SQL} FROM lineitem GROUP BY 1""")
def spc_summary(spark, d):
    return round_all(spc.spc_summary(lineitem(spark, d), "l_returnflag", "l_discount", LIMITS, "N"))


@R.add("""SELECT l_suppkey, count(*) AS wafer_count, count(*) FILTER (l_returnflag <> 'N') AS defect_count,
  round(avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END), 6) AS defect_rate,
  CASE WHEN least((45 - avg(l_quantity)) / (3 * stddev_samp(l_quantity) + 1e-9),
                  (avg(l_quantity) - 5) / (3 * stddev_samp(l_quantity) + 1e-9)) < 1.0 THEN 'CRITICAL'
       WHEN least((45 - avg(l_quantity)) / (3 * stddev_samp(l_quantity) + 1e-9),
                  (avg(l_quantity) - 5) / (3 * stddev_samp(l_quantity) + 1e-9)) < 1.33 THEN 'WARNING'
       ELSE 'OK' END AS spc_status
  FROM lineitem GROUP BY 1""")
def cpk_alarm_by_lot(spark, d):
    quantity = F.col("l_quantity")
    bad = F.col("l_returnflag") != "N"
    return round_all(lineitem(spark, d).groupBy("l_suppkey").agg(
        F.count("*").alias("wafer_count"), F.count_if(bad).alias("defect_count"),
        F.avg(bad.cast("double")).alias("defect_rate"),
        lim.cpk_alarm(lim.cpk(F.avg(quantity), F.stddev_samp(quantity), 5.0, 45.0)).alias("spc_status"),
    ))


@R.add("""SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_cmp, round(stddev_samp(value), 6) AS std_cmp,
  round(avg(user_id), 6) AS avg_particles, quantile_disc(value, 0.5) AS median_defect_density,
  quantile_disc(value, 0.95) AS p95_defect_density FROM events WHERE event_type <> 'view' GROUP BY 1""")
def defect_process_stats(spark, d):
    out = spc.defect_process_stats(
        events(spark, d), "event_type", "value", "user_id", "value", "view", exact=True, rows_per_bucket=ROWS_PER_BUCKET)
    return rounded(out, 6, "avg_cmp", "std_cmp", "avg_particles")


@R.add("""WITH s AS (SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_cmp, round(stddev_samp(value), 6) AS std_cmp,
    round(avg(user_id), 6) AS avg_particles FROM events WHERE event_type <> 'view' GROUP BY 1)
  SELECT s.*, quantile, true AS within FROM s, (VALUES ('median_defect_density'), ('p95_defect_density')) q(quantile)""")
def defect_process_stats_approx(spark, d):
    """The percentiles come from sketches and differ between runs; their ranks, counted here, must not be off by more than stated."""
    defects = events(spark, d).filter("event_type <> 'view'")
    stats, _ = settled(spc.defect_process_stats(events(spark, d), "event_type", "value", "user_id", "value", "view"))
    probs = {"median_defect_density": 0.5, "p95_defect_density": 0.95}
    ranks = sketches.rank_of(defects, ["event_type"], "value", stats, list(probs))
    return rounded(stats.drop(*probs).join(within_error(ranks, probs, sketches.SIZE), "event_type"), 6, "avg_cmp", "std_cmp", "avg_particles")


def within_error(ranks, probs, k):
    """The rows of ``rank_of`` with ``within``: the wanted share lies in the value's ranks, four errors around."""
    share = F.create_map(*[x for name, p in probs.items() for x in (F.lit(name), F.lit(p))])[F.col("quantile")]
    margin = 4 * sketches.rank_error(k)
    return ranks.withColumn("within", (share >= F.col("below") - margin) & (share <= F.col("upto") + margin)).drop("below", "upto")


@R.add("""SELECT event_type, quantile, n, true AS within FROM (SELECT event_type, count(value) AS n FROM events GROUP BY 1),
  (VALUES ('q05'), ('q50'), ('q95')) q(quantile)""")
def sketch_quantiles(spark, d):
    """Quantiles of sketches that were made and stored per day, then merged over all days."""
    probs, size = {"q05": 0.05, "q50": 0.5, "q95": 0.95}, 400
    rows = events(spark, d).withColumn("day", F.to_date("ts"))
    folder = f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}"
    writers.write_table(sketches.sketch_table(rows, ["day", "event_type"], ["value"], size), folder)
    merged = sketches.merge_sketches(spark.read.parquet(folder), ["event_type"], size)
    values, _ = settled(sketches.sketch_quantiles(merged, probs))
    ranks = sketches.rank_of(rows, ["event_type"], "value", values, list(probs))
    return within_error(ranks, probs, size).join(values.select("event_type", "n"), "event_type")


@R.add("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95
  FROM events GROUP BY 1""")
def class_percentiles(spark, d):
    return round_all(ordered.exact_quantiles(
        events(spark, d), ["event_type"], "value", {"median": 0.5, "p95": 0.95}, ROWS_PER_BUCKET))


@R.add("""WITH m AS (SELECT event_type, avg(value) AS mu FROM events GROUP BY 1),
  c AS (SELECT e.event_type, count(*) AS n, any_value(mu) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
    avg((value - mu) ** 2) AS m2, avg((value - mu) ** 3) AS m3, avg((value - mu) ** 4) AS m4
    FROM events e JOIN m ON e.event_type = m.event_type GROUP BY 1)
  SELECT event_type, n, round(mean, 5) AS mean, round(std, 5) AS std, min, max,
    round(m3 / m2 ** 1.5, 5) AS skew, round(m4 / m2 ** 2 - 3, 5) AS kurt FROM c""")
def class_moments(spark, d):
    return rounded(D.class_moments(events(spark, d), "event_type", "value"), 5, "mean", "std", "skew", "kurt")


@R.add(f"SELECT {SPLIT_SQL} AS split, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def split_class_counts(spark, d):
    return D.two_key_counts(events(spark, d).withColumn("split", split_by_rule(F.col("event_id"))), "split", "event_type")


@R.add(f"""SELECT event_type, count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'val') AS val,
  count(*) FILTER (s = 'test') AS test FROM (SELECT event_type, {SPLIT_SQL} AS s FROM events) GROUP BY 1""")
def split_pivot(spark, d):
    tagged = events(spark, d).withColumn("split", split_by_rule(F.col("event_id")))
    return D.pivot_counts(tagged, "event_type", "split", ["train", "val", "test"])


@R.add("""SELECT event_id, round(avg(value) OVER (ORDER BY event_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS value_roll25,
  round(avg(user_id) OVER (ORDER BY event_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS user_id_roll25 FROM events""")
def rolling25(spark, d):
    rows = events(spark, d).select("event_id", "value", "user_id")
    rolled = ordered.rolling_mean(rows, "event_id", ["value", "user_id"], 25, rows_per_bucket=ROWS_PER_BUCKET)
    return round_all(rolled.select("event_id", "value_roll25", "user_id_roll25"))


@R.add("""SELECT event_id, event_type, round(avg(value) OVER (PARTITION BY event_type ORDER BY event_id
  ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS value_roll25 FROM events""")
def rolling25_by_class(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "value")
    rolled = ordered.rolling_mean(rows, "event_id", ["value"], 25, ["event_type"], ROWS_PER_BUCKET)
    return round_all(rolled.select("event_id", "event_type", "value_roll25"))


@R.add(f"""SELECT split, event_type, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY n DESC, event_type) AS rank FROM (
    SELECT {SPLIT_SQL} AS split, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE rank <= 3""")
def top_classes_per_split(spark, d):
    tagged = events(spark, d).withColumn("split", split_by_rule(F.col("event_id")))
    return D.top_classes(tagged, ["split"], "event_type", 3)


@R.add(f"""SELECT l_returnflag, {KEY_SQL}, l_extendedprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, {KEY_SQL}) AS rank
  FROM lineitem) WHERE rank <= 5""")
def top_per_group(spark, d):
    rows = lineitem(spark, d).select("l_returnflag", *KEY, "l_extendedprice")
    return ordered.top_k(rows, ["l_returnflag"], [F.desc("l_extendedprice"), *[F.asc(k) for k in KEY]], 5)


@R.add(f"SELECT {KEY_SQL}, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag <> 'N' ORDER BY {KEY_SQL} LIMIT 500")
def ordered_limit(spark, d):
    return spc.anomalies(lineitem(spark, d).select(*KEY, "l_quantity", "l_returnflag"),
                         F.col("l_returnflag") != "N", [F.asc(k) for k in KEY], 500)


@R.add("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def semi_valid(spark, d):
    valid = table(spark, d, "customer").filter(F.col("c_acctbal") > 0)
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(
        valid, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@R.add("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_missing(spark, d):
    return quality.unknown_keys(table(spark, d, "documents"), "doc_id", table(spark, d, "labels"))


@R.add("""SELECT 'part' AS origin, l_returnflag AS cls, count(*) AS n FROM lineitem GROUP BY 2 UNION ALL
  SELECT 'event' AS origin, event_type AS cls, count(*) AS n FROM events GROUP BY 2""")
def union_tagged(spark, d):
    a = lineitem(spark, d).groupBy(F.col("l_returnflag").alias("cls")).agg(F.count("*").alias("n"))
    b = events(spark, d).groupBy(F.col("event_type").alias("cls")).agg(F.count("*").alias("n"))
    return a.withColumn("origin", F.lit("part")).unionByName(b.withColumn("origin", F.lit("event"))).select("origin", "cls", "n")


@R.add("""SELECT count(*) AS part_rows, count(*) AS whole_rows, CAST(0 AS BIGINT) AS overlapping,
  CAST(0 AS BIGINT) AS missing FROM events""")
def split_disjoint(spark, d):
    """Parts come from the exact stratified split, so this checks that it is a partition."""
    rows = events(spark, d).select("event_id", "event_type")
    tagged = splitting.stratified_split(rows, "event_id", "event_type")
    parts = [tagged.filter(F.col("split") == s) for s in ("train", "val", "test")]
    return splitting.splits_ok(parts, rows, "event_id")


@R.add(f"""SELECT {KEY_SQL}, CASE WHEN l_quantity > 45 OR l_extendedprice > 95000 THEN 'CRITICAL'
  WHEN l_quantity > 40 OR l_extendedprice > 85000 THEN 'WARNING' ELSE 'OK' END AS spc_status
  FROM lineitem WHERE l_returnflag <> 'N'""")
def alert_case(spark, d):
    status = lim.alert_status(F.col("l_quantity"), F.col("l_extendedprice"),
                              {"CRITICAL": (45.0, 95000.0), "WARNING": (40.0, 85000.0)})
    return spc.spc_alerts(lineitem(spark, d), status, "l_returnflag", "N").select(*KEY, "spc_status")


@R.add(f"""SELECT {KEY_SQL}, l_returnflag, l_extendedprice, l_quantity FROM lineitem
  WHERE l_returnflag <> 'N' AND (l_extendedprice > 90000 OR l_quantity > 45)
  ORDER BY l_quantity DESC, {KEY_SQL} LIMIT 50""")
def alert_topk(spark, d):
    hit = (F.col("l_returnflag") != "N") & ((F.col("l_extendedprice") > 90000) | (F.col("l_quantity") > 45))
    return spc.anomalies(lineitem(spark, d).select(*KEY, "l_returnflag", "l_extendedprice", "l_quantity"),
                         hit, [F.desc("l_quantity"), *[F.asc(k) for k in KEY]], 50)


RANGES = {"l_quantity": (10.0, 40.0), "l_extendedprice": (20000.0, 80000.0), "l_discount": (0.02, 0.08)}


def _status_sql(p):
    lo, hi = RANGES[p]
    return (f"CASE WHEN {p} BETWEEN {lo} AND {hi} THEN 'ok' "
            f"WHEN greatest({lo} - {p}, {p} - {hi}, 0) / (({hi} - {lo}) * 0.5 + 1e-9) > 0.5 THEN 'crit' ELSE 'warn' END")


STATUS_SQL = " UNION ALL ".join(
    f"SELECT {KEY_SQL}, '{p}' AS param, {p} + 0.0 AS value, {_status_sql(p)} AS status FROM lineitem" for p in RANGES
)


@R.add(f"SELECT param, status, count(*) AS n, round(avg(value), 6) AS avg_value FROM ({STATUS_SQL}) GROUP BY 1, 2")
def param_status(spark, d):
    long = lineitem(spark, d).select(F.explode(lim.status_array(RANGES)).alias("s")).select("s.*")
    return round_all(long.groupBy("param", "status").agg(F.count("*").alias("n"), F.avg("value").alias("avg_value")))


def _alarm_sql(p):
    return f"CASE WHEN {_status_sql(p)} <> 'ok' THEN '{p}:' || {_status_sql(p)} END"


ALARMS_SQL = ", ".join(_alarm_sql(p) for p in sorted(RANGES))


@R.add(f"""SELECT {KEY_SQL}, CAST(len(list_filter([{ALARMS_SQL}], lambda x: x IS NOT NULL)) AS BIGINT) AS n_alarms,
  concat_ws(',', {ALARMS_SQL}) AS alarms FROM lineitem WHERE concat_ws(',', {ALARMS_SQL}) <> ''""")
def alarm_list(spark, d):
    alarms = F.array_sort(F.filter(lim.status_array(RANGES), lambda s: s["status"] != "ok"))
    return lineitem(spark, d).select(*KEY, alarms.alias("a")).filter(F.size("a") > 0).select(
        *KEY, F.size("a").cast("long").alias("n_alarms"),
        F.array_join(F.transform("a", lambda s: F.concat_ws(":", s["param"], s["status"])), ",").alias("alarms"),
    )


BOX_SQL = " UNION ALL ".join(
    f"SELECT l_returnflag, '{p}' AS param, {p} + 0.0 AS value FROM lineitem" for p in PARAMS
)


@R.add(f"""WITH v AS ({BOX_SQL}), q AS (SELECT l_returnflag, param, quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM v GROUP BY 1, 2)
  SELECT l_returnflag, param, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
    round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
    round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
    count(*) FILTER (NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
  FROM v JOIN q USING (l_returnflag, param) GROUP BY 1, 2""")
def box_stats(spark, d):
    return round_all(D.box_stats(lineitem(spark, d), PARAMS, ["l_returnflag"]))


@R.add(f"""WITH v AS ({BOX_SQL}) SELECT param, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75 FROM v GROUP BY 1""")
def describe_params(spark, d):
    return round_all(D.describe(lineitem(spark, d), PARAMS))


@R.add("SELECT " + ", ".join(f"round(avg({p}), 6) AS {p}" for p in PARAMS)
       + ", round(avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END), 6) AS defect_rate FROM lineitem")
def param_baseline(spark, d):
    return round_all(D.param_baseline(lineitem(spark, d), PARAMS, F.col("l_returnflag") != "N"))


@R.add("""WITH s AS (SELECT l_linenumber AS map_rows, CAST(l_quantity AS INTEGER) AS map_cols FROM lineitem)
  SELECT count(DISTINCT (map_rows, map_cols)) AS n_shapes,
    min(map_rows) AS map_rows_min, max(map_rows) AS map_rows_max, round(avg(map_rows), 6) AS map_rows_mean, quantile_cont(map_rows, 0.5) AS map_rows_median,
    min(map_cols) AS map_cols_min, max(map_cols) AS map_cols_max, round(avg(map_cols), 6) AS map_cols_mean, quantile_cont(map_cols, 0.5) AS map_cols_median
  FROM s""")
def shape_summary(spark, d):
    shapes = lineitem(spark, d).select(F.col("l_linenumber").alias("map_rows"), F.col("l_quantity").cast("int").alias("map_cols"))
    return round_all(D.shape_summary(shapes, "map_rows", "map_cols"))


@R.add("""SELECT l_linenumber AS map_rows, CAST(l_quantity AS INTEGER) AS map_cols, count(*) AS n FROM lineitem
  GROUP BY 1, 2 ORDER BY n DESC, map_rows, map_cols LIMIT 10""")
def top_shapes(spark, d):
    shapes = lineitem(spark, d).select(F.col("l_linenumber").alias("map_rows"), F.col("l_quantity").cast("int").alias("map_cols"))
    return D.shape_counts(shapes, "map_rows", "map_cols").orderBy(F.desc("n"), "map_rows", "map_cols").limit(10)


@R.add("""SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 END AS INTEGER) AS class_idx,
  CASE WHEN event_type IN ('click', 'error', 'purchase') THEN event_type END AS decoded,
  CAST(event_type <> 'view' AS INTEGER) AS is_defect FROM events WHERE event_type <> 'signup'""")
def label_encoding(spark, d):
    known = L.keep_known_classes(events(spark, d), "event_type", [c for c in EVENT_TYPES if c != "signup"])
    idx = L.encode_label(F.col("event_type"), ["click", "error", "purchase"])
    return known.select(
        "event_id", idx.alias("class_idx"), L.decode_label(idx, ["click", "error", "purchase"]).alias("decoded"),
        (F.col("event_type") != "view").cast("int").alias("is_defect"),
    )


@R.add("""SELECT label, count(*) AS n FROM (SELECT CASE WHEN event_id % 7 = 0 OR event_id % 7 = 1 OR event_id % 7 = 2 THEN 'unknown'
  ELSE event_type END AS label FROM events) GROUP BY 1""")
def nested_labels(spark, d):
    """Label cells as nested arrays: some missing, some empty, some holding an empty array."""
    k = F.col("event_id") % 7
    empty = F.array().cast("array<array<string>>")
    cell = (
        F.when(k == 0, F.lit(None).cast("array<array<string>>")).when(k == 1, empty)
        .when(k == 2, F.array(F.array().cast("array<string>"))).otherwise(F.array(F.array("event_type")))
    )
    labelled = events(spark, d).withColumn("label", L.first_label(cell))
    return labelled.groupBy("label").agg(F.count("*").alias("n"))


@R.add("""SELECT 'o_orderkey_exists' AS rule, count(*) AS n_rows, CAST(0 AS BIGINT) AS violations, 1 AS passed FROM orders UNION ALL
  SELECT 'o_orderdate_not_null', count(*), count(*) - count(o_orderdate), CAST(count(*) = count(o_orderdate) AS INTEGER) FROM orders UNION ALL
  SELECT 'o_totalprice_between', count(*), count(*) FILTER (NOT (o_totalprice BETWEEN 5000 AND 400000)),
    CAST(count(*) FILTER (NOT (o_totalprice BETWEEN 5000 AND 400000)) = 0 AS INTEGER) FROM orders UNION ALL
  SELECT 'o_orderstatus_in_set', count(*), count(*) FILTER (o_orderstatus NOT IN ('O', 'F')),
    CAST(count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) = 0 AS INTEGER) FROM orders UNION ALL
  SELECT 'lot_id_exists', count(*), count(*), 0 FROM orders UNION ALL
  SELECT 'row_count_between', count(*), CAST(0 AS BIGINT), CAST(count(*) BETWEEN 1 AND 1000000000000 AS INTEGER) FROM orders""")
def quality_report(spark, d):
    rules = [
        quality.exists("o_orderkey"), quality.not_null("o_orderdate"), quality.between("o_totalprice", 5000, 400000),
        quality.in_set("o_orderstatus", ["O", "F"]), quality.exists("lot_id"),
    ]
    return quality.quality_report(table(spark, d, "orders"), rules, (1, 10**12))


@R.add("""SELECT o_orderkey, CASE WHEN o_totalprice NOT BETWEEN 5000 AND 400000 AND o_orderstatus NOT IN ('O', 'F')
    THEN 'o_totalprice_between,o_orderstatus_in_set' WHEN o_orderstatus NOT IN ('O', 'F') THEN 'o_orderstatus_in_set'
    ELSE 'o_totalprice_between' END AS violations
  FROM orders WHERE o_totalprice NOT BETWEEN 5000 AND 400000 OR o_orderstatus NOT IN ('O', 'F')""")
def quarantine_rows(spark, d):
    rules = [quality.between("o_totalprice", 5000, 400000), quality.in_set("o_orderstatus", ["O", "F"])]
    _, bad = quality.quarantine(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), rules)
    return bad.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@R.add("""WITH g AS (SELECT l_orderkey, l_returnflag, avg(l_quantity) AS avg_param, stddev_samp(l_quantity) AS std_param,
    CASE WHEN stddev_samp(l_quantity) IS NOT NULL THEN least((45 - avg(l_quantity)) / (3 * stddev_samp(l_quantity) + 1e-9),
      (avg(l_quantity) - 5) / (3 * stddev_samp(l_quantity) + 1e-9)) END AS cpk_param,
    count(*) AS wafer_count, count(*) FILTER (l_returnflag <> 'N') AS defect_count,
    avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END) AS defect_rate FROM lineitem GROUP BY 1, 2)
  SELECT l_orderkey, l_returnflag, round(avg_param, 6) AS avg_param, round(std_param, 6) AS std_param,
    CASE WHEN std_param > 1e-6 THEN round(cpk_param, 6) END AS cpk_param,
    wafer_count, defect_count, round(defect_rate, 6) AS defect_rate,
    round(avg(avg_param) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS avg_param_roll25
  FROM g""")
def lot_rolling(spark, d):
    out = lots.lot_spc(lineitem(spark, d), "l_orderkey", "l_returnflag", "l_quantity", 5.0, 45.0, "N",
                       rows_per_bucket=ROWS_PER_BUCKET)
    # A zero spread leaves only the epsilon in the divisor; such values are not comparable.
    return round_all(out.withColumn("cpk_param", F.when(F.col("std_param") > 1e-6, F.col("cpk_param"))))


@R.add("""SELECT l_orderkey, round(avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END), 6) AS defect_rate,
  array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS defect_types FROM lineitem GROUP BY 1
  HAVING avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0.0 END) > 0.2""")
def high_rate_lots(spark, d):
    out = lots.high_defect_lots(lineitem(spark, d), "l_orderkey", "l_returnflag", "N")
    return round_all(out.withColumn("defect_types", F.array_join("defect_types", ",")))


@R.add("""SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderstatus, count(*) AS wafer_count,
  round(avg(o_totalprice), 6) AS avg_measure FROM orders GROUP BY 1, 2""")
def month_trend(spark, d):
    month = F.date_format("o_orderdate", "yyyyMM")
    return rounded(lots.period_trend(table(spark, d, "orders"), month, "o_orderstatus", "o_totalprice"), 6, "avg_measure")


@R.add("SELECT l_suppkey, count(*) AS n, " + ", ".join(f"count(*) FILTER (l_returnflag = '{f}') AS n_{f}" for f in FLAGS)
       + " FROM lineitem GROUP BY 1")
def lot_distribution(spark, d):
    return lots.lot_distribution(lineitem(spark, d), "l_suppkey", "l_returnflag", FLAGS)


@R.add("""SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_sd,
  round(avg(l_quantity) - 3 * stddev_samp(l_quantity), 6) AS l_quantity_lcl,
  round(avg(l_quantity) + 3 * stddev_samp(l_quantity), 6) AS l_quantity_ucl FROM lineitem GROUP BY 1""")
def control_limits(spark, d):
    return round_all(spc.control_limits(lineitem(spark, d), ["l_quantity"], ["l_returnflag"]))


@R.add("""WITH s AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1)
  SELECT event_id, e.event_type, value, CASE WHEN value > mu THEN 'high' ELSE 'low' END AS side
  FROM events e JOIN s USING (event_type) WHERE abs(value - mu) > 3 * sd""")
def limit_alarms(spark, d):
    return spc.limit_alarms(events(spark, d).select("event_id", "event_type", "value"), "value", ["event_type"])


@R.add("""WITH s AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1),
  z AS (SELECT event_id, event_type, value, (value - mu) / sd AS z,
      sign(value - lag(value) OVER (PARTITION BY event_type ORDER BY event_id)) AS step FROM events JOIN s USING (event_type)),
  r AS (SELECT *, sum(CAST(z > 2 AS INT)) OVER w3 AS hi, sum(CAST(z < -2 AS INT)) OVER w3 AS lo, sum(step) OVER w6 AS trend FROM z
    WINDOW w3 AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
           w6 AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
  SELECT event_id, event_type, value, CAST(abs(z) > 3 AS INTEGER) AS rule_3sigma,
    CAST((hi >= 2 AND z > 2) OR (lo >= 2 AND z < -2) AS INTEGER) AS rule_2of3,
    CAST(coalesce(abs(trend) = 6, false) AS INTEGER) AS rule_trend FROM r""")
def run_rules(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "value")
    return spc.run_rules(rows, "event_id", "value", ["event_type"], rows_per_bucket=ROWS_PER_BUCKET)


# After 200 steps the oldest weight is below 1e-19, far under the rounding.
@R.add("""WITH o AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k,
    first_value(value) OVER (PARTITION BY event_type ORDER BY event_id) AS x1 FROM events)
  SELECT a.event_id, a.event_type, any_value(a.value) AS value,
    round(sum(0.2 * 0.8 ** (a.k - b.k) * b.value) + any_value(0.8 ** a.k * a.x1), 6) AS ewma
  FROM o a JOIN o b ON a.event_type = b.event_type AND b.k BETWEEN a.k - 199 AND a.k GROUP BY 1, 2""")
def ewma(spark, d):
    rows = events(spark, d)
    return rounded(spc.ewma(rows, "event_id", "value", ["event_type"], 0.2, ROWS_PER_BUCKET), 6, "ewma")
