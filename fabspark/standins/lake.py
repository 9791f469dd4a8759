"""Sinks and scans by writing a given table, reading it back and comparing; lake tables; bad and missing input."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fabspark import dims, schemas
from fabspark.constants import CLASS_META, CLASSES, PARAMS, SEVERITY_CONFIDENCE, SEVERITY_INDEX
from fabspark.functions import labels as L
from fabspark.functions import limits as lim
from fabspark.operators import diemaps as M
from fabspark.operators import distribution as D
from fabspark.operators import economics as E
from fabspark.operators import lots, models, reports
from fabspark.plans import medallion
from fabspark.session import cut_lineage, shared_dir
from fabspark.sources import npy, readers, writers
from fabspark.standins.common import ROWS_PER_BUCKET, Registry, round_all, table
from fabspark.standins.maps import CELLS_SQL, SIDE, _quadrants, byte_sums, die_maps, shaped

R = Registry()
CLASS_SQL = "CASE {} % 9 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CLASSES)) + " END"


def folder(spark) -> str:
    return f"{shared_dir(spark)}/standin-{uuid.uuid4().hex}"


def class_name(number):
    return L.decode_label((number % 9).cast("int"))


# ---- sinks and scans ----------------------------------------------------------------
@R.add("SELECT l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def table_round_trip(spark, d):
    """Overwritten, partitioned table, read back with a filter that prunes to one folder."""
    path, rows = folder(spark), table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    writers.write_table(rows.filter("l_returnflag = 'A'"), path, partition_by=["l_returnflag"])
    writers.write_table(rows, path, partition_by=["l_returnflag"])
    back = readers.read_table(spark, path).filter("l_returnflag = 'R'")
    return back.groupBy("l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@R.add("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def many_files_scan(spark, d):
    """Folders and nested folders of files, read together."""
    path, rows = folder(spark), table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for k, part in enumerate(("a", "b/c", "b/d")):
        writers.write_table(rows.filter(F.col("o_orderkey") % 3 == k), f"{path}/{part}")
    back = readers.read_table(spark, f"{path}/a", f"{path}/b", recursive=True)
    return back.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _params(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.select(*[(F.col("l_quantity") + i).cast("double").alias(p) for i, p in enumerate(PARAMS)],
                       F.col("l_returnflag").alias("defect_class"), F.col("l_orderkey").alias("wafer_id"),
                       (F.col("l_returnflag") != "N").cast("int").alias("is_defect"))


@R.add("SELECT l_returnflag AS defect_class, count(*) AS n, " + ", ".join(
    f"CAST(sum(l_quantity + {i}) AS DOUBLE) AS {p}" for i, p in enumerate(PARAMS))
    + ", CAST(sum(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS defects FROM lineitem GROUP BY 1")
def csv_round_trip(spark, d):
    """Process parameters through the CSV sink and the parameter scan."""
    path = folder(spark)
    writers.write_csv(_params(spark, d), path)
    return readers.read_params(spark, path).groupBy("defect_class").agg(
        F.count("*").alias("n"), *[F.sum(p).alias(p) for p in PARAMS], F.sum("is_defect").alias("defects"))


@R.add("SELECT count(*) AS n, max(o_totalprice) AS top FROM orders")
def json_summary(spark, d):
    path = folder(spark)
    writers.write_summary(table(spark, d, "orders").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top")), path)
    return spark.read.json(path)


@R.add("SELECT 'bronze' AS layer, 'orders' AS \"table\", count(DISTINCT o_orderstatus) AS files, 1 AS has_bytes FROM orders UNION ALL "
       "SELECT 'gold', 'nation', least(count(*), 1), 1 FROM nation")
def storage_report(spark, d):
    root = folder(spark) + "/lake+1 (x)"  # characters that mean something in a pattern
    writers.write_table(table(spark, d, "orders"), f"{root}/bronze/orders", partition_by=["o_orderstatus"], one_file=True)
    writers.write_table(table(spark, d, "nation"), f"{root}/gold/nation", one_file=True)
    return writers.lake_report(spark, root).select("layer", "table", "files", (F.col("bytes") > 0).cast("int").alias("has_bytes"))


@R.add("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def temp_view(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    readers.register_views({name: table(spark, d, "orders")})
    return spark.sql(f"SELECT o_orderpriority, count(*) AS n FROM {name} GROUP BY 1")


NPY_SQL = f"""WITH {CELLS_SQL} SELECT p.k AS wafer_id, CAST(count(*) AS INTEGER) AS dies, count(*) FILTER (die = 2) AS defects,
  sum(die * (pos + 1)) FILTER (die > 0) AS place_sum FROM cells JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM embeddings) p USING (vec_id) GROUP BY 1"""


def _map_sums(maps):
    return maps.select("wafer_id", F.length("wafer_map_flat").alias("dies"), *byte_sums(F.col("wafer_map_flat")))


def _in_order(spark, d):
    maps = die_maps(spark, d).select(F.col("vec_id").alias("wafer_id"), F.col("map").alias("wafer_map_flat"))
    return maps.repartitionByRange(4, "wafer_id").sortWithinPartitions("wafer_id")


@R.add(NPY_SQL)
def npy_maps(spark, d):
    """Maps through array files with a header; the position over all files is the id."""
    path = folder(spark)
    npy.write_npy_maps(_in_order(spark, d), path, SIDE)
    return _map_sums(npy.read_npy_maps(spark, path, part_bytes=10_000))


@R.add(NPY_SQL)
def headerless_maps(spark, d):
    """Maps through files of plain bytes."""
    path = folder(spark)
    npy.write_npy_maps(_in_order(spark, d), path, SIDE, header=False)
    return _map_sums(readers.read_fixed_width_maps(spark, path, SIDE * SIDE))


# ---- raw maps -------------------------------------------------------------------------
def raw_maps(spark, d):
    """Raw maps with nested labels: every 10th unlabelled, every 7th with too few bytes, every 11th missing."""
    v = F.col("vec_id")
    label = F.when(v % 10 == 0, F.expr("array()").cast("array<array<string>>")).otherwise(F.array(F.array(class_name(v))))
    cells = F.when(v % 7 == 0, F.expr("substring(map.cells, 1, 5)")).otherwise(F.col("map.cells"))
    whole = F.when(v % 11 != 0, F.struct(F.col("map.rows").alias("rows"), F.col("map.cols").alias("cols"), cells.alias("cells")))
    return shaped(spark, d).select(
        "vec_id", F.lit(1.0).alias("die_size"), F.concat(F.lit("lot"), F.floor(v / 25)).alias("lot_name"),
        (v % 25).cast("double").alias("wafer_index"), F.array(F.array(F.lit("Training"))).alias("train_test_label"),
        label.alias("failure_type"), whole.alias("map")).withColumnRenamed("vec_id", "wafer_id")


@R.add("SELECT CAST(CASE WHEN vec_id % 10 = 0 THEN 0 ELSE 1 END AS INTEGER) AS is_labeled, count(*) AS n, "
       "count(DISTINCT vec_id // 25) AS lots, CAST(sum(vec_id % 25) AS BIGINT) AS indexes, "
       "CAST(sum(CASE WHEN vec_id % 11 = 0 THEN 0 WHEN vec_id % 7 = 0 THEN 5 ELSE 64 END) AS BIGINT) AS bytes FROM embeddings GROUP BY 1")
def json_raw_maps(spark, d):
    """Raw maps through JSON files into the raw table."""
    path = folder(spark)
    raw_maps(spark, d).write.json(path)
    raw = medallion.raw_bronze(readers.read_raw_maps(spark, path, "json"))
    return raw.groupBy("is_labeled").agg(
        F.count("*").alias("n"), F.count_distinct("lot_id").alias("lots"), F.sum("wafer_index").cast("long").alias("indexes"),
        F.coalesce(F.sum(F.length("cells")), F.lit(0)).alias("bytes"))


@R.add("SELECT 'clean' AS kind, count(*) AS n FROM embeddings WHERE vec_id % 10 <> 0 AND vec_id % 7 <> 0 AND vec_id % 11 <> 0 UNION ALL "
       "SELECT 'bad', count(*) FROM embeddings WHERE vec_id % 7 = 0 OR vec_id % 11 = 0")
def bad_maps(spark, d):
    """Maps that fit their shape, resized; the others kept apart."""
    raw = raw_maps(spark, d)
    clean = medallion.clean_maps(raw, SIDE).filter(F.length("wafer_map_flat") == 64)
    return clean.agg(F.count("*").alias("n")).select(F.lit("clean").alias("kind"), "n").unionByName(
        medallion.bad_maps(raw).agg(F.count("*").alias("n")).select(F.lit("bad").alias("kind"), "n"))


@R.add(f"""SELECT CASE WHEN vec_id % 10 = 0 THEN 'unlabelled' ELSE 'labelled' END AS part, count(*) AS n, min(vec_id) AS first_id, max(vec_id) AS last_id
  FROM embeddings GROUP BY 1""")
def label_partition(spark, d):
    """Labelled and unlabelled rows of one scan."""
    rows = raw_maps(spark, d).withColumn("label", L.first_label(F.col("failure_type")))
    known, unknown = L.split_labelled(rows, "label")

    def count(part, name):
        return part.agg(F.count("*").alias("n"), F.min("wafer_id").alias("first_id"), F.max("wafer_id").alias("last_id")).select(
            F.lit(name).alias("part"), "n", "first_id", "last_id")

    return count(known, "labelled").unionByName(count(unknown, "unlabelled"))


@R.add("SELECT count(*) AS n, count(*) FILTER (vec_id % 5 = 0) AS missing, count(*) FILTER (vec_id % 5 = 0) AS no_class, "
       "count(*) FILTER (vec_id % 5 = 0) AS no_copy, count(*) FILTER (vec_id % 5 = 0) AS no_features FROM embeddings")
def missing_maps(spark, d):
    """A missing map has no class, no copy and no features."""
    rows = die_maps(spark, d).withColumn("map", F.when(F.col("vec_id") % 5 != 0, F.col("map")))
    out = rows.select(
        "map", models.batch_predict(F.col("map"), _quadrants, SIDE, SIDE).alias("s"),
        M.symmetry(F.col("map"), F.lit(1), F.lit(0), F.lit(1), SIDE).alias("c"), M.spatial_features(F.col("map"), SIDE, SIDE).alias("f"))
    return out.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(a) for c, a in (
        ("map", "missing"), ("s", "no_class"), ("c", "no_copy"), ("f", "no_features"))])


# ---- lake tables ------------------------------------------------------------------------
def bronze(spark, d):
    """Silver table of the 8 x 8 maps; parameters are known for every third."""
    maps = die_maps(spark, d).select(F.col("vec_id").alias("wafer_id"), class_name(F.col("vec_id")).alias("failure_type"),
                                     F.col("map").alias("wafer_map_flat"))
    manifest = maps.filter("wafer_id % 2 = 0").select("wafer_id", F.when(F.col("wafer_id") % 4 == 0, "val").otherwise("test").alias("split"))
    known = maps.filter("wafer_id % 3 = 0").select(
        "wafer_id", *[(F.col("wafer_id") % (17 + i)).cast("double").alias(p) for i, p in enumerate(PARAMS)],
        F.lit("none").alias("defect_class"), F.lit(0).alias("is_defect"))
    return medallion.bronze_maps(maps, manifest, SIDE), medallion.bronze_params(known)


def silver(spark, d):
    return medallion.silver(*bronze(spark, d))


def exchanges(df) -> int:
    """Shuffles and broadcasts in the plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@R.add(f"""SELECT {CLASS_SQL.format('vec_id')} AS failure_type, count(*) AS n, count(*) FILTER (vec_id % 3 = 0) AS with_params,
  CAST(sum(vec_id % 17) FILTER (vec_id % 3 = 0) AS DOUBLE) AS pressure, 0 AS exchanges FROM embeddings GROUP BY 1""")
def bucketed_join(spark, d):
    """Silver from bronze tables in equal buckets; its plan has no exchange on either side."""
    path, db = folder(spark), f"fab_{uuid.uuid4().hex}"
    try:
        spark.sql(f"CREATE DATABASE {db}")
        medallion.bucketed_bronze(*bronze(spark, d), db, path, 4)
        rows = medallion.bucketed_silver(spark, db)
        moved = exchanges(rows)
        return cut_lineage(rows.groupBy("failure_type").agg(
            F.count("*").alias("n"), F.count("cmp_pressure").alias("with_params"), F.sum("cmp_pressure").alias("pressure"),
            F.lit(moved).alias("exchanges")))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


SPLIT_OF_SQL = "CASE WHEN vec_id % 2 = 1 THEN 'train' WHEN vec_id % 4 = 0 THEN 'val' ELSE 'test' END"


@R.add(f"SELECT {CLASS_SQL.format('vec_id')} AS failure_type, count(*) AS n, count(*) FILTER (vec_id % 3 = 0) AS with_params FROM embeddings WHERE vec_id % 4 = 0 GROUP BY 1")
def gold_split(spark, d):
    """Gold table partitioned by split, feature store without maps, one split read back."""
    path, rows = folder(spark), silver(spark, d)
    writers.write_table(rows, f"{path}/gold", "gold")
    writers.write_table(medallion.feature_store(rows), f"{path}/store", "gold_feature_store")
    part = medallion.gold_split(readers.read_table(spark, f"{path}/gold", schema=schemas.SILVER), "val").select("wafer_id", "wafer_map_flat")
    store = readers.read_table(spark, f"{path}/store")
    assert "wafer_map_flat" not in store.columns
    return part.join(store.filter("split = 'val'"), "wafer_id").groupBy("failure_type").agg(
        F.count("*").alias("n"), F.count("cmp_pressure").alias("with_params"))


@R.add(f"""WITH s AS (SELECT vec_id AS wafer_id, {SPLIT_OF_SQL} AS split, CASE WHEN vec_id % 3 = 0 THEN vec_id % 17 END AS p FROM embeddings)
  SELECT wafer_id, split, CAST(p AS DOUBLE) AS cmp_pressure,
    round(avg(p) OVER (ORDER BY wafer_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS cmp_pressure_roll25 FROM s""")
def gold_spc(spark, d):
    """SPC table: the parameters that exist, with moving means in wafer order."""
    return round_all(medallion.gold_spc(silver(spark, d), 50).select("wafer_id", "split", "cmp_pressure", "cmp_pressure_roll25"))


@R.add(f"""SELECT CASE WHEN vec_id % 3 = 0 AND vec_id % 25 > 15 THEN 'CRITICAL' WHEN vec_id % 3 = 0 AND vec_id % 25 > 10 THEN 'WARNING' ELSE 'OK' END AS spc_status,
  count(*) AS n FROM embeddings WHERE vec_id % 9 <> 0 GROUP BY 1""")
def catalog_alert_view(spark, d):
    """Database, table over a lake folder and alert view; the view's rows are read before it is dropped."""
    path, db = folder(spark), f"fab_{uuid.uuid4().hex}"
    writers.write_table(silver(spark, d), path, "silver")
    try:
        writers.create_catalog(spark, db, {"silver": path})
        writers.create_alert_view(spark, db)
        return cut_lineage(spark.table(f"{db}.v_spc_alert").groupBy("spc_status").agg(F.count("*").alias("n")))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


# ---- class metadata ----------------------------------------------------------------------
META_SQL = "(SELECT l_returnflag AS f, count(*) AS n, avg(l_discount) AS impact FROM lineitem GROUP BY 1)"


def metadata(spark, d):
    """One JSON object keyed by class, with figures of the line items, and its scan."""
    path = folder(spark)
    per = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.avg("l_discount").alias("impact"))
    entry = F.struct(
        F.concat(F.lit("name "), "l_returnflag").alias("korean_name"), F.lit("wear").alias("physical_mechanism"),
        F.lit("cmp").alias("primary_process_stage"), F.lit("High").alias("severity_level"),
        F.ascii("l_returnflag").alias("severity_score"), F.col("impact").alias("yield_impact"),
        F.struct(F.col("n").alias("n_samples")).alias("spatial_evidence"))
    whole = per.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("l_returnflag"), entry)))).alias("value"))
    whole.coalesce(1).write.text(path)
    return readers.read_class_metadata(spark, path)


@R.add(f"SELECT f AS failure_type, 'name ' || f AS korean_name, CAST(ascii(f) AS INTEGER) AS severity_score, round(impact, 6) AS yield_impact, n AS n_samples FROM {META_SQL}")
def class_metadata(spark, d):
    return round_all(metadata(spark, d).select("failure_type", "korean_name", "severity_score", "yield_impact", "spatial_evidence.n_samples"))


@R.add(f"""SELECT f AS cls, 'name ' || f AS korean_name, n, round(n / sum(n) OVER (), 6) AS defect_rate, CAST(ascii(f) AS INTEGER) AS severity_score,
  round(n / sum(n) OVER () * impact * 100, 6) AS yield_loss_pct FROM {META_SQL}""")
def class_defect_report(spark, d):
    detected = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("cls"))
    out = reports.defect_report(detected, metadata(spark, d), "cls")
    return round_all(out.select("cls", "korean_name", "n", "defect_rate", "severity_score", "yield_loss_pct"))


@R.add(f"""SELECT f AS failure_type, round(e.m, 6) AS center_ratio, e.k AS n_params FROM {META_SQL} LEFT JOIN
  (SELECT l_returnflag, avg(l_tax) AS m, count(DISTINCT l_linenumber) AS k FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) e ON f = l_returnflag""")
def enriched_metadata(spark, d):
    """Metadata with measured evidence folded in; a class without evidence keeps NULL."""
    rows = table(spark, d, "lineitem").filter("l_returnflag <> 'N'").groupBy(F.col("l_returnflag").alias("failure_type"))
    out = writers.enrich_classes(
        metadata(spark, d), rows.agg(F.avg("l_tax").alias("center_ratio")), rows.agg(F.count_distinct("l_linenumber").alias("n_params")))
    return round_all(out.select("failure_type", "spatial_evidence.center_ratio", "correlation_evidence.n_params"))


@R.add("""WITH m(failure_type, severity_idx, confidence) AS (VALUES """ + ", ".join(f"('{c}', {SEVERITY_INDEX[m[0]]}, {SEVERITY_CONFIDENCE[m[0]]})" for c, m in CLASS_META.items())
    + f""") SELECT severity_idx, CAST(confidence AS DOUBLE) AS confidence, count(*) AS n
  FROM (SELECT {CLASS_SQL.format('event_id')} AS failure_type FROM events) JOIN m USING (failure_type) GROUP BY 1, 2""")
def severity_targets(spark, d):
    rows = table(spark, d, "events").select(class_name(F.col("event_id")).alias("failure_type"))
    return reports.with_targets(spark, rows, "failure_type").groupBy("severity_idx", "confidence").agg(F.count("*").alias("n"))


# ---- order by text, missing readings -------------------------------------------------------
@R.add("""WITH g AS (SELECT 'LOT' || l_orderkey AS lot, l_returnflag, avg(l_quantity) AS avg_param, count(*) AS wafer_count FROM lineitem GROUP BY 1, 2)
  SELECT lot, l_returnflag, round(avg_param, 6) AS avg_param, wafer_count,
    round(avg(avg_param) OVER (PARTITION BY l_returnflag ORDER BY lot ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS avg_param_roll25 FROM g""")
def text_lot_rolling(spark, d):
    """Lot statistics in the order of text lot ids."""
    rows = table(spark, d, "lineitem").withColumn("lot", F.concat(F.lit("LOT"), "l_orderkey"))
    out = lots.lot_spc(rows, "lot", "l_returnflag", "l_quantity", 5.0, 45.0, "N", rows_per_bucket=ROWS_PER_BUCKET)
    return round_all(out.select("lot", "l_returnflag", "avg_param", "wafer_count", "avg_param_roll25"))


@R.add("SELECT 'value' AS param, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50 FROM events "
       "UNION ALL SELECT 'nothing', count(*) - count(value), NULL, NULL FROM events")
def describe_with_empty_column(spark, d):
    """A column without any value gives no quantiles and does not stop the others."""
    rows = table(spark, d, "events").select("value", F.lit(None).cast("double").alias("nothing"))
    out = D.describe(rows, ["value", "nothing"], rows_per_bucket=ROWS_PER_BUCKET)
    return round_all(out.select("param", "n", "mean", F.col("q50").alias("p50")))


@R.add("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN quality IS NULL THEN NULL WHEN n_chars BETWEEN 500 AND 2000 THEN 'ok'
    WHEN greatest(500 - n_chars, n_chars - 2000, 0) / (1500 * 0.5 + 1e-9) > 0.5 THEN 'crit' ELSE 'warn' END AS status
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY 1""")
def missing_status(spark, d):
    """Readings that a left join leaves missing have no status."""
    rows = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    reading = F.when(F.col("quality").isNotNull(), F.col("n_chars").cast("double"))
    return rows.select(lim.param_status(reading, 500.0, 2000.0).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


# ---- gaps of earlier rounds ---------------------------------------------------------------
@R.add(f"""WITH s AS (SELECT {CLASS_SQL.format('event_id')} AS c, count(*) / sum(count(*)) OVER () AS ratio FROM events GROUP BY 1),
  f AS (SELECT {CLASS_SQL.format('doc_id')} AS c, least(avg(n_chars) / 100, 90.0) AS cut, 1000.0 + count(*) AS cost FROM documents GROUP BY 1),
  m(c, impact) AS (VALUES """ + ", ".join(
    f"('{c}', {m[2]})" for c, m in CLASS_META.items()) + """)
  SELECT f.c AS defect_class, round(round(ratio * impact * 25000000.0, 0) / 1000, 0) AS loss_kusd,
    round((ratio * impact * 25000000.0 * cut / 100 * 12 - cost) / (cost + 1) * 100, 1) AS roi_pct FROM f JOIN s USING (c) JOIN m USING (c)""")
def roi_of_settings(spark, d):
    """Found settings, class shares and yield impact joined to ROI."""
    labels = table(spark, d, "events").select(class_name(F.col("event_id")).alias("cls"))
    found = table(spark, d, "documents").groupBy(class_name(F.col("doc_id")).alias("defect_class")).agg(
        F.least(F.avg("n_chars") / 100, F.lit(90.0)).alias("prob_reduction_pct"), (F.count("*") + 1000.0).alias("adj_cost_usd"))
    out = E.roi_of_settings(found, labels, "cls", dims.class_dim(spark))
    return out.select("defect_class", F.round(F.col("current_monthly_loss_usd") / 1000, 0).alias("loss_kusd"), "roi_pct")
