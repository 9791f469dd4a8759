"""Sources, sinks and the bronze-silver-gold run on a small lake."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from fabspark import schemas
from fabspark.constants import CLASSES, PARAMS, SPC_LIMITS
from fabspark.operators import diemaps, reports
from fabspark.plans import medallion
from fabspark.sources import readers, writers
from fabspark.standins import lake as lake_standins

N, N_PARAMS = 120, 50


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """120 raw maps of two shapes, parameters for the first 50."""
    root = str(tmp_path_factory.mktemp("lake"))
    rng = np.random.default_rng(5)
    raw = []
    for i in range(N + 5):
        shape = (20, 30) if i % 2 else (64, 64)
        label = [[CLASSES[i % 9]]] if i < N else ([] if i % 2 else [["unheard"]])
        raw.append((i, 1.0, f"lot{i // 10}", float(i % 25), [["Training"]], label,
                    (*shape, bytearray(rng.integers(0, 3, shape).astype(np.uint8).tobytes()))))
    whole = raw[0][-1]
    raw += [(N + 5, 1.0, "lot", 0.0, [["Training"]], [["Center"]], (64, 64, bytearray(7))),
            (N + 6, 1.0, "lot", 0.0, [["Training"]], [["Center"]], None),
            (N + 7, 1.0, "lot", 0.0, [["Training"]], [["Center"]], (*whole[:2], bytearray([9] * len(whole[2]))))]
    spark.createDataFrame(raw, schemas.RAW_MAPS).repartition(3).write.parquet(f"{root}/raw")
    os.makedirs(f"{root}/params")
    with open(f"{root}/params/p.csv", "w", encoding="utf-8-sig") as f:
        f.write(",".join([*PARAMS, "defect_class", "wafer_id", "is_defect"]) + "\n")
        for i in range(N_PARAMS):
            values = [f"{v:.5f}" for v in rng.normal([100, 35, 6.5, 1100, 1, 500, 1, 2, 5], [10, 5, .5, 25, .5, 25, .1, 1, 3])]
            f.write(",".join([*values, "none", str(i), "0"]) + "\n")
    medallion.run(spark, f"{root}/lake", params=readers.read_params(spark, f"{root}/params"),
                  raw=readers.read_raw_maps(spark, f"{root}/raw"))
    return root


def read(spark, lake, table):
    return medallion.read_lake(spark, f"{lake}/lake", table)


def test_tables_follow_their_contracts(spark, lake):
    for table, (schema, _) in schemas.TABLES.items():
        assert read(spark, lake, table).schema == schema
    counts = {t: read(spark, lake, t).count() for t in schemas.TABLES}
    assert counts == {"raw_maps": N + 8, "bad_maps": 3, "bronze_maps": N, "bronze_params": N_PARAMS, "silver": N, "gold": N,
                      "gold_feature_store": N, "gold_spc": N, "gold_spc_summary": 9}
    assert len(schemas.SILVER) == 30 and len(schemas.FEATURE_STORE) == 29


def test_maps_that_do_not_fit_are_kept_apart(spark, lake):
    assert sorted(r[0] for r in read(spark, lake, "bad_maps").select("wafer_id").collect()) == [N + 5, N + 6, N + 7]
    with pytest.raises(ValueError, match="parameters"):
        medallion.run(spark, f"{lake}/none", maps=read(spark, lake, "bronze_maps"), step="bronze")
    with pytest.raises(ValueError, match="maps"):
        medallion.run(spark, f"{lake}/none", params=read(spark, lake, "bronze_params"), step="bronze")


def test_lake_from_json(spark, lake, tmp_path):
    raw = readers.read_raw_maps(spark, f"{lake}/raw")
    raw.write.json(f"{tmp_path}/raw")
    again = readers.read_raw_maps(spark, f"{tmp_path}/raw", fmt="json")
    assert sorted(map(str, medallion.clean_maps(again).collect())) == sorted(map(str, medallion.clean_maps(raw).collect()))
    assert medallion.raw_bronze(again).count() == N + 8


def test_raw_table_splits_by_label(spark, lake):
    raw = read(spark, lake, "raw_maps")
    assert os.path.isdir(f"{lake}/lake/bronze/raw_maps/is_labeled=0")
    assert raw.filter("is_labeled = 0").count() == 2 and raw.filter("failure_type = 'unheard'").count() == 3
    assert raw.filter("map_rows = 20 AND map_cols = 30 AND length(cells) = 600").count() > 0


def test_silver_keeps_maps_without_parameters(spark, lake):
    silver = read(spark, lake, "silver")
    assert silver.filter("cmp_pressure IS NULL").count() == N - N_PARAMS
    assert silver.filter("any_ooc IS NULL").count() == 0
    assert silver.filter("cmp_pressure IS NULL AND any_ooc = 1").count() == 0
    row = silver.filter("wafer_id = 1").first()
    assert len(row["wafer_map_flat"]) == 4096 and row["class_idx"] == 1


def test_bronze_features_match_the_maps(spark, lake):
    for row in read(spark, lake, "bronze_maps").collect():
        m = np.frombuffer(row["wafer_map_flat"], np.uint8)
        assert row["defect_count"] == (m == 2).sum() and row["active_count"] == (m > 0).sum()


def test_spc_table(spark, lake):
    pdf = read(spark, lake, "gold_spc").orderBy("wafer_id").toPandas()
    want = pdf["cmp_pressure"].rolling(25, min_periods=1).mean()
    assert np.allclose(pdf["cmp_pressure_roll25"], want, equal_nan=True)
    assert set(SPC_LIMITS) <= set(pdf.columns)


def test_partitions_are_pruned(spark, lake):
    plan = medallion.gold_split(read(spark, lake, "gold"), "val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    narrow = read(spark, lake, "silver").filter("failure_type = 'Loc'").groupBy("failure_type").agg(F.avg("defect_density"))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "wafer_map_flat" not in plan and "PartitionFilters: [isnotnull(failure_type" in plan
    sizes = {s: medallion.gold_split(read(spark, lake, "gold"), s).count() for s in ("train", "val", "test")}
    assert sizes == {"train": 84, "val": 18, "test": 18}
    with pytest.raises(ValueError):
        medallion.gold_split(read(spark, lake, "gold"), "holdout")


def test_steps_can_run_alone(spark, lake):
    medallion.run(spark, f"{lake}/lake", step="features")
    assert read(spark, lake, "gold_feature_store").count() == N


def test_catalog_and_alert_view(spark, lake):
    db = "fab_lake_test"
    locations = {t: f"{lake}/lake/{p}" for t, p in medallion.LAYOUT.items()}
    try:
        writers.create_catalog(spark, db, locations)
        writers.create_alert_view(spark, db)
        assert spark.table(f"{db}.silver").count() == N
        alerts = spark.table(f"{db}.v_spc_alert")
        assert alerts.count() == N - 14 and {r[0] for r in alerts.select("spc_status").distinct().collect()} <= {"OK", "WARNING", "CRITICAL"}
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_lake_report(spark, lake):
    out = {(r["layer"], r["table"]): (r["files"], r["bytes"]) for r in writers.lake_report(spark, f"{lake}/lake").collect()}
    assert set(out) == {tuple(p.split("/")) for p in medallion.LAYOUT.values()}
    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{lake}/lake") for f in fs if f.endswith(".parquet"))
    assert sum(b for _, b in out.values()) == on_disk


def test_manifest_default_and_views(spark):
    maps = spark.createDataFrame([(1, "x"), (2, "y")], "wafer_id long, failure_type string")
    manifest = spark.createDataFrame([(2, "val")], "wafer_id long, split string")
    out = {r["wafer_id"]: r["split"] for r in readers.with_split(maps, manifest).collect()}
    assert out == {1: "train", 2: "val"}
    readers.register_views({"fab_maps_view": maps})
    assert spark.sql("SELECT count(*) FROM fab_maps_view").first()[0] == 2


def test_raw_scan_needs_its_columns(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="failure_type"):
        readers.read_raw_maps(spark, str(tmp_path / "x"))


def test_schema_drift_fails(spark):
    with pytest.raises(ValueError, match="class_idx"):
        schemas.conform(spark.range(1).withColumnRenamed("id", "wafer_id"), schemas.BRONZE_MAPS)
    text = spark.createDataFrame([("x", "train")], "wafer_id string, split string")
    with pytest.raises(Exception, match="wafer_id"):
        schemas.conform(text, schemas.SPLIT_MANIFEST).collect()


def test_fixed_width_file(spark, tmp_path):
    maps = np.random.default_rng(0).integers(0, 3, (100, 64)).astype(np.uint8)
    (tmp_path / "maps.bin").write_bytes(maps.tobytes())
    rows = readers.read_fixed_width_maps(spark, str(tmp_path / "maps.bin"), 64).collect()
    assert {r["wafer_id"]: bytes(r["wafer_map_flat"]) for r in rows} == {i: m.tobytes() for i, m in enumerate(maps)}


def test_class_metadata(spark, tmp_path):
    entry = {"severity_level": "High", "severity_score": 4, "yield_impact": 0.1, "critical_parameters": [
        {"name": "P", "unit": "psi", "normal_range": "1-2", "criticality": "High"}],
        "spatial_evidence": {"center_ratio": 0.5, "n_samples": 3}}
    (tmp_path / "meta.json").write_text(json.dumps({"A": entry, "none": {"severity_score": 0}}, indent=1))
    rows = {r["failure_type"]: r for r in readers.read_class_metadata(spark, str(tmp_path / "meta.json")).collect()}
    assert rows["A"]["critical_parameters"][0]["unit"] == "psi" and rows["A"]["spatial_evidence"]["n_samples"] == 3
    assert rows["none"]["correlation_evidence"] is None
    dim = readers.read_class_metadata(spark, str(tmp_path / "meta.json"))
    with pytest.raises(ValueError, match="gone"):
        reports.defect_report(spark.createDataFrame([("gone",)], "cls string"), dim, "cls")
    seen = spark.createDataFrame([("A",), ("none",), ("A",), ("none",)], "cls string")
    report = reports.defect_report(seen, dim, "cls").collect()
    assert [(r["cls"], r["n"], r["severity"]) for r in report] == [("A", 2, "High")]
    assert report[0]["yield_loss_pct"] == pytest.approx(0.5 * 0.1 * 100)
    spatial = spark.createDataFrame([("A", 0.9, 7)], "failure_type string, center_ratio double, n_samples long")
    corr = spark.createDataFrame([("A", "p", 0.4)], "failure_type string, top_param string, top_r double")
    out = {r["failure_type"]: r for r in writers.enrich_classes(dim, spatial, corr).collect()}
    assert out["A"]["spatial_evidence"]["n_samples"] == 7 and out["A"]["correlation_evidence"]["top_param"] == "p"
    assert out["none"]["spatial_evidence"] is None


def test_result_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    writers.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["v"] == "1.5"
    writers.write_summary(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["k"] == "a"
    writers.write_table(df, str(tmp_path / "t"), partition_by=["k"])
    assert os.path.isdir(tmp_path / "t" / "k=a")
    both = readers.read_table(spark, str(tmp_path / "t"), recursive=True)
    assert both.count() == 1


def test_one_file_per_folder_without_sorting_its_rows(spark, tmp_path, monkeypatch):
    """Also in a session that sorts each task's rows for a partitioned write."""
    seen, plain = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(writers.OPEN_FILES)), plain(self, path))[1])
    rows = [(i, ("a", "b", "", None)[i % 4], i // 4 % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, k string, x int").repartition(5)
    spark.conf.set(writers.OPEN_FILES, "0")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        writers.write_table(df, str(tmp_path / "t"), partition_by=["k", "x"], one_file=True)
        assert spark.conf.get(writers.OPEN_FILES) == "0"
        writers.write_table(df, str(tmp_path / "u"), one_file=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set(writers.OPEN_FILES, "32")
    assert seen == ["32", "32"]
    files = {str(f.parent.relative_to(tmp_path)): f.name for f in tmp_path.rglob("*.parquet")}
    assert len(files) == len(list(tmp_path.rglob("*.parquet"))) == 7
    assert sorted(r["i"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(400))


def test_storage_report_writes_each_folder_in_a_task_of_its_own(spark, tmp_path, monkeypatch):
    root, src = tmp_path / "lake", tmp_path / "in"
    spark.range(3000).selectExpr("id AS o_orderkey", "substr('OFP', int(id % 3) + 1, 1) AS o_orderstatus").write.parquet(f"{src}/orders.parquet")
    spark.range(25).selectExpr("id AS n_nationkey").write.parquet(f"{src}/nation.parquet")
    monkeypatch.setattr(lake_standins, "folder", lambda spark: str(root))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = sorted(tuple(r) for r in lake_standins.storage_report(spark, str(src)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows == [("bronze", "orders", 3, 1), ("gold", "nation", 1, 1)]
    assert len({f.name.split("-")[1] for f in root.rglob("o_orderstatus=*/*.parquet")}) > 1


def test_codec(spark):
    df = spark.createDataFrame([([0, 1, 2, 2],)], "c array<int>")
    back = df.select(diemaps.binary_to_cells(diemaps.cells_to_binary(F.col("c"))).alias("c")).first()["c"]
    assert back == [0, 1, 2, 2]
