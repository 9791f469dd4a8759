"""Bronze, silver and gold tables of the die-map lake.

Every stage is a function from frames to a frame; only the sinks run jobs. Split the run
with ``--step``: each step reads what the earlier ones wrote.
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabspark import schemas
from fabspark.constants import CLASSES, SPC_LIMITS, SPLITS
from fabspark.functions import labels as L
from fabspark.functions.limits import any_ooc, with_ooc_flags
from fabspark.operators import diemaps, ordered, spc
from fabspark.operators.splitting import stratified_split
from fabspark.session import get_spark
from fabspark.sources import readers, writers

LAYOUT = {
    "raw_maps": "bronze/raw_maps", "bad_maps": "bronze/bad_maps",
    "bronze_maps": "bronze/maps", "bronze_params": "bronze/params", "silver": "silver/wafers",
    "gold": "gold/wafers", "gold_feature_store": "gold/feature_store",
    "gold_spc": "gold/spc", "gold_spc_summary": "gold/spc_summary",
}


def _fits(raw: DataFrame) -> Column:
    """Whether a raw map's bytes are dies and fill its shape."""
    shape = F.coalesce((F.col("map.rows") > 0) & (F.col("map.cols") > 0), F.lit(False))
    return shape & diemaps.map_validity(F.col("map.cells"), F.col("map.rows"), F.col("map.cols"))


def clean_maps(raw: DataFrame, side: int = 64) -> DataFrame:
    """Known-class raw maps at one size: ``wafer_id, failure_type, wafer_map_flat``.

    Maps that do not fit their shape are left to ``bad_maps``.
    """
    labelled = raw.withColumn("failure_type", L.first_label(F.col("failure_type"))).filter(_fits(raw))
    # The batch function may see rows of any filter, so what it gets is NULL where the map is bad.
    fit = F.when(_fits(raw), F.col("map"))
    return L.keep_known_classes(labelled, "failure_type").select(
        "wafer_id", "failure_type", diemaps.resize_nearest(fit, side, side).alias("wafer_map_flat")
    )


def bad_maps(raw: DataFrame) -> DataFrame:
    """Raw maps that are missing or do not fit their shape, in the raw table's form."""
    return raw_bronze(raw.filter(~_fits(raw)))


def raw_bronze(raw: DataFrame) -> DataFrame:
    """Every raw map with lot, shape and whether it is labelled."""
    label = L.first_label(F.col("failure_type"))
    return schemas.conform(raw.select(
        "wafer_id", F.col("lot_name").alias("lot_id"), F.col("wafer_index").cast("int").alias("wafer_index"),
        F.col("die_size").cast("float").alias("die_size"), F.col("map.rows").alias("map_rows"),
        F.col("map.cols").alias("map_cols"), F.col("map.cells").alias("cells"), label.alias("failure_type"),
        L.first_label(F.col("train_test_label")).alias("original_split"), L.is_labelled(label).cast("int").alias("is_labeled"),
    ), schemas.RAW_BRONZE)


def bronze_maps(
    maps: DataFrame, manifest: DataFrame | None = None, side: int = 64, classes=CLASSES, seed: int = 42
) -> DataFrame:
    """Maps with class index, split and spatial features.

    Without a manifest the split is drawn here; it reads only ids and labels.
    """
    tagged = (
        readers.with_split(maps, manifest) if manifest is not None
        else stratified_split(maps, "wafer_id", "failure_type", seed=seed)
    )
    features = diemaps.spatial_features(F.col("wafer_map_flat"), side, side)
    out = tagged.withColumns({"class_idx": L.encode_label(F.col("failure_type"), classes), "_f": features})
    return schemas.conform(out.select("*", "_f.*"), schemas.BRONZE_MAPS)


def bronze_params(params: DataFrame) -> DataFrame:
    return schemas.conform(with_ooc_flags(params), schemas.BRONZE_PARAMS)


def silver(maps: DataFrame, params: DataFrame) -> DataFrame:
    """All maps with their parameters where known; ``any_ooc`` is 0 where they are not."""
    colliding = [c for c in params.columns if c in maps.columns and c != "wafer_id"]
    joined = maps.join(params.drop("defect_class", "is_defect", *colliding), "wafer_id", "left")
    flags = [f"{p}_ooc" for p in SPC_LIMITS]
    return schemas.conform(joined.withColumn("any_ooc", any_ooc(flags)), schemas.SILVER)


def bucketed_bronze(maps: DataFrame, params: DataFrame, database: str, lake: str, buckets: int) -> None:
    """Bronze maps and parameters as catalog tables in equal buckets of ``wafer_id``.

    Choose ``buckets`` so that a bucket of maps is some hundred MB; it is fixed until both tables
    are rewritten.
    """
    for name, df in (("bronze_maps", maps), ("bronze_params", params)):
        writers.write_buckets(df, f"{database}.{name}", f"{lake.rstrip('/')}/bucketed/{name}", "wafer_id", buckets, name)


def bucketed_silver(spark: SparkSession, database: str) -> DataFrame:
    """``silver`` of bucketed bronze tables: a sort-merge join in which no map is shuffled, however large the parameters."""
    return silver(spark.table(f"{database}.bronze_maps"), spark.table(f"{database}.bronze_params").hint("merge"))


def gold_split(silver_df: DataFrame, name: str) -> DataFrame:
    """One split; on the partitioned gold table this prunes to its folder."""
    if name not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}")
    return silver_df.filter(F.col("split") == name)


def feature_store(silver_df: DataFrame) -> DataFrame:
    return schemas.conform(silver_df.drop("wafer_map_flat"), schemas.FEATURE_STORE)


def gold_spc(silver_df: DataFrame, rows_per_bucket: int = ordered.ROWS_PER_BUCKET) -> DataFrame:
    """Parameters with their 25-row moving means in wafer order."""
    base = silver_df.select("wafer_id", "failure_type", "split", "defect_density", *SPC_LIMITS)
    rolled = ordered.rolling_mean(base, "wafer_id", list(SPC_LIMITS), 25, rows_per_bucket=rows_per_bucket)
    return schemas.conform(rolled, schemas.SPC)


def gold_spc_summary(silver_df: DataFrame) -> DataFrame:
    return schemas.conform(spc.spc_summary(silver_df), schemas.SPC_SUMMARY)


def read_lake(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """One lake table in its contract's column order."""
    schema = schemas.TABLES[table][0]
    return schemas.conform(
        readers.read_table(spark, f"{lake.rstrip('/')}/{LAYOUT[table]}", schema=schema), schema)


def run(
    spark: SparkSession, lake: str, maps: DataFrame | None = None, params: DataFrame | None = None,
    manifest: DataFrame | None = None, step: str = "all", raw: DataFrame | None = None,
) -> None:
    """Build the lake under ``lake``; ``step`` is all, bronze, silver, gold or features.

    ``maps`` are cleaned maps of one size. With ``raw``, the raw table is kept too and supplies
    the maps.
    """
    path = {table: f"{lake.rstrip('/')}/{folder}" for table, folder in LAYOUT.items()}

    def write(frames: dict[str, DataFrame]) -> None:
        # Independent tables are written side by side, so small ones do not leave cores idle.
        with ThreadPoolExecutor(len(frames)) as pool:
            list(pool.map(lambda item: writers.write_table(item[1], path[item[0]], item[0]), frames.items()))

    def read(table: str) -> DataFrame:
        return read_lake(spark, lake, table)

    if step in ("all", "bronze"):
        if maps is None and raw is None:
            raise ValueError("the bronze step needs maps or raw maps")
        if params is None:
            raise ValueError("the bronze step needs process parameters")
        if raw is not None:
            write({"raw_maps": raw_bronze(raw), "bad_maps": bad_maps(raw)})
            maps = clean_maps(raw) if maps is None else maps
        write({"bronze_maps": bronze_maps(maps, manifest), "bronze_params": bronze_params(params)})
    if step in ("all", "silver"):
        write({"silver": silver(read("bronze_maps"), read("bronze_params"))})
    outputs = {}
    if step in ("all", "gold"):
        outputs["gold"] = read("silver")
    if step in ("all", "features"):
        table = read("silver")
        outputs |= {
            "gold_feature_store": feature_store(table), "gold_spc": gold_spc(table),
            "gold_spc_summary": gold_spc_summary(table),
        }
    if outputs:
        write(outputs)


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--lake", required=True)
    args.add_argument("--raw", help="raw maps: wafer_id, failure_type, map")
    args.add_argument("--params", help="process-parameter CSV")
    args.add_argument("--manifest", help="split manifest: wafer_id, split")
    args.add_argument("--step", default="all", choices=["all", "bronze", "silver", "gold", "features"])
    opts = args.parse_args(argv)
    if opts.step in ("all", "bronze") and not (opts.raw and opts.params):
        args.error("--raw and --params are needed for this step")
    spark = get_spark("fabspark-lake")
    run(
        spark, opts.lake,
        params=readers.read_params(spark, opts.params) if opts.params else None,
        manifest=readers.read_table(spark, opts.manifest) if opts.manifest else None,
        step=opts.step, raw=readers.read_raw_maps(spark, opts.raw) if opts.raw else None,
    )
    writers.lake_report(spark, opts.lake).orderBy("layer", "table").show(truncate=False)


if __name__ == "__main__":
    main()
