"""Scans: lake tables, parameter files, raw maps, fixed-width map files and JSON dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark import schemas
from fabspark.operators.quality import require_columns
from fabspark.sources import npy


def read_table(spark: SparkSession, *paths: str, recursive: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files or folders, read together; partition folders are pruned by filters."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(*paths)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """Process-parameter CSV with header; a UTF-8 byte-order mark is accepted."""
    return spark.read.schema(schemas.PARAM_FILE).option("header", True).option("enforceSchema", True).csv(path)


def read_raw_maps(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw labelled maps; fails at once if a column of the contract is missing."""
    reader = spark.read.schema(schemas.RAW_MAPS) if fmt == "json" else spark.read
    return require_columns(reader.format(fmt).load(path), schemas.RAW_MAPS.fieldNames())


def read_fixed_width_maps(spark: SparkSession, path: str, size: int = 4096) -> DataFrame:
    """Headerless file of equal-length maps: ``wafer_id`` is the position in the file."""
    return npy.read_npy_maps(spark, path, size)


def read_class_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON object keyed by class, as one row per class. The file is a small dimension."""
    entry = T.StructType([
        T.StructField("korean_name", T.StringType()),
        T.StructField("physical_mechanism", T.StringType()),
        T.StructField("primary_process_stage", T.StringType()),
        T.StructField("equipment_involved", T.ArrayType(T.StringType())),
        T.StructField("critical_parameters", T.ArrayType(T.StructType([
            T.StructField(n, T.StringType()) for n in ("name", "unit", "normal_range", "criticality")
        ]))),
        T.StructField("severity_level", T.StringType()),
        T.StructField("severity_score", T.IntegerType()),
        T.StructField("yield_impact", T.DoubleType()),
        T.StructField("estimated_roi_pct", T.DoubleType()),
        T.StructField("remediation", T.StringType()),
        T.StructField("defect_area_pct", T.DoubleType()),
        T.StructField("spatial_evidence", T.StructType([
            *[T.StructField(n, T.DoubleType()) for n in
              ("center_ratio", "edge_ratio", "ring_ratio", "defect_density", "spatial_entropy")],
            T.StructField("n_samples", T.LongType()),
        ])),
        T.StructField("correlation_evidence", T.StructType([
            T.StructField("top_critical_param", T.StringType()),
            T.StructField("top_pearson_r", T.DoubleType()),
            T.StructField("n_critical_params", T.IntegerType()),
            T.StructField("critical_params", T.ArrayType(T.StringType())),
        ])),
    ])
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", T.MapType(T.StringType(), entry))
    return text.select(F.explode(parsed).alias("failure_type", "m")).select("failure_type", "m.*")


def with_split(maps: DataFrame, manifest: DataFrame, id_col: str = "wafer_id", default: str = "train") -> DataFrame:
    """Attach the manifest's split; maps it does not list are training rows."""
    split: Column = F.coalesce("split", F.lit(default))
    return maps.join(manifest.select(id_col, "split"), id_col, "left").withColumn("split", split)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
