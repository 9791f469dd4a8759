"""Sinks: Parquet lake tables, CSV and JSON results, catalog objects, storage report."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabspark import schemas
from fabspark.constants import ALERT_LEVELS

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes keep a file open per folder here, also in a session that would sort each task's rows."""
    sorts = spark.conf.get(OPEN_FILES) == "0"
    if sorts:
        spark.conf.set(OPEN_FILES, "32")
    try:
        yield
    finally:
        if sorts:
            spark.conf.unset(OPEN_FILES)


def write_table(df: DataFrame, path: str, name: str | None = None, partition_by: Sequence[str] = (), one_file: bool = False) -> None:
    """Overwrite a Parquet table; ``name`` selects its contract and partition columns.

    With ``one_file`` each folder gets one file: a folder's rows are brought to one task, which
    writes them as they come and holds no more than the files' open row groups.
    """
    if name:
        schema, parts = schemas.TABLES[name]
        df, partition_by = schemas.conform(df, schema), parts
    if one_file:  # a folder is named by the value as text, the empty one as null
        keys = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in partition_by]
        df = df.repartition(*keys) if keys else df.coalesce(1)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _open_files(df.sparkSession):
        writer.parquet(path)


def write_buckets(df: DataFrame, table: str, path: str, key: str, buckets: int, name: str | None = None) -> None:
    """Overwrite a catalog table whose rows lie in ``buckets`` groups by ``key``, sorted within.

    Tables of equal ``buckets`` join on the key without moving a row of either. Rows are dealt to
    the buckets before the write, so a bucket is one file.
    """
    if name:
        df = schemas.conform(df, schemas.TABLES[name][0])
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("compression", "snappy").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row result as JSON."""
    df.write.mode("overwrite").json(path)


def create_catalog(spark: SparkSession, database: str, locations: dict[str, str]) -> None:
    """Database and tables over existing lake folders, with columns from the table contracts."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, location in locations.items():
        spark.sql(schemas.table_ddl(database, table, location))
        if schemas.TABLES[table][1]:
            spark.sql(f"MSCK REPAIR TABLE {database}.{table}")


def create_alert_view(spark: SparkSession, database: str, table: str = "silver") -> None:
    """Persistent view of the defective wafers with their alert level."""
    levels = "".join(
        f" WHEN particle_count > {count} OR cmp_pressure > {force} THEN '{level}'"
        for level, (count, force) in ALERT_LEVELS.items()
    )
    columns = "wafer_id, failure_type, cmp_pressure, particle_count, defect_density"
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.v_spc_alert AS SELECT {columns}, CASE{levels} ELSE 'OK' END AS spc_status "
        f"FROM {database}.{table} WHERE failure_type <> 'none'"
    )


def lake_report(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per layer and table under ``root``; file contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(root).select("path", "length")
    )
    inside = F.regexp_replace("path", "^.*?\\Q" + root.rstrip("/") + "\\E/", "")
    return (
        files.select(F.split(inside, "/").alias("p"), "length")
        .select(F.col("p")[0].alias("layer"), F.col("p")[1].alias("table"), "length")
        .groupBy("layer", "table")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def enrich_classes(dim: DataFrame, spatial: DataFrame, correlation: DataFrame, key: str = "failure_type") -> DataFrame:
    """Class dimension with the measured evidence folded in as structs; all three are per class."""
    s = [c for c in spatial.columns if c != key]
    c = [x for x in correlation.columns if x != key]
    return (
        dim.drop("spatial_evidence", "correlation_evidence")
        .join(spatial.select(key, F.struct(*s).alias("spatial_evidence")), key, "left")
        .join(correlation.select(key, F.struct(*c).alias("correlation_evidence")), key, "left")
    )
