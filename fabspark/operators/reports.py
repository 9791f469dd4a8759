"""Class reports: detections joined to the class and stage dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabspark import dims
from fabspark.constants import CLASSES
from fabspark.operators.quality import unknown_keys
from fabspark.session import broadcast_if_small


def severity_report(spark: SparkSession, detected: DataFrame, class_col: str) -> DataFrame:
    """Per detected class except ``none``: severity, confidence, yield loss and priority.

    Rows are counted per class before the dimension (nine rows) is joined. A class that the
    dimension lacks raises an error that names it.
    """
    require_known(spark, detected, class_col)
    counts = detected.groupBy(class_col).agg(F.count("*").alias("n")).withColumn(
        "rate", F.col("n") / F.sum("n").over(Window.partitionBy()))
    dim = F.broadcast(dims.class_dim(spark).withColumnRenamed("failure_type", class_col))
    order = Window.orderBy(F.desc("severity_score"), F.asc(class_col))
    return counts.filter(F.col(class_col) != "none").join(dim, class_col).select(
        class_col, "n", "severity_score", "severity_idx", "confidence",
        (F.col("rate") * F.col("yield_impact") * 100).alias("yield_loss_pct"),
        F.row_number().over(order).alias("priority"),
    )


def defect_report(detected: DataFrame, metadata: DataFrame, class_col: str) -> DataFrame:
    """Per detected class: rate, loss, and what the class metadata says, most severe first.

    ``metadata`` is one row per class, as ``readers.read_class_metadata`` returns it; a class it
    lacks raises an error that names it. ``none`` is left out.
    """
    _no_unknown(detected, class_col, metadata.withColumnRenamed("failure_type", class_col))
    counts = detected.groupBy(class_col).agg(F.count("*").alias("n")).withColumn(
        "defect_rate", F.col("n") / F.sum("n").over(Window.partitionBy()))
    known = broadcast_if_small(metadata.withColumnRenamed("failure_type", class_col))
    return counts.filter(F.col(class_col) != "none").join(known, class_col).select(
        class_col, "korean_name", "n", "defect_rate", "physical_mechanism", F.col("primary_process_stage").alias("process_stage"),
        F.col("severity_level").alias("severity"), "severity_score",
        (F.col("defect_rate") * F.col("yield_impact") * 100).alias("yield_loss_pct"), "estimated_roi_pct",
        "critical_parameters", "remediation", "spatial_evidence",
    ).orderBy(F.desc("severity_score"), F.asc(class_col))


def stage_load(spark: SparkSession, detected: DataFrame, class_col: str) -> DataFrame:
    """Detections weighted by stage relevance, one column per class; an unknown class raises."""
    require_known(spark, detected, class_col)
    counts = detected.groupBy(class_col).agg(F.count("*").alias("n"))
    bridge = F.broadcast(dims.stage_relevance(spark).withColumnRenamed("failure_type", class_col))
    return counts.join(bridge, class_col).groupBy("stage").agg(*[
        F.max(F.when(F.col(class_col) == c, F.col("relevance") * F.col("n"))).alias(c) for c in CLASSES if c != "none"
    ])


def require_known(spark: SparkSession, detected: DataFrame, class_col: str) -> DataFrame:
    """``detected``, or an error that names classes the dimension lacks."""
    return _no_unknown(detected, class_col, dims.class_dim(spark).withColumnRenamed("failure_type", class_col))


def _no_unknown(detected: DataFrame, class_col: str, dim: DataFrame) -> DataFrame:
    extra = [row[0] for row in unknown_keys(detected.select(class_col).distinct(), class_col, dim).limit(20).collect()]
    if extra:
        raise ValueError(f"unknown classes: {', '.join(map(str, extra))}")
    return detected


def with_targets(spark: SparkSession, rows: DataFrame, class_col: str) -> DataFrame:
    """Add severity index and confidence of the row's class."""
    dim = dims.class_dim(spark).select(F.col("failure_type").alias(class_col), "severity_idx", "confidence")
    return rows.join(F.broadcast(dim), class_col, "left")
