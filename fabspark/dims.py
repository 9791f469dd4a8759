"""Fixed-size dimension tables. Their row counts are set by the class and parameter lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fabspark import constants as C
from fabspark.session import local_frame


def class_dim(spark: SparkSession) -> DataFrame:
    rows = [
        (i, c, level, score, impact, roi, C.SEVERITY_INDEX[level], C.SEVERITY_CONFIDENCE[level])
        for i, c in enumerate(C.CLASSES)
        for level, score, impact, roi in [C.CLASS_META[c]]
    ]
    return local_frame(
        spark,
        rows,
        "class_idx int, failure_type string, severity_level string, severity_score int, "
        "yield_impact double, estimated_roi_pct double, severity_idx int, confidence double",
    )


def param_limits(spark: SparkSession) -> DataFrame:
    rows = [(p, lo, hi, "spc") for p, (lo, hi) in C.SPC_LIMITS.items()]
    rows += [(p, v[2], v[3], "display") for p, v in C.DISPLAY_PARAMS.items()]
    return local_frame(spark, rows, "param string, lcl double, ucl double, limit_set string")


def param_cost(spark: SparkSession) -> DataFrame:
    rows = [(p, *C.PARAM_BOUNDS[p], C.PARAM_COST[p]) for p in C.PARAMS]
    return local_frame(spark, rows, "param string, lo double, hi double, unit_cost double")


def stage_relevance(spark: SparkSession) -> DataFrame:
    rows = [
        (stage, cls, rel)
        for cls, rels in C.STAGE_RELEVANCE.items()
        for stage, rel in zip(C.PROCESS_STAGES, rels)
    ]
    return local_frame(spark, rows, "stage string, failure_type string, relevance int")
