"""Table contracts of the lake; writers conform frames to them so that drift fails loudly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fabspark.constants import PARAMS, SPC_LIMITS

_I, _D, _S, _B = T.IntegerType(), T.DoubleType(), T.StringType(), T.BinaryType()
_L = T.LongType()  # ids outgrow 32 bits at lake scale


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


MAP_FEATURES = [
    ("defect_density", _D), ("active_ratio", _D), ("edge_defect_ratio", _D),
    ("center_defect_ratio", _D), ("radial_mean", _D), ("defect_count", _I), ("active_count", _I),
]
OOC_FLAGS = [(f"{p}_ooc", _I) for p in SPC_LIMITS]

RAW_MAPS = _struct(
    ("wafer_id", _L), ("die_size", _D), ("lot_name", _S), ("wafer_index", _D),
    ("train_test_label", T.ArrayType(T.ArrayType(_S))),
    ("failure_type", T.ArrayType(T.ArrayType(_S))),
    ("map", _struct(("rows", _I), ("cols", _I), ("cells", _B))),
)
RAW_BRONZE = _struct(
    ("wafer_id", _L), ("lot_id", _S), ("wafer_index", _I), ("die_size", T.FloatType()), ("map_rows", _I),
    ("map_cols", _I), ("cells", _B), ("failure_type", _S), ("original_split", _S), ("is_labeled", _I),
)
SPLIT_MANIFEST = _struct(("wafer_id", _L), ("split", _S))
# Order of the columns in the parameter file.
PARAM_FILE = _struct(
    *[(p, _D) for p in PARAMS], ("defect_class", _S), ("wafer_id", _L), ("is_defect", _I),
)
BRONZE_MAPS = _struct(
    ("wafer_id", _L), ("class_idx", _I), ("failure_type", _S), ("split", _S),
    ("wafer_map_flat", _B), *MAP_FEATURES,
)
BRONZE_PARAMS = _struct(
    ("wafer_id", _L), *[(p, _D) for p in PARAMS], ("defect_class", _S), ("is_defect", _I), *OOC_FLAGS,
)
SILVER = _struct(
    ("wafer_id", _L), ("class_idx", _I), ("failure_type", _S), ("split", _S),
    ("wafer_map_flat", _B), *MAP_FEATURES, *[(p, _D) for p in PARAMS], *OOC_FLAGS, ("any_ooc", _I),
)
FEATURE_STORE = T.StructType([f for f in SILVER.fields if f.name != "wafer_map_flat"])
SPC = _struct(
    ("wafer_id", _L), ("failure_type", _S), ("split", _S), ("defect_density", _D),
    *[(p, _D) for p in SPC_LIMITS], *[(f"{p}_roll25", _D) for p in SPC_LIMITS],
)
SPC_SUMMARY = _struct(
    ("failure_type", _S), ("wafer_count", T.LongType()), ("defect_count", T.LongType()),
    ("defect_rate", _D), ("avg_defect_density", _D), *[(f"cpk_{p}", _D) for p in SPC_LIMITS],
)

# table -> (schema, partition columns)
TABLES = {
    "raw_maps": (RAW_BRONZE, ["is_labeled"]),
    "bad_maps": (RAW_BRONZE, []),
    "bronze_maps": (BRONZE_MAPS, ["failure_type"]),
    "bronze_params": (BRONZE_PARAMS, []),
    "silver": (SILVER, ["failure_type"]),
    "gold": (SILVER, ["split"]),
    "gold_feature_store": (FEATURE_STORE, ["split"]),
    "gold_spc": (SPC, []),
    "gold_spc_summary": (SPC_SUMMARY, []),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; a missing column or a lossy type raises."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:  # DataFrame.to would fill nullable columns with NULL
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.to(schema)


def table_ddl(database: str, table: str, location: str) -> str:
    """``CREATE TABLE`` text for one lake table, derived from its schema."""
    schema, parts = TABLES[table]
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    partitioned = f"\nPARTITIONED BY ({', '.join(parts)})" if parts else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {database}.{table} (\n  {cols}\n)\n"
        f"USING PARQUET{partitioned}\nLOCATION '{location}'"
    )
