"""Label cells: extraction from nested arrays, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.constants import CLASSES, UNKNOWN


def first_label(cell: Column, unknown: str = UNKNOWN) -> Column:
    """First string of a nested label cell; NULL, empty or blank cells become ``unknown``."""
    label = F.get(F.flatten(cell), F.lit(0))
    return F.when(F.length(F.trim(label)) > 0, label).otherwise(F.lit(unknown))


def is_labelled(label: Column, unknown: str = UNKNOWN) -> Column:
    return label != unknown


def split_labelled(df: DataFrame, label: str, unknown: str = UNKNOWN) -> tuple[DataFrame, DataFrame]:
    """Labelled and unlabelled rows, as two lazy filters over one scan."""
    return df.filter(F.col(label) != unknown), df.filter(F.col(label) == unknown)


def keep_known_classes(df: DataFrame, label: str, classes=CLASSES) -> DataFrame:
    return df.filter(F.col(label).isin(list(classes)))


def encode_label(label: Column, classes=CLASSES) -> Column:
    """Class index; NULL for a label outside the list."""
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), label)
    return F.when(position > 0, (position - 1).cast("int"))


def decode_label(index: Column, classes=CLASSES) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index)


def is_defect(label: Column) -> Column:
    return (label != "none").cast("int")


def direction(r: Column) -> Column:
    return F.when(r > 0, "positive").otherwise("negative")
