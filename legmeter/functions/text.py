"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

# Fixed value: shape of an object id.
OBJECT_ID = r"^[a-f\d]{24}$"


def is_object_id(value: Column) -> Column:
    return value.rlike(OBJECT_ID)


def title_case_columns(df: DataFrame) -> DataFrame:
    """``order_number`` becomes ``Order Number``, for sheets read by people."""
    return df.toDF(*[" ".join(part.title() for part in name.split("_")) for name in df.columns])
