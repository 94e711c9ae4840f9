"""JSON text to typed records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(df: DataFrame, col: str, schema: str, out: str | None = None) -> DataFrame:
    """Decode one record, or a list of records if ``schema`` is an array; malformed text gives null."""
    return df.withColumn(out or col, F.from_json(F.col(col), schema))


def to_json_col(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols))
