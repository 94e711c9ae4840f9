"""Typed projections of text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimloom.session import stored

AMOUNT = "decimal(38,6)"


def to_type(col: Column, dtype: str, on_error: str = "fail") -> Column:
    return col.cast(dtype) if on_error == "fail" else col.try_cast(dtype)


def cast_columns(df: DataFrame, types: Mapping[str, str], on_error: str = "fail") -> DataFrame:
    """Cast named columns in place; with ``on_error="null"`` malformed text becomes null."""
    return df.withColumns({c: to_type(F.col(c), t, on_error) for c, t in types.items()})


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row: for each column how many non-null values do not convert."""
    return df.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()]
    )


def cast_cells(df: DataFrame, types: Mapping[str, str], keys: Sequence[str], stage: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows with columns cast, the cells that do not convert, and how many of these each column has.

    Cells that do not convert are null in the rows, and a row ``(stage, keys, column, text)`` of the second
    frame. All columns are cast in one pass, which is stored; the counts are observed while it is written.
    Null cells are no rejects. Keys that are cast themselves keep their text in the second frame.
    """
    failed = {c: F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull() for c, t in types.items()}
    cells = F.array_compact(F.array(*[F.when(f, F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("text"))) for c, f in failed.items()]))
    cast = [F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    seen = Observation()
    counts = [F.count_if(f).alias(c) for c, f in failed.items()]
    names = F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_keys")
    both = stored(df.observe(seen, *counts).select(F.struct(*cast).alias("_row"), names, cells.alias("_cells")), "casts")
    rejects = both.select("_keys", F.explode("_cells").alias("_cell")).select(F.lit(stage).alias("stage"), "_keys.*", "_cell.column", "_cell.text")
    return both.select("_row.*"), rejects, seen.get


def abs_amount(col: Column, dtype: str = AMOUNT, on_error: str = "fail") -> Column:
    return F.abs(to_type(col, dtype, on_error))
