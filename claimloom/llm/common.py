"""Column expressions and plans that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# a word: no ASCII white space in it; bytes.split() of UTF-8 text gives the same words
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def row_key(*columns: Column) -> Column:
    """16 bytes that tell rows apart by the values of some columns, nulls included."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts).cast("binary")))


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """Some hex digits (15 at most) of a hex string as a long."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of some batches in pieces of about ``size`` bytes, one row at least, so that what a task
    makes of a piece stays small whatever the session's batch size is."""
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def arrow_map(df: DataFrame, function: Callable, schema: str, size: int = 4 << 20) -> DataFrame:
    """mapInArrow with a function from a record batch of about ``size`` bytes to a dict of columns, or None
    for no rows."""
    kinds = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size):
            if (columns := function(batch)) is not None:
                yield pa.RecordBatch.from_arrays([as_array(columns[f.name], f.type) for f in kinds], schema=kinds)

    return df.mapInArrow(run, schema)


def worker_memory() -> dict:
    """What a Python worker keeps from task to task; the globals of functions that travel by value are new in each."""
    return vars(sys.modules.setdefault("_claimloom_worker", ModuleType("_claimloom_worker"))).setdefault("memory", {})


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes, empty for null."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def total_before(table: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of a column over the rows before this one; for tables of totals, which are small."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0).cast("long")))


def running_start(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column | str], size: str, name: str) -> DataFrame:
    """Where each row starts if the rows of a group are laid end to end in the order (bucket, order).

    A group may hold most of the table, so its rows are summed bucket by bucket and each bucket is laid
    out by itself; only the totals of the buckets meet in one task per group.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.sum(size).alias("_sum"))
    starts = total_before(totals, group, [bucket], "_sum", "_start").drop("_sum")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    laid = df.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0).cast("long")))
    return laid.join(starts, keys).withColumn(name, F.col("_start") + F.col("_inside")).drop("_start", "_inside")
