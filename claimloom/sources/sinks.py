"""Writers. File counts follow the data: no single-file coalesce, skewed partitions are split."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.sources.versions import read_current, snapshot_replace, versions

FOLDER = "folder"  # names the folders of an export


def write_zone(
    df: DataFrame, path: str, mode: str = "append", target_rows_per_file: int = 0, balance: bool = False
) -> None:
    """Parquet files without a shuffle; ``balance`` evens out many small or skewed tasks first.

    Readers of the legacy decimal layout need ``spark.sql.parquet.writeLegacyFormat`` on the session.
    """
    writer = (df.hint("rebalance") if balance else df).write.mode(mode)
    if target_rows_per_file:
        writer = writer.option("maxRecordsPerFile", target_rows_per_file)
    writer.parquet(path)


def replace_partition(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in the data.

    Rebalancing by the partition columns gives few files per partition and still splits a
    partition that holds most of the rows.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in columns])
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def export_csv_by(df: DataFrame, column: str, path: str, rows_per_file: int = 0) -> None:
    """One folder of CSV files with header per value of the column, written by one job.

    The column is also in the files: a reader of one file needs it, and a folder name has no type.
    """
    folder = FOLDER if column != FOLDER else f"{FOLDER}_"
    balanced = df.withColumn(folder, F.col(column)).hint("rebalance", F.col(column))
    writer = balanced.write.mode("overwrite").partitionBy(folder).options(header=True, escape='"')
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_files(files: DataFrame, root: str, path: str = "path", text: str = "value") -> int:
    """One small file per row, its text at ``<root>/<path>``; returns how many were written.

    Files go to any file system that pyarrow knows by its URI. A task that runs again writes the same
    files again; paths must be unique.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        made: set[str] = set()
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folder, _, _ = f"{base}/{name}".rpartition("/")
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write((content or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.select(path, text).mapInArrow(put, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def fan_out(df: DataFrame, batch: str, zones: Sequence[str]) -> None:
    """Write one batch to several zones, each below ``batch=<name>``; a repeated run replaces it.

    The source is read once: the other zones are fed from the batch as stored, not from a cache
    that lost executors would take along.
    """
    first, *others = [f"{zone}/batch={batch}" for zone in zones]
    df.write.mode("overwrite").parquet(first)
    stored = df.sparkSession.read.parquet(first)
    for path in others:
        stored.write.mode("overwrite").parquet(path)


def one_per_key(updates: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last one by the columns ``newest``, then by all columns."""
    order = [F.desc_nulls_last(c) for c in [*newest, *(c for c in updates.columns if c not in (*keys, *newest))]]
    ranked = updates.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order or [F.lit(1)])))
    return ranked.filter("_rank = 1").drop("_rank")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Target with matching keys replaced; null keys match each other, repeated updates count once.

    The updates are read twice, so store them first if they are more than a scan.
    """
    once = one_per_key(updates, keys, newest)
    named = once.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return target.join(named, same, "left_anti").unionByName(once)


def upsert_version(path: str, updates: DataFrame, keys: Sequence[str], version: str, newest: Sequence[str] = ()) -> None:
    """Upsert into a versioned table; the result is its next version, the first one if there is none."""
    spark = updates.sparkSession
    current = read_current(spark, path) if versions(spark, path) else updates.limit(0)
    snapshot_replace(upsert(current, updates, keys, newest), path, version)
