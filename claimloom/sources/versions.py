"""Tables kept as complete versions.

Every write goes to a new folder ``version=<number>_<name>``, numbered in the order of the writes, and
counts once Spark has committed it (``_SUCCESS``). Readers take the newest committed folder, so a table is
never seen empty, half written or twice, and writing a name again replaces what readers see without
touching the folder they read. Names have no order of their own. ``prune`` removes old folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from claimloom.sources.storage import exists, list_folders, remove_folder

PREFIX = "version="


def _folders(spark: SparkSession, path: str, committed: bool = True) -> list[str]:
    """Version folders, oldest first."""
    names = sorted(n for n in list_folders(spark, path) if n.startswith(PREFIX))
    return [n for n in names if not committed or exists(spark, f"{path}/{n}/_SUCCESS")]


def _name(folder: str) -> str:
    return folder.split("_", 2)[2]


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed versions, oldest first."""
    return [_name(f) for f in _folders(spark, path)]


def write_version(df: DataFrame, path: str, version: str) -> str:
    """Write a version; returns its folder."""
    taken = _folders(df.sparkSession, path, committed=False)
    number = int(taken[-1][len(PREFIX) :].split("_")[0]) + 1 if taken else 0
    folder = f"{PREFIX}{number:012d}_{uuid.uuid4().hex[:8]}_{version}"
    df.write.parquet(f"{path}/{folder}")
    return folder


def read_current(spark: SparkSession, path: str) -> DataFrame:
    committed = _folders(spark, path)
    if not committed:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(f"{path}/{committed[-1]}")


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest versions and what failed writes left before them.

    At least the newest version stays; readers of a removed one must have finished.
    """
    kept = _folders(spark, path)[-max(1, keep) :]
    old = [f for f in _folders(spark, path, committed=False) if kept and f < kept[0]]
    for folder in old:
        remove_folder(spark, f"{path}/{folder}")
    return [_name(f) for f in old]


def snapshot_replace(df: DataFrame, path: str, version: str, keep: int = 2) -> None:
    """Full copy of a table; the previous copy stays readable until the new one is committed."""
    write_version(df, path, version)
    prune(df.sparkSession, path, keep)
