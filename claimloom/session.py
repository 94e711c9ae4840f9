"""Session settings and the folder every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from claimloom.sources.storage import remove_folder

_made: list[str] = []  # work folders of this process that have not been removed

# Only settings that change results or plans; sizes belong to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle behind the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows of one key compress well, so a partition that is slow to join may be small in bytes
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hash instead of sort where every shuffled partition turned out to be this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def build_session(app: str = "claimloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="claimloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before; ``remove_work`` removes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_work(spark: SparkSession) -> int:
    """Remove all folders that ``work_path`` has named so far, once no frame that reads them is needed.

    Frames are lazy, so only their user knows when; a job does it after writing its last result.
    """
    removed = 0
    while _made:
        remove_folder(spark, _made.pop())
        removed += 1
    return removed


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once below the shared folder and read back.

    For results that several plans use: they are computed once, survive lost executors, are read
    column by column, and Spark knows their real size when it picks joins.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
