"""Incremental and snapshot loads with high-water marks and row counts."""

from __future__ import annotations

import math
import queue
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.config.schemas import LOAD_COUNT, LOAD_STATUS, MARK
from claimloom.config.tables import DELTA, TableSpec
from claimloom.sources.readers import empty
from claimloom.sources.sinks import fan_out
from claimloom.sources.storage import exists
from claimloom.sources.versions import snapshot_replace

Reader = Callable[[TableSpec], DataFrame]


def delta(df: DataFrame, changed_at: str, low, high=None) -> DataFrame:
    """Rows changed after ``low`` and, if given, up to and including ``high``."""
    changed = F.col(changed_at)
    newer = changed > F.lit(low)
    return df.filter(newer if high is None else newer & (changed <= F.lit(high)))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], changed_at: str, tie: Sequence[str] | None = None
) -> DataFrame:
    """The newest row per key.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a key
    that holds most of the rows does not end in one task. Ties go to the ``tie`` columns, else to a
    hash of the row, so that a retry picks the same row.
    """
    rest = [c for c in df.columns if c not in keys]
    ties = [F.desc(c) for c in tie] if tie else [F.xxhash64(*rest).desc()]
    newest = Window.partitionBy(*keys).orderBy(F.desc(changed_at), *ties)
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def table_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("int").alias("TotalCount")).withColumn("TableName", F.lit(name))


def all_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, one row each."""
    counts = [table_count(df, name) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts, empty(spark, LOAD_COUNT))


def reconcile(source_counts: DataFrame, loaded_counts: DataFrame) -> DataFrame:
    """Source and loaded counts side by side; tables missing on one side count as zero there."""
    source = source_counts.withColumnRenamed("TotalCount", "source_rows")
    loaded = loaded_counts.withColumnRenamed("TotalCount", "loaded_rows")
    both = source.join(loaded, "TableName", "full_outer").na.fill(0, ["source_rows", "loaded_rows"])
    return both.withColumn("diff", F.col("source_rows") - F.col("loaded_rows"))


def read_mark(spark: SparkSession, path: str, source: str, default: str) -> str:
    """Highest stored mark of a source; the default if there is none.

    A plain value rather than a sub-query: as a literal it is pushed down to the source.
    """
    if not exists(spark, path):
        return default
    marks = spark.read.schema(MARK).parquet(path).filter(F.col("source") == source)
    return marks.agg(F.coalesce(F.max("mark").cast("string"), F.lit(default))).first()[0]


def advance_mark(spark: SparkSession, path: str, source: str, mark: str, run_at: str) -> None:
    """Append the new mark; call it after every table of the source has been written."""
    row = spark.range(1).select(
        F.lit(source).alias("source"),
        F.lit(mark).cast("timestamp").alias("mark"),
        F.lit(run_at).cast("timestamp").alias("run_at"),
    )
    row.write.mode("append").parquet(path)


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a frame and return its row count, observed during the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def error_text(error: Exception) -> str:
    """Class and first line of the message."""
    lines = str(error).strip().splitlines()
    return f"{type(error).__name__}: {lines[0]}" if lines else type(error).__name__


def run_isolated(spark: SparkSession, tasks: dict[str, Callable[[], int]], parallel: int = 4, seconds: float | None = None) -> DataFrame:
    """Run independent loads; a failing one is reported as a row and does not stop the others.

    Each load has a thread, a scheduler pool (used if ``spark.scheduler.mode`` is FAIR) and a job tag of its
    own. After ``seconds`` the jobs with its tag are cancelled, its row says so, and its place goes to the next
    load, also if it hangs outside of Spark. What such a load writes later is replaced by its next run.
    """
    context, run = spark.sparkContext, uuid.uuid4().hex
    outcomes: queue.Queue[tuple] = queue.Queue()
    rows: dict[str, tuple] = {}
    waiting, until = list(tasks), {}

    def attempt(name: str) -> None:
        try:
            context.setLocalProperty("spark.scheduler.pool", name)
            context.addJobTag(f"{run}-{name}")
            outcomes.put((name, True, tasks[name](), None))
        except Exception as error:  # noqa: BLE001 - any failure of a source becomes its status
            outcomes.put((name, False, None, error_text(error)))

    while waiting or until:
        while waiting and len(until) < parallel:
            name = waiting.pop(0)
            until[name] = time.monotonic() + seconds if seconds is not None else math.inf
            InheritableThread(attempt, args=(name,), daemon=True).start()
        left = min(until.values()) - time.monotonic()
        try:
            outcome = outcomes.get(timeout=max(0.0, left) if left < math.inf else None)
            if until.pop(outcome[0], None) is not None:
                rows[outcome[0]] = outcome
        except queue.Empty:
            for name in [n for n, end in until.items() if end <= time.monotonic()]:
                context.cancelJobsWithTag(f"{run}-{name}")
                del until[name]
                rows[name] = (name, False, None, f"TimeoutError: not done after {seconds:g} seconds")
    return spark.createDataFrame([rows[name] for name in tasks], LOAD_STATUS)


def load_task(spec: TableSpec, reader: Reader, out: str, low: str, high: str | None, version: str) -> Callable[[], int]:
    """The load of one table as a callable that returns the rows written.

    A delta goes to its own batch folder, replaced if the run is repeated, and to the zones in
    ``also_to``; a snapshot becomes a new version of the table.
    """
    path = f"{out}/{spec.name}"

    def load() -> int:
        rows = reader(spec)
        if spec.mode == DELTA:
            batch = delta(rows, spec.changed_at, low, high)
            return counted_write(batch, lambda df: fan_out(df, version, [path, *spec.also_to]))
        return counted_write(rows, lambda df: snapshot_replace(df, path, version))

    return load


def run_loads(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    reader: Reader,
    out: str,
    low: str,
    high: str | None,
    version: str,
    parallel: int = 4,
    seconds: float | None = None,
) -> DataFrame:
    """Load every table by its mode; one status row ``(source, ok, rows, error)`` each."""
    tasks = {s.name: load_task(s, reader, out, low, high, version) for s in specs}
    return run_isolated(spark, tasks, parallel, seconds)


def load_source(
    spark: SparkSession,
    source: str,
    specs: Sequence[TableSpec],
    reader: Reader,
    out: str,
    marks: str,
    high: str,
    first_mark: str = "1900-01-01",
    seconds: float | None = None,
) -> DataFrame:
    """One incremental run: read the mark, load all tables, advance the mark if all succeeded."""
    low = read_mark(spark, marks, source, first_mark)
    version = "".join(ch for ch in high if ch.isdigit())
    status = run_loads(spark, specs, reader, out, low, high, version, seconds=seconds)
    if status.filter(~F.col("ok")).isEmpty():
        advance_mark(spark, marks, source, high, high)
    return status


def latest_per_group(files: DataFrame, path: str = "path", suffix: str = ".csv") -> DataFrame:
    """Newest file per folder: time-stamped names, the highest name wins."""
    parts = F.split(F.col(path), "/")
    named = files.filter(F.col(path).endswith(suffix)).select(
        F.try_element_at(parts, F.lit(-2)).alias("folder"), F.col(path).alias("path")
    )
    return named.filter(F.col("folder") != "").groupBy("folder").agg(F.max("path").alias("path"))
