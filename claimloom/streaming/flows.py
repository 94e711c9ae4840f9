"""Streams over arriving files. A checkpoint is the acknowledgement: what it records is not read again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from claimloom.functions.dates import week_ending
from claimloom.operators.forecast import forecast_regions
from claimloom.operators.incremental import delta, latest_per_key
from claimloom.session import stored
from claimloom.sources import manifest
from claimloom.sources.sinks import replace_partition
from claimloom.sources.storage import exists, list_folders, remove_folder
from claimloom.sources.versions import prune, read_current, versions, write_version

MAX_MESSAGES = 20
BATCH = "batch="


def _start(stream: DataFrame, checkpoint: str, once: bool):
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer


def parse_events(lines: DataFrame, schema: str) -> DataFrame:
    """``event`` (null if it cannot be read) and ``raw`` for lines of JSON in a column ``value``.

    The event is the record itself or what its ``body`` holds: an object, or the text of one. Malformed
    text, values of another type and bodies that are no object give no event.
    """
    strict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    outer = F.from_json("value", f"{schema}, body string, _corrupt string", strict)
    read = lines.select(F.col("value").alias("raw"), outer.alias("outer"))
    body = F.from_json("outer.body", f"{schema}, _corrupt string", strict)
    read = read.select("raw", "outer", F.when(F.col("outer.body").isNotNull(), body).alias("body"))
    fields = StructType.fromDDL(schema).names
    is_object = F.trim("outer.body").startswith("{")
    inner = F.when(is_object & F.col("body._corrupt").isNull(), F.struct(*[F.col(f"body.{c}") for c in fields]))
    plain = F.struct(*[F.col(f"outer.{c}") for c in fields])
    event = F.when(F.col("outer.body").isNotNull(), inner).otherwise(plain)
    readable = F.col("outer._corrupt").isNull() & F.trim("raw").startswith("{")
    return read.select("raw", F.when(readable, event).alias("event"))


def log_stream(
    spark: SparkSession, folder: str, schema: str, out: str, rejects: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Persist arriving JSON events with their text as parquet; lines without an event go to ``rejects``.

    Both are stored below the number of their batch, so a repeated batch replaces itself.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch, schema)
        parsed.filter(F.col("event").isNotNull()).select("event.*", "raw").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        parsed.filter(F.col("event").isNull()).select("raw").write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")

    return _start(spark.readStream.text(folder), checkpoint, once).foreachBatch(store).start()


def drain(
    spark: SparkSession,
    folder: str,
    schema: str,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    max_files: int = MAX_MESSAGES,
    once: bool = True,
) -> StreamingQuery:
    """Take waiting messages in batches of at most ``max_files`` and process each batch."""
    messages = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)
    return _start(messages, checkpoint, once).foreachBatch(process).start()


def delta_stream(
    source: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    out: str,
    checkpoint: str,
    low: str | None = None,
    high: str | None = None,
    tie: Sequence[str] | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Keep the newest row per key of a stream of changes.

    Each micro-batch is reduced to one row per key and stored as its own batch, replaced if the
    batch is retried. Nothing is rewritten per batch: ``merged`` picks the newest rows when read,
    ``compact`` folds the batches into a new version now and then.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch if low is None else delta(batch, changed_at, low, high)
        newest = latest_per_key(rows, keys, changed_at, tie)
        newest.write.mode("overwrite").parquet(f"{out}/batches/{BATCH}{batch_id:020d}")

    return _start(source, checkpoint, once).foreachBatch(store).start()


def merged(
    spark: SparkSession, out: str, schema: str, keys: Sequence[str], changed_at: str, tie: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key over the compacted version and the batches after it."""
    batches = spark.read.schema(f"{schema}, batch bigint").option("basePath", f"{out}/batches").parquet(f"{out}/batches")
    base = f"{out}/base"
    done = versions(spark, base) if exists(spark, base) else []
    if not done:
        return latest_per_key(batches.drop("batch"), keys, changed_at, tie)
    newer = batches.filter(F.col("batch") > int(done[-1])).drop("batch")
    return latest_per_key(read_current(spark, base).unionByName(newer), keys, changed_at, tie)


def compact(
    spark: SparkSession, out: str, schema: str, keys: Sequence[str], changed_at: str, tie: Sequence[str] | None = None
) -> None:
    """Fold all stored batches into a new base version named after the last batch; folded batches go.

    Readers of the batches must have finished, as for ``prune``.
    """
    stored = [n for n in list_folders(spark, f"{out}/batches") if n.startswith(BATCH)]
    if not stored:
        return
    last = max(stored)
    write_version(merged(spark, out, schema, keys, changed_at, tie), f"{out}/base", last[len(BATCH) :])
    prune(spark, f"{out}/base")
    for name in stored:
        if name < last:  # the last one stays, so that the folder keeps its layout
            remove_folder(spark, f"{out}/batches/{name}")


def fold_weeks(weeks: DataFrame, state: str, batch_id: int, buckets: int = 64) -> DataFrame:
    """Add weekly sums ``(region, day, y)`` to a state; returns all weeks of the regions that they are of.

    The state has one row per region and week, in buckets of regions: a batch rewrites the buckets of its
    regions, and old folders go, so neither rows nor files grow with the batches. A batch that was added
    before is not added again.
    """

    def add_up(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.unionByName(new).groupBy("region", "day").agg(F.sum("y").cast(old.schema["y"].dataType).alias("y"))

    session = weeks.sparkSession
    weeks = stored(weeks, "week-sums")
    manifest.change_table(state, weeks, ["region"], add_up, buckets, ("weeks", batch_id))
    manifest.vacuum(session, state)
    now = manifest.read_manifest(session, state)
    mine = manifest.read_buckets(session, state, now, manifest.touched_buckets(weeks, now))
    changed = weeks.select(F.col("region").alias("changed")).distinct()
    return mine.join(changed, F.col("region").eqNullSafe(F.col("changed")), "left_semi")


def retrain_stream(
    spark: SparkSession,
    folder: str,
    schema: str,
    out: str,
    state: str,
    checkpoint: str,
    load_date: str,
    after: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Refresh the forecast of each region for which files arrive below ``region=<name>/``.

    A batch's weekly sums are folded into the state, and the series of the regions in the batch are built
    from it: arrivals are read once, and what is read again is one row per region and week. Forecasts are
    kept per region and load date, so a refresh replaces that date's rows only.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(F.col("day").isNotNull() & F.col("y").isNotNull())
        if after is not None:
            known = known.filter(F.col("day") > F.lit(after).cast("date"))
        # week ends stand for their days
        sums = known.groupBy("region", week_ending(F.col("day")).alias("day")).agg(F.sum("y").alias("y"))
        replace_partition(forecast_regions(fold_weeks(sums, state, batch_id), load_date), out, ["Region", "Load_date"])

    arrivals = spark.readStream.schema(f"{schema}, region string").parquet(folder)
    return _start(arrivals, checkpoint, once).foreachBatch(refresh).start()
