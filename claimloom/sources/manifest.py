"""Tables whose upserts write what changed: buckets of keys, a log of commits, a manifest of live files.

A row's keys are hashed to one of a fixed number of buckets. An upsert writes the buckets that its rows fall
into to a new folder and commits a manifest that names, for every bucket, the folder which holds it now; the
other buckets' files stay as they are. Manifests are numbered files of a log. A number is taken by at most
one writer, since a commit fails if its file exists. Who loses looks at the newer manifests: if they
left the buckets alone that this upsert has read, its files are still right and it commits behind them; else
it reads those buckets again. So no update is lost, and readers always see one whole manifest.

Null keys match each other; repeated updates of a key count once, the last by ``newest``, then by all columns.
``change_table`` puts together old and new rows in another way, such as adding up. A change may carry the name
and number of a batch: the manifest remembers the last number of each name, and a batch that comes again
changes nothing. A change without rows commits nothing but its number, and makes the table if there is none.
The columns and the number of buckets are those of the first change; others need these columns, in any order.
``vacuum`` removes old manifests and the folders that no kept one names. The log needs a file system that
renames atomically (HDFS) or links (local).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimloom.session import stored
from claimloom.sources.sinks import upsert
from claimloom.sources.storage import create_file, list_files, list_folders, read_file, remove_folder

BUCKET = "_bucket"
SUFFIX = ".json"


@dataclass(frozen=True)
class Manifest:
    """What a table is made of after a commit: the folder of each bucket that has rows."""

    number: int
    schema: str
    keys: tuple[str, ...]  # what is hashed
    buckets: int
    folders: dict[int, str]
    applied: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema, "keys": self.keys, "buckets": self.buckets, "folders": self.folders, "applied": self.applied})


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(SUFFIX)) for n in list_files(spark, f"{path}/log", SUFFIX) if n[0].isdigit())


def read_manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """The newest manifest or an older one; None if there is none."""
    numbers = _numbers(spark, path)
    if not numbers or number not in (None, *numbers):
        return None
    number = numbers[-1] if number is None else number
    found = json.loads(read_file(spark, f"{path}/log/{number:020d}{SUFFIX}"))
    return Manifest(number, found["schema"], tuple(found["keys"]), found["buckets"], {int(b): f for b, f in found["folders"].items()}, found["applied"])


def commit(spark: SparkSession, path: str, manifest: Manifest) -> bool:
    """Write a manifest as the next of the log; False if another writer has its number."""
    return create_file(spark, f"{path}/log/{manifest.number:020d}{SUFFIX}", manifest.to_json())


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str, manifest: Manifest, only: Sequence[int] | None = None) -> DataFrame:
    """The rows of a table, or of some of its buckets."""
    schema = StructType.fromJson(json.loads(manifest.schema))
    folders = sorted(f"{path}/{f}" for b, f in manifest.folders.items() if only is None or b in only)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of a commit, the last one by default."""
    manifest = read_manifest(spark, path, number)
    if manifest is None:
        raise FileNotFoundError(f"no committed table in {path}")
    return read_buckets(spark, path, manifest)


def _write_buckets(rows: DataFrame, path: str, manifest: Manifest) -> dict[int, str]:
    """Write rows by bucket to a new folder; the folder of each bucket."""
    folder = f"data/{uuid.uuid4().hex}"
    dealt = rows.withColumn(BUCKET, bucket_of(manifest.keys, manifest.buckets)).hint("rebalance", F.col(BUCKET))
    dealt.write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    names = [n for n in list_folders(rows.sparkSession, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")]
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in names}


def touched_buckets(rows: DataFrame, manifest: Manifest) -> list[int]:
    """The buckets that some rows fall into."""
    return sorted(r[0] for r in rows.select(bucket_of(manifest.keys, manifest.buckets)).distinct().collect())


def change_table(
    path: str,
    updates: DataFrame,
    spread: Sequence[str],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = 64,
    batch: tuple[str, int] | None = None,
    attempts: int = 20,
) -> int:
    """Replace the rows of the buckets that updates fall into by ``combine(old rows, updates)``.

    ``spread``: the columns that choose a row's bucket, part of what ``combine`` goes by. Returns the number of
    the commit. ``attempts``: how often other writers may come first; RuntimeError beyond that, with
    nothing changed.
    """
    spark = updates.sparkSession
    updates = stored(updates, "updates")
    written: dict[int, str] = {}
    based: Manifest | None = None
    for _ in range(attempts):
        now = read_manifest(spark, path) or Manifest(-1, updates.schema.json(), tuple(spread), buckets, {})
        if tuple(spread) != now.keys:
            raise ValueError(f"the table's keys are {now.keys}")
        if batch is not None and now.applied.get(batch[0], -1) >= batch[1]:
            return now.number
        schema = StructType.fromJson(json.loads(now.schema))
        rows = updates.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
        if based is None:
            stale = touched = touched_buckets(rows, now)
        else:
            stale = [b for b in touched if now.folders.get(b) != based.folders.get(b)]
        if not touched and now.number >= 0 and batch is None:
            return now.number
        if stale:
            mine = rows.where(bucket_of(now.keys, now.buckets).isin(stale))
            written |= _write_buckets(combine(read_buckets(spark, path, now, stale), mine), path, now)
        based = now
        applied = now.applied if batch is None else now.applied | dict([batch])
        if commit(spark, path, replace(now, number=now.number + 1, folders={**now.folders, **written}, applied=applied)):
            return now.number + 1
    raise RuntimeError(f"other writers came first {attempts} times")


def upsert_table(path: str, updates: DataFrame, keys: Sequence[str], newest: Sequence[str] = (), buckets: int = 64, attempts: int = 20) -> int:
    """Replace or add the rows of some keys; returns the number of the commit."""
    return change_table(path, updates, keys, lambda old, new: upsert(old, new, keys, newest), buckets, attempts=attempts)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest manifests, and the data folders that these do not name; readers of older ones
    and writers must have finished. Returns the folders."""
    numbers = _numbers(spark, path)
    old, kept = numbers[: -max(1, keep)], [read_manifest(spark, path, n) for n in numbers[-max(1, keep) :]]
    for number in old:
        remove_folder(spark, f"{path}/log/{number:020d}{SUFFIX}")
    live = {f for m in kept for f in m.folders.values()}
    gone = []
    for folder in list_folders(spark, f"{path}/data"):
        held = list_folders(spark, f"{path}/data/{folder}")
        dead = [n for n in held if f"data/{folder}/{n}" not in live]
        gone += [f"data/{folder}/{n}" for n in dead]
        for name in [f"data/{folder}"] if dead == held else [f"data/{folder}/{n}" for n in dead]:
            remove_folder(spark, f"{path}/{name}")
    return gone
