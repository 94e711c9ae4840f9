"""Messages that are acknowledged one by one.

Each message of a batch is handed to a function that returns a result or raises. Messages that fail are tried
again, up to ``attempts`` times in all, and then put aside as dead letters, so one bad message holds up none
of the others. What became of every attempt is stored below its batch and attempt before the next one starts: a
batch that is taken again after a crash goes on where it stopped, and a message that is done is not handed
out again.

The ledger has the message, the attempt, its status (``done``, ``failed``, or ``dead`` for the last failure),
result and error. Null fields are passed as None. Messages are told apart by their place in the ledger, so
equal messages are tried and counted on their own. An empty batch leaves an empty entry.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from claimloom.sources.storage import exists
from claimloom.streaming.flows import MAX_MESSAGES, drain

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTCOME = "attempt int, status string, result string, error string"


def attempt_each(messages: DataFrame, work: Callable[[dict, int], str | None], attempt: int, last: bool) -> DataFrame:
    """The messages with what became of them; an exception is that message's own."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([*messages.schema.fields, *StructType.fromDDL(OUTCOME).fields])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results, errors = [], []
            for message in batch.to_pylist():
                try:
                    result, error = work(message, attempt), None
                except Exception as failure:  # noqa: BLE001
                    result, error = None, f"{type(failure).__name__}: {failure}"
                results.append(result)
                errors.append(error)
            status = ["done" if e is None else "dead" if last else "failed" for e in errors]
            columns = [*batch.columns, pa.array([attempt] * len(status), pa.int32()), *(pa.array(c, pa.string()) for c in (status, results, errors))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    return messages.mapInArrow(run, schema)


def settle_batch(messages: DataFrame, work: Callable[[dict, int], str | None], entry: str, attempts: int) -> int:
    """Try the messages of a batch until each is done or dead; returns the number of attempts made now."""
    session, made, waiting = messages.sparkSession, 0, messages
    schema = StructType([*messages.schema.fields, *StructType.fromDDL(OUTCOME).fields])
    for attempt in range(1, attempts + 1):
        path = f"{entry}/try={attempt}"
        if not exists(session, f"{path}/_SUCCESS"):
            attempt_each(waiting, work, attempt, attempt == attempts).write.mode("overwrite").parquet(path)
            made += 1
        failed = session.read.schema(schema).parquet(path).where("status = 'failed'")
        if failed.isEmpty():
            break
        waiting = failed.select(*messages.columns)
    return made


def drain_each(
    spark: SparkSession,
    folder: str,
    schema: str,
    work: Callable[[dict, int], str | None],
    ledger: str,
    checkpoint: str,
    attempts: int = 3,
    max_files: int = MAX_MESSAGES,
    once: bool = True,
) -> StreamingQuery:
    """Take waiting messages in batches and settle each message; ``work`` gets its fields and the attempt."""

    def settle(batch: DataFrame, batch_id: int) -> None:
        settle_batch(batch, work, f"{ledger}/batch={batch_id:020d}", attempts)

    return drain(spark, folder, schema, settle, checkpoint, max_files, once)


def read_ledger(spark: SparkSession, ledger: str, schema: str) -> DataFrame:
    """All attempts at all messages, with the number of their batch."""
    return spark.read.schema(f"{schema}, {OUTCOME}, batch bigint").option("basePath", ledger).parquet(f"{ledger}/batch=*/try=*").drop("try")


def dead_letters(spark: SparkSession, ledger: str, schema: str) -> DataFrame:
    """Messages that failed in every attempt, with the last error."""
    return read_ledger(spark, ledger, schema).where(F.col("status") == "dead").drop("status", "result")
