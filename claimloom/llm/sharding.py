"""Jump consistent hashing: shards for stable keys without a ring table.

A key's shard depends on the key and the number of shards only. With one more shard, a key either stays
or moves into the new shard, which takes about one row in ``shards + 1``.

Null keys hash like the empty text. Equal keys share a shard. Rows that agree in every column of the
result are interchangeable, so which of them gets which slot is not visible. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import hex_number, running_start

STEP = 2862933555777941757  # multiplier of the generator that jump hashing draws from


def stable_key(*columns: Column) -> Column:
    """60 bits of the digest of the key columns."""
    return hex_number(F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]).cast("binary")), 1, 15)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key: follow the jumps of the key until one passes the last shard."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    place = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        shard[going] = place[going]
        state[going] = state[going] * np.uint64(STEP) + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        place[going] = ((shard[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        going = going[place[going] < shards]
    return shard.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards))

    return of(key)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard, slot and the shard after one more is appended, for each document.

    Slots number a shard's documents from 0 without gaps, in the order of 4,096 key ranges and then of
    ids, so that no shard is sorted by one task. Only ids, sizes and checksums are shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        stable_key(F.col("doc_id")).alias("key"),
    )
    rows = rows.select(
        "*",
        F.lit("key").alias("law"),
        jump_shard(F.col("key"), shards).alias("shard"),
        jump_shard(F.col("key"), shards + 1).alias("grown_shard"),
        F.shiftright("key", 48).alias("part"),
        F.lit(1).cast("long").alias("one"),
    )
    laid = running_start(rows, ["shard"], "part", ["doc_id", "size", "text_crc32"], "one", "slot")
    return laid.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
