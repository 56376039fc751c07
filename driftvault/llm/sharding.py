"""Sharding by jump consistent hashing: a key's shard follows from the key and the shard count alone."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import stage

SHARDS = 8
#: Fixed values of the published algorithm: the multiplier of its linear congruential generator.
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key among n_shards: each key jumps forward through the shard counts at
    which it would have moved, and stays at the last jump below n_shards."""
    state = keys.astype(np.uint64).copy()
    at, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(moving):
            at[moving] = ahead[moving]
            state[moving] = state[moving] * _STEP + np.uint64(1)
            ahead[moving] = ((at[moving] + 1) * (float(1 << 31) / ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
            moving = moving[ahead[moving] < n_shards]
    return at


def jump_shard(key, n_shards: int):
    """Column: the shard of a long key."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy("int64").view(np.uint64), n_shards).astype("int32"))

    return shard(key)


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The key is a hash of doc_id (null: 0), so equal texts with different ids go their own ways and repeated rows
    share a shard. A null text has no bytes: size 1, CRC-32 0. Slots count from 0 in each shard without gaps.
    Only ids and numbers are shuffled, never texts; an empty table gives an empty result.
    """
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    key = F.xxhash64(F.coalesce("doc_id", F.lit(0)))
    rows = docs.select("doc_id", (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), key.alias("key"))
    rows = rows.select(
        "doc_id", "size", "text_crc32", jump_shard("key", n_shards).alias("shard"), jump_shard("key", n_shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    # rows are numbered within what one partition has for one shard, however often a doc_id comes up
    rows = stage(rows, "shards").withColumn("source", F.shiftright("row", 33))
    counts = rows.groupBy("shard", "source").agg(F.count("*").alias("n"))  # a row for each shard and partition
    before = counts.selectExpr("shard", "source", "sum(n) OVER (PARTITION BY shard ORDER BY source) - n AS first")
    slot = F.expr("row_number() OVER (PARTITION BY shard, source ORDER BY row) - 1")
    return rows.withColumn("slot", slot).join(before, ["shard", "source"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("slot")).cast("long").alias("slot"), "grown_shard"
    )
