"""Keys that hold so many rows that they must not meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Rows that are looked at of a key that is just large enough.
SAMPLED_ROWS = 2_000

# A list of hot keys up to this length is kept in the plan, a longer one as a table.
LISTED_KEYS = 10_000

KEY_HASH = "_key_hash"


def key_hash(keys: Sequence[str]) -> Column:
    """One number per key, also for keys with NULLs. Two keys with one number would
    only be treated alike, which is right for either."""
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame | None:
    """Hash and approximate row count (``_rows``) of the keys with more than about
    ``max_rows`` rows; None if there are none.

    Only the key columns are read. Where ``max_rows`` is large, rows are sampled for
    this estimate, so that its shuffle is small; it decides how rows are spread over
    tasks and never which rows are used. The result has at most about (all rows /
    ``max_rows``) rows and is fixed once computed.
    """
    if df.isStreaming:
        raise ValueError("keys cannot be counted ahead on a stream; see millstream.streaming")
    fraction = min(1.0, SAMPLED_ROWS / max_rows)
    hashes = df.select(key_hash(keys).alias(KEY_HASH))
    if fraction < 1:
        hashes = hashes.sample(fraction, seed=20)
    estimate = (F.count(F.lit(1)) / F.lit(fraction)).alias("_rows")
    large = hashes.groupBy(KEY_HASH).agg(estimate).where(F.col("_rows") > max_rows)
    listed = large.limit(LISTED_KEYS + 1).collect()
    if len(listed) > LISTED_KEYS:
        return cut_lineage(large)
    if not listed:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(listed, large.schema))  # 16 bytes a row


def with_hot_rows(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` plus ``_rows``, NULL for keys that are not hot."""
    hashed = df.withColumn(KEY_HASH, key_hash(keys))
    return hashed.join(hot, KEY_HASH, "left").drop(KEY_HASH)
