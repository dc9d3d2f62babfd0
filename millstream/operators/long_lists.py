"""Exclusion by a list that is too long to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cogroup import exclude

BITS = 1 << 27  # 16 MB, whatever the length of the list
HASHES = 4


def false_positives(listed: int, bits: int = BITS) -> float:
    """The share of keys that are not in a list of so many keys but look as if they were."""
    return float(-np.expm1(-HASHES * listed / bits)) ** HASHES


def _places(key_hash: Column, bits: int) -> list[Column]:
    low = key_hash.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(key_hash, 32)
    return [(low + high * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def bloom_filter(listed: DataFrame, keys: Sequence[str], bits: int = BITS) -> np.ndarray:
    """The Bloom filter of the keys as words of 64 bits. Words are joined by a bitwise or
    next to the data first, so a task sends ``bits / 64`` rows at most, and so does the result."""
    places = listed.select(F.explode(F.array(*_places(F.xxhash64(*keys), bits))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint64)


def exclude_long(
    df: DataFrame, excluded: DataFrame, keys: Sequence[str], bits: int = BITS
) -> DataFrame:
    """As ``exclude``, for a long list: rows whose key cannot be in it pass a Bloom filter of
    ``bits`` bits (a power of two) and are never shuffled; only the others are joined with the
    list. The filter is built at once and broadcast. A list too long for its size lets more
    rows through to the join (``false_positives``) and loses none.
    """
    keys = list(keys)
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two from 64 on")
    kinds = [(k, df.schema[k].dataType, excluded.schema[k].dataType) for k in keys]
    if unlike := [k for k, a, b in kinds if a != b]:
        raise TypeError(f"the list has other types of {unlike}; cast them first")
    words = df.sparkSession.sparkContext.broadcast(bloom_filter(excluded, keys, bits))

    @F.pandas_udf("boolean")
    def may_be_listed(hashes: pd.Series) -> pd.Series:
        h = hashes.to_numpy().view(np.uint64)
        low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
        hit = np.ones(len(h), bool)
        for i in range(HASHES):
            p = (low + high * np.uint64(i)) & np.uint64(bits - 1)
            hit &= (words.value[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(hit)

    possible = may_be_listed(F.xxhash64(*keys))
    columns = [f"`{c}`" for c in df.columns]
    joined = exclude(df.where(possible), excluded, keys).select(*columns)
    return df.where(~possible).unionAll(joined)
