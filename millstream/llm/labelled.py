"""A bounded sample of labelled documents, for fitting a classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(labels: DataFrame, label: Column, trainable: Column, max_rows: int,
                    id_col: str = "doc_id") -> DataFrame:
    """``(id, label)`` of at most ``max_rows`` labelled ids, the same on every run: those
    with the smallest hash. Null ids and labels are left out, a repeated id has its
    largest label."""
    known = (labels.select(F.col(id_col), label.cast("int").alias("label"))
             .where(F.col(id_col).isNotNull() & F.col("label").isNotNull())
             .where(trainable).groupBy(id_col).agg(F.max("label").alias("label")))
    total = known.count()
    order = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30))
    if total > max_rows:  # keep the final sort small
        share = min(1.0, 1.2 * max_rows / total + 200 / total)
        known = known.where(order < int(share * (1 << 30)))
    return known.orderBy(order, id_col).limit(max_rows)


def with_sample(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The sampled documents with their ``_label``; the sample is bounded, so it is
    broadcast."""
    sample = sample.select(F.col(id_col).alias("_sampled"), F.col("label").alias("_label"))
    return docs.drop("_sampled", "_label").join(F.broadcast(sample), F.col(id_col) == F.col("_sampled"))


def sampled_rows(features: DataFrame, id_col: str, *columns: str) -> pa.Table:
    """One row per sampled id, on the driver; of an id with several texts one is chosen by
    its content."""
    return (features.groupBy(id_col).agg(F.min(F.struct(*columns)).alias("r"))
            .select(id_col, "r.*").orderBy(F.xxhash64(id_col), id_col).toArrow())


def arrays_of(rows: pa.Table, column: str, kind: type) -> list[np.ndarray]:
    """A binary column as arrays that share its memory."""
    return [np.frombuffer(v.as_buffer(), kind)
            for chunk in rows.column(column).chunks for v in chunk]
