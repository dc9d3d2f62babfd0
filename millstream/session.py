"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Keeps state on the executors' disks, so it may outgrow their memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(
    app_name: str = "millstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    max_partition_bytes: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are written for.

    Adaptive execution coalesces small shuffle partitions and splits skewed
    join partitions, so ``shuffle_partitions`` should be set for the largest
    shuffle (about 200 MB each) and never needs lowering for small ones.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join also where a later step then needs one more shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # sessions of one key are merged before the shuffle of a micro-batch
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    } | STATE_STORE
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = max_partition_bytes
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 200 << 20) -> int:
    """Shuffle partitions that keep each one near ``target_bytes``."""
    return max(8, -(-input_bytes // target_bytes))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own: on a
    cluster the executors would not see it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_folder()
    return root


@functools.cache
def _own_folder() -> str:
    """This process's folder, removed when it ends."""
    root = tempfile.mkdtemp(prefix="millstream-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder; nothing is created yet."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared scratch folder."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
