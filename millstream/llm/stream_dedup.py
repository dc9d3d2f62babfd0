"""Exact de-duplication of a stream of texts with keyed state that never expires.

State, on disk in RocksDB, holds one entry per digest: how many texts had it, and the
stable id and content locator (file and row) of the text that stays, which is the one
with the largest id. No watermark is set, so no entry ever leaves. Each micro-batch
writes the entries it touched to a log table; a repeated batch overwrites its own part.

A digest only nominates. Every text that hits a digest with more than one text is
compared byte for byte with the text that stays, fetched by its locator. Texts that
differ although their digests agree are grouped again by their whole content.

Only DataFrame functions work on rows; no Python runs on executors.

Defined cases: a null text is the empty text; a null id is smaller than any id, and
rows that agree in id as well count separately but share one ``keep_id``, of which the
row that comes last by file and row number is kept; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from ..session import cut_lineage, scratch_path

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # many small state partitions: no space set aside ahead, and a commit writes changes
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: str) -> Column:
    """The text with A-Z in lower case and null as the empty text."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)


def sha256(normal: Column) -> Column:
    return F.sha2(normal, 256)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
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


def _as_glob(path: str) -> str:
    """A stream reads folders; a glob lets it read a single file too."""
    head, last = path.rstrip("/")[:-1], path.rstrip("/")[-1]
    return f"{head}[{last}]"


def _rows(df: DataFrame, id_col: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    normal = folded(text)
    return df.select(
        digest(normal).alias("digest"),
        F.struct(F.col(id_col).cast("long").alias("id"),
                 F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.row_index").alias("row")).alias("at"),
        normal.alias("normal"))


def stream_state(spark: SparkSession, path: str, id_col: str, text: str,
                 digest: Callable[[Column], Column], files_per_batch: int | None) -> DataFrame:
    """Run the stream over all files of ``path`` and return the state's last entries:
    digest, ``n`` and ``last`` (id, file, row of the text that stays)."""
    log, memory = scratch_path(spark, "dedup-log"), scratch_path(spark, "dedup-state")
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    entries = (
        _rows(source.parquet(_as_glob(path)), id_col, text, digest)
        .groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last")))

    def keep_log(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    with settings(spark, STATE):
        running = (entries.writeStream.outputMode("update").foreachBatch(keep_log)
                   .option("checkpointLocation", memory).trigger(availableNow=True).start())
        running.awaitTermination()
    touched = spark.read.schema(
        "digest string, n long, last struct<id: long, file: string, row: long>, batch int")
    if running.lastProgress is None:
        return spark.createDataFrame([], "digest string, n long, "
                                         "last struct<id: long, file: string, row: long>")
    # a digest's count only grows, so its largest entry is its last one
    return (touched.parquet(log).groupBy("digest")
            .agg(F.max(F.struct("n", "last")).alias("e"))
            .select("digest", "e.n", "e.last"))


def stream_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256,
                 files_per_batch: int | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``: id, ``keep_id``, ``group_size``,
    ``kept``, ``digest``."""
    state = stream_state(spark, path, id_col, text, digest, files_per_batch)
    rows = _rows(spark.read.parquet(path), id_col, text, digest)
    seen = rows.select("digest", "at").join(state, "digest")
    alone = seen.where("n = 1").select("digest", "at", F.col("last").alias("keep"), "n")

    # hits: the bytes of every such text against those of the text that stays
    shared = state.where("n > 1").select("digest", "last")
    hits = cut_lineage(rows.join(shared, "digest"))
    stays = hits.where(F.col("at") == F.col("last")).select(
        F.col("digest").alias("d"), F.col("normal").alias("kept_text"))
    judged = cut_lineage(
        hits.join(stays, F.col("digest") == F.col("d"))
        .select("digest", "at",
                F.when(F.col("normal") != F.col("kept_text"), F.col("normal")).alias("other")))
    # texts that only share the digest: grouped by digest and whole content
    classes = judged.groupBy("digest", "other").agg(
        F.count(F.lit(1)).alias("n"), F.max("at").alias("keep"))
    groups = judged.select("digest", "at", "other").join(
        classes.withColumnRenamed("digest", "d").withColumnRenamed("other", "o"),
        (F.col("digest") == F.col("d")) & F.col("other").eqNullSafe(F.col("o")))
    found = alone.unionByName(groups.select("digest", "at", "keep", "n"))
    return found.select(
        F.col("at.id").alias(id_col), F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"), (F.col("at") == F.col("keep")).alias("kept"), "digest")


@query("""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
""")
def op5_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup(spark, f"{sf_dir}/documents.parquet")
    return found.withColumnRenamed("digest", "text_sha256")
