"""From raw documents to token shards: five stages, each on all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the columns
of the documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstream.llm import (
    bit_planes, factorisation, latent_retrieval, prob_minhash, soft_mixing,
)
from millstream.llm.textwords import read_table, remainder
from millstream.plans.registry import query
from millstream.session import cut_lineage

#: A document stays if its quality score is at least this.
LEAST_QUALITY = 0.7
#: What is left of poor texts after the first stage is no domain to fill up again.
WEIGHTS = {"good": 0.94, "poor": 0.01, "toxic": 0.05}


#: A document is repeated no more often than that, whatever the targets ask for.
MOST_COPIES = 4.0
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> dict:
    return {c: F.col(f"`{c}`") for c in docs.columns}


def _stage(step):
    """Other columns than the documents' own travel under names that no operator uses."""

    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in OWN else f"other {i}" for i, c in enumerate(docs.columns)]
        return step(spark, docs.toDF(*names), sf_dir).toDF(*docs.columns)

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    labels = read_table(spark, sf_dir, "labels")
    machine = factorisation.fit_quality(docs, labels, remainder("doc_id", 4) != 2)
    scored = factorisation.score_quality(docs, machine, _columns(docs), out="_quality")
    return scored.where(F.col("_quality") >= LEAST_QUALITY).drop("_quality")


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id. Classes
    are of contents: rows that share an id, or have none, are compared by their texts."""
    return prob_minhash.one_of_each_class(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Whether a row leaks depends on its text
    alone, so rows are known by a digest of the text, with or without an id."""
    content = F.sha2(F.coalesce("text", F.lit("")), 256)
    leaks = latent_retrieval.find_leaks(
        docs.select(content.alias("_content"), "text"), read_table(spark, sf_dir, "benchmark"),
        id_col="_content")
    leaks = leaks.select(F.col("_content").alias("_leaks")).distinct()
    return docs.join(leaks, content == F.col("_leaks"), "left_anti")


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as its rate says, for the target shares of the domains."""
    mixed = soft_mixing.mix(docs, read_table(spark, sf_dir, "labels"), WEIGHTS, _columns(docs),
                            max_rate=MOST_COPIES)
    times = soft_mixing.copies("_rate", "doc_id", F.xxhash64("text"))
    return (mixed.withColumn("_times", times).where("_times > 0")
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int"))))
            .select(*_columns(docs).values()))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in bit planes, and what reading them back gives for each document."""
    return bit_planes.token_planes(docs).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: The classifiers, the retrieval and the encoder are beyond SQL.
ORACLE_SQL = None


@query(name="pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
