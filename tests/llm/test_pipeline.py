"""Every stage of the pipeline against a plain version of its decision."""

import collections
import zlib

import numpy as np
import pytest
from corpus_samples import labels, messy, no_docs, no_labels  # noqa: F401
from pyspark.sql import functions as F
from test_bit_planes import _want
from test_prob_minhash import brute_force

import corpus_pipeline
from millstream.llm import factorisation, soft_mixing
from millstream.llm.textwords import remainder
from millstream.plans.registry import QUERIES
from millstream.session import cut_lineage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], SF_DIR)))
    return out


def test_order_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "near_dedup", "decontamination", "mixing",
                     "token_output"]
    assert {tuple(d.columns) for d in stages[:5]} == {tuple(stages[0].columns)}
    assert QUERIES["pipeline"] is corpus_pipeline.run


def test_quality(spark, stages):
    known = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    machine = factorisation.fit_quality(stages[0], known, remainder("doc_id", 4) != 2)
    scores = factorisation.score_quality(stages[0], machine, {"doc_id": F.col("doc_id")}).collect()
    want = {r.doc_id for r in scores if r.score >= 0.7}
    assert {r.doc_id for r in stages[1].collect()} == want
    good = {r.doc_id for r in known.where("quality = 1").collect()}
    assert len(good & want) >= 0.97 * len(good)


def test_near_dedup(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    classes = brute_force(rows)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(classes.values()))


def test_decontamination(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in stages[2].collect() if any(i in r.text for i in items)}
    before, after = ({r.doc_id for r in s.collect()} for s in stages[2:4])
    assert after <= before and not leaks & after
    assert len(before - after - leaks) <= 2


def test_mixing(spark, stages):
    known = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    mixed = soft_mixing.mix(stages[3], known, corpus_pipeline.WEIGHTS,
                            {"doc_id": F.col("doc_id"), "text": F.col("text")},
                            max_rate=corpus_pipeline.MOST_COPIES)
    want = {r.doc_id: r.c for r in mixed.select(
        "doc_id", soft_mixing.copies("_rate", "doc_id", F.xxhash64("text")).alias("c")
    ).collect() if r.c}
    assert max(want.values()) <= corpus_pipeline.MOST_COPIES
    assert len(want) > 0.5 * stages[3].count()
    assert collections.Counter(r.doc_id for r in stages[4].collect()) == want


def test_tokens(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[4].collect())
    assert sorted(map(tuple, stages[5].collect())) == sorted(_want(rows))


def test_messy_documents(spark, messy, no_docs, labels, no_labels, scratch):  # noqa: F811
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    for docs, known in ((messy, labels), (messy, no_labels), (no_docs, labels)):
        place = scratch()
        known.write.parquet(f"{place}/labels.parquet")
        benchmark.write.parquet(f"{place}/benchmark.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, place)
            if name != "token_output":
                assert out.columns == docs.columns
            out = cut_lineage(out)
            assert out.count() <= 2 * docs.count()
    assert np.uint32(zlib.crc32(b"")) == 0


def test_columns_named_like_inner_ones(spark, scratch):
    """They come out of every stage as they went in."""
    names = ["_quality", "_text", "_leaks", "_tokens", "_key", "_times", "_label", "_sampled",
             "_rate", "_met", "_posterior", "_content", "_copy", "_first", "_id", "_row", "_meta0",
             "other 5", "a.b", "first", "id", "key"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 3000")
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = cut_lineage(stage(spark, docs, SF_DIR))
        wrong = [F.col(f"`{n}`") != F.concat(F.lit(f"{n} "), "doc_id") for n in names]
        assert docs.count() > 20, name
        for w in wrong:
            assert docs.where(w).isEmpty(), name
    tokens = corpus_pipeline.token_output(spark, docs, SF_DIR)
    assert tokens.count() == docs.count()


def test_rows_without_an_id_are_decontaminated(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plain = "nothing of the benchmark stands here at all"
    rows = [(None, f"before it {item} after it"), (None, plain), (-1, f"and {item} again"),
            (-1, plain + " either")]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    left = corpus_pipeline.decontaminate(spark, docs, SF_DIR).where("doc_id is null or doc_id = -1")
    assert {(r.doc_id, r.text) for r in left.collect()} == {rows[1], rows[3]}
