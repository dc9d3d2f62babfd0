import collections
import hashlib

import pytest
from corpus_samples import ascii_lower, messy, no_docs  # noqa: F401
from pyspark.sql import functions as F

from millstream.llm.stream_dedup import stream_dedup

WEAK = {"four values": lambda c: (F.crc32(c) % 4).cast("string"), "sha256": None}


@pytest.mark.parametrize("digest", WEAK)
@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_messy_documents(spark, messy, scratch, digest, files_per_batch):  # noqa: F811
    """Also with a digest that most texts share: only whole bytes make a group."""
    path = scratch()
    copies = messy.where("doc_id in (6, 8)").withColumn("doc_id", F.col("doc_id") + 100)
    messy.unionAll(copies).write.parquet(path)
    options = {"digest": WEAK[digest]} if WEAK[digest] else {}
    got = stream_dedup(spark, path, files_per_batch=files_per_batch, **options).collect()
    rows = spark.read.parquet(path).select("doc_id", "text").collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[ascii_lower(r.text)].append(r.doc_id)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids)) for i in ids]
    key = lambda r: [(x is None, x) for x in r]
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=key) == sorted(
        want, key=key)
    assert sum(r.kept for r in got) == len(groups)
    if digest == "sha256":
        named = {r.doc_id: r.digest for r in got}
        assert named[9] == hashlib.sha256(b"w").hexdigest()


def test_no_documents(spark, no_docs, scratch):  # noqa: F811
    path = scratch()
    no_docs.write.parquet(path)
    assert stream_dedup(spark, path).count() == 0


def test_settings_are_put_back(spark, messy, scratch):  # noqa: F811
    path = scratch()
    messy.limit(2).write.parquet(path)
    before = spark.conf.getAll if isinstance(spark.conf.getAll, dict) else spark.conf.getAll()
    stream_dedup(spark, path).count()
    after = spark.conf.getAll if isinstance(spark.conf.getAll, dict) else spark.conf.getAll()
    assert before == after
