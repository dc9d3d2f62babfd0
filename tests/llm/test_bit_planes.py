import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millstream.llm import bit_planes
from millstream.llm.bit_planes import (
    default_tokenizer, from_planes, read_block, read_footer, read_planes, to_planes, write_planes,
)
from millstream.sources.files import open_fs

from corpus_samples import MESSY, labels, messy, no_docs, no_labels  # noqa: F401


def _want(rows):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    out, start = [], 0
    ids_of = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    for i, ids in ids_of:
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [1], [2**32 - 1, 0], list(range(1000))])
def test_planes_round_trip(kind, ids):
    ids = np.array(ids, np.uint32)
    planes = [p if any(p) else None for p in to_planes(ids, kind)]
    assert from_planes(planes, len(ids), kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_messy_documents(spark, messy, scratch, kind):
    path = scratch()
    shards = write_planes(messy, path, default_tokenizer(), block_ids=100, kind=kind)
    got = read_planes(shards, path).withColumn("crc", F.crc32("ids")).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.crc) for r in got), key=lambda r: r[1])
    assert [r[0] for r in got[:2]] == [None, None]
    ids = [r[0] for r in got[2:]]
    assert ids == sorted(ids)
    # rows with equal ids may come in either order
    known = {(i, n, c) for i, _, n, c in _want([r[:2] for r in MESSY])}
    assert len(got) == len(MESSY) and {(i, n, c) for i, _, n, c in got} == known
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()


def test_a_block_is_read_by_the_index(spark, messy, scratch):
    path = scratch()
    shards = write_planes(messy.where("doc_id = 6"), path, default_tokenizer(), block_ids=64)
    shard = shards.first()
    fs, folder = open_fs(path)
    with fs.open_input_file(f"{folder}/{shard.file}") as file:
        footer = read_footer(file)
        blocks = [read_block(file, footer, n) for n in range(len(footer["blocks"]))]
        assert read_block(file, footer, 3).tolist() == blocks[3].tolist()
    assert sum(map(len, blocks)) == shard.n_ids and all(len(b) == 64 for b in blocks[:-1])


def test_no_documents(no_docs):
    assert bit_planes.token_planes(no_docs).count() == 0


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = _want(sorted((r.doc_id, r.text) for r in docs.collect()))
    got = bit_planes.op2_bit_planes(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
