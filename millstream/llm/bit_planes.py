"""Token ids in binary shards of bit planes.

A shard holds the ids of a run of documents in ascending id order::

    magic, chunks, footer (zstandard), footer length (8 bytes), magic

A chunk is a block of ``block_ids`` ids (the last block of a shard may be shorter),
transposed: plane ``b`` has bit (or byte) ``b`` of every id of the block and is
compressed with zstandard on its own; a plane of zeros takes no bytes. The footer is the
index: where each block begins and how long its planes are, and for each document its id
and number of ids. A reader thus needs only the chunks it wants.

Writing is one range shuffle by document id; each task encodes its texts as they come and
keeps one block. Shards are written under a hidden name and renamed, so a lost task leaves
nothing and a repeated one replaces equal bytes. Shard totals, one row per task, give the
starts.

Defined cases: a null text is empty and yields the end id alone; null ids come first; rows
with equal ids follow each other in the order of their texts; no rows give no shards;
other columns are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from ..session import cut_lineage, scratch_path
from ..sources.files import open_fs
from .encoding import shared_encoder
from .textwords import read_table, split_texts

MAGIC = b"BITPLAN1"
BLOCK_IDS = 1 << 16
END_ID = 2


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first; none above the highest one in use."""
    ids = np.ascontiguousarray(ids, "<u4")
    width = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        parts = ids.view(np.uint8).reshape(-1, 4)
        return [parts[:, b].tobytes() for b in range(-(-width // 8))]
    if kind != "bit":
        raise ValueError(f"planes are 'bit' or 'byte', not {kind!r}")
    one = np.uint32(1)
    return [np.packbits(((ids >> np.uint32(b)) & one).astype(np.uint8)).tobytes()
            for b in range(width)]


def from_planes(planes: list[bytes | None], count: int, kind: str) -> np.ndarray:
    """The ids of a block; ``None`` stands for a plane of zeros."""
    ids = np.zeros(count, np.uint32)
    for b, plane in enumerate(planes):
        if plane is None:
            continue
        part = np.frombuffer(plane, np.uint8)
        if kind == "byte":
            ids |= part.astype(np.uint32) << np.uint32(8 * b)
        else:
            ids |= np.unpackbits(part, count=count).astype(np.uint32) << np.uint32(b)
    return ids


class ShardWriter:
    """One shard; ids come in any portions."""

    def __init__(self, out, block_ids: int, kind: str, level: int):
        self.out, self.block_ids, self.kind = out, block_ids, kind
        self.packer = zstandard.ZstdCompressor(level=level)
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        self.place = len(MAGIC)
        self.blocks: list[list[int]] = []  # place, ids, then the sizes of the planes
        self.doc_ids: list[int | None] = []
        self.doc_lengths: list[int] = []
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.doc_lengths += lengths.tolist()
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            ids = np.concatenate(self.rest)
            whole = len(ids) - len(ids) % self.block_ids
            for start in range(0, whole, self.block_ids):
                self._block(ids[start:start + self.block_ids])
            self.rest = [ids[whole:]]
            self.waiting = len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        entry = [self.place, len(ids)]
        for plane in to_planes(ids, self.kind):
            packed = self.packer.compress(plane) if any(plane) else b""
            self.out.write(packed)
            entry.append(len(packed))
            self.place += len(packed)
        self.blocks.append(entry)

    def close(self) -> tuple[int, int, int]:
        if self.waiting:
            self._block(np.concatenate(self.rest))
        footer = self.packer.compress(json.dumps({
            "kind": self.kind, "blocks": self.blocks, "doc_ids": self.doc_ids,
            "doc_lengths": self.doc_lengths}).encode())
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        size = self.place + len(footer) + 8 + len(MAGIC)
        return len(self.doc_ids), sum(self.doc_lengths), size


def read_footer(file) -> dict:
    size = file.size()
    tail = file.read_at(16, size - 16)
    if tail[8:] != MAGIC:
        raise ValueError("not a shard of bit planes, or cut off")
    length = int.from_bytes(tail[:8], "little")
    return json.loads(zstandard.ZstdDecompressor().decompress(
        file.read_at(length, size - 16 - length)))


def read_block(file, footer: dict, number: int) -> np.ndarray:
    """The ids of one block, by its entry in the index."""
    place, count, *sizes = footer["blocks"][number]
    raw = file.read_at(sum(sizes), place)
    unpack, planes, at = zstandard.ZstdDecompressor(), [], 0
    for size in sizes:
        planes.append(unpack.decompress(raw[at:at + size]) if size else None)
        at += size
    return from_planes(planes, count, footer["kind"])


def write_planes(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id",
                 text: str = "text", end_id: int | None = END_ID, block_ids: int = BLOCK_IDS,
                 kind: str = "bit", level: int = 3) -> DataFrame:
    """Write ``docs`` as shards below ``path``. Gives one row per shard in document order:
    shard, file, n_docs, n_ids, n_bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = rows.withColumn("spread", F.xxhash64("text"))
    order = order.repartitionByRange("id", "spread").sortWithinPartitions("id", "spread", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_file, end_id)
        shard = TaskContext.get().partitionId()
        fs, folder = open_fs(path)
        writer = None
        hidden = f"{folder}/_staged/{uuid.uuid4().hex}"
        for batch in batches:
            for start, stop, texts in split_texts(batch.column(1)):
                if writer is None:
                    fs.create_dir(f"{folder}/_staged", recursive=True)
                    out = fs.open_output_stream(hidden, compression=None)
                    writer = ShardWriter(out, block_ids, kind, level)
                ids, lengths = encoder.encode(texts)
                writer.add(batch.column(0).slice(start, stop - start).to_pylist(), lengths, ids)
        if writer is None:
            return
        counts = writer.close()
        out.close()
        final = f"shard-{shard:06d}.planes"
        fs.move(hidden, f"{folder}/{final}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in (shard, final, *counts)],
            ["shard", "file", "n_docs", "n_ids", "n_bytes"])

    made = order.select("id", "text").mapInArrow(
        write, "shard long, file string, n_docs long, n_ids long, n_bytes long")
    return cut_lineage(made).orderBy("shard")


def read_planes(shards: DataFrame, path: str) -> DataFrame:
    """The documents of the shards, read back from the files: doc_id, start (ids of all
    documents before), n_tokens, ids (32-bit little-endian numbers)."""
    spark = shards.sparkSession
    rows, base = [], 0
    for r in sorted(shards.select("shard", "file", "n_ids").collect()):  # a row per task
        rows.append((r.file, base))
        base += r.n_ids
    plan = spark.createDataFrame(rows, "file string, base long").repartition(max(1, len(rows)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(path)
        for batch in batches:
            for file_name, base in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                with fs.open_input_file(f"{folder}/{file_name}") as file:
                    yield from _documents(file, base)

    return plan.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _documents(file, base: int, batch_ids: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    footer = read_footer(file)
    doc_ids, lengths = footer["doc_ids"], np.array(footer["doc_lengths"], np.int64)
    ends = np.cumsum(lengths)
    done, kept, held, before = 0, [], 0, 0  # documents given; ids in hand; ids given
    for number in range(len(footer["blocks"])):
        kept.append(read_block(file, footer, number))
        held += len(kept[-1])
        last = number == len(footer["blocks"]) - 1
        if held < batch_ids and not last:
            continue
        ids = np.concatenate(kept)
        stop = len(ends) if last else int(np.searchsorted(ends, before + len(ids), "right"))
        if stop > done:
            starts = ends[done:stop] - lengths[done:stop]
            take = int(ends[stop - 1]) - before
            size = 4 * np.concatenate(([0], ends[done:stop] - before))
            values = pa.Array.from_buffers(pa.binary(), stop - done, [
                None, pa.py_buffer(size.astype(np.int32)),
                pa.py_buffer(np.ascontiguousarray(ids[:take], "<u4"))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids[done:stop], pa.int64()), pa.array(base + starts),
                 pa.array(lengths[done:stop]), values], ["doc_id", "start", "n_tokens", "ids"])
            ids, before, done = ids[take:], before + take, stop
        kept, held = [ids], len(ids)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_planes(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 tokenizer_file: Callable[[], str] = default_tokenizer) -> DataFrame:
    """Write the documents to fresh shards in the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-planes")
    shards = write_planes(docs, path, tokenizer_file(), id_col, text)
    return read_planes(shards, path)


@query()
def op2_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
