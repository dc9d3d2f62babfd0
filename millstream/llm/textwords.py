"""Words of many texts at once, as hashes in numpy arrays.

A chunk of an Arrow batch is one run of bytes with row offsets. Words are maximal
runs of bytes that a 256-entry table maps to a value above 0; the table also folds
case. Every word gets a 64-bit hash: a polynomial of its bytes modulo 2**64, read off
one running sum over the chunk, then mixed. Equal words have equal hashes anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 21


def fold_table(separators: str | None = None) -> np.ndarray:
    """Bytes to folded bytes, 0 for separators. Without ``separators`` words are
    ASCII letters and digits and everything beyond ASCII."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    if separators is None:
        letters = np.zeros(256, bool)
        letters[48:58] = letters[65:91] = letters[97:123] = letters[128:] = True
        table[~letters] = 0
    else:
        table[0] = 255  # byte 255 is never part of UTF-8
        table[np.frombuffer(separators.encode("latin-1"), np.uint8)] = 0
    return table


WORD = fold_table()
TOKEN = fold_table(" \t\n\x0b\x0c\r")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one round of multiply and shift, twice)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse, grown on demand, one set per process."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up[:n], cls.down[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``values[start:end]``; values are bytes above 0."""
    n = len(values)
    up, down = _Powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


class Texts(NamedTuple):
    """Texts of consecutive rows: their bytes, and where each row begins."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


class Words(NamedTuple):
    """One entry per word; ``first[r]:first[r + 1]`` are the words of row ``r``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(texts: Texts, table: np.ndarray = WORD) -> Words:
    values = table[texts.data]
    inside = values != 0
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    if len(inside):
        edge[0], edge[-1] = inside[0], inside[-1]
    begins = edge.copy()
    begins[:-1] &= inside
    begins[-1:] = False
    finishes = edge
    finishes[1:] &= inside
    finishes[:1] = False
    cuts = texts.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]  # a word never crosses rows
    begins[cuts] = True
    finishes[cuts] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes)
    first = np.searchsorted(starts, texts.offsets)
    return Words(run_hashes(values, starts, ends), starts, ends, first)


def grams(hashes: np.ndarray, first: np.ndarray, places: tuple[int, ...]
          ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words at ``places`` after each word, with their rows; combinations
    that would leave the row are left out."""
    span = max(places)
    lengths = np.maximum(np.diff(first) - span, 0)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(rows)) + np.repeat(
        first[:-1] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    out = np.full(len(at), len(places), np.uint64)
    for p in places:
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[at + p]
    return mix(out), rows


def row_keys(rows: np.ndarray, hashes: np.ndarray, bits: int = 52) -> np.ndarray:
    """Row and the top bits of a hash in one sortable number."""
    return (rows.astype(np.uint64) << np.uint64(bits)) | (hashes >> np.uint64(64 - bits))


def split_texts(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """``(start, stop, texts)`` of row ranges of about ``limit`` bytes; a longer text is
    a range of its own and always whole. Nulls are empty texts."""
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), start + 2048, len(column))
        low = offsets[start]
        yield start, stop, Texts(data[low:offsets[stop]], offsets[start:stop + 1] - low)
        start = stop


def fresh_name(name: str, taken) -> str:
    """``name``, with as many underscores before it as it needs to be new."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def map_texts(df: DataFrame, text: str | Column, keep: dict[str, Column], new: str,
              make: Callable[[], Callable[[list[pa.Array], Texts], list]],
              limit: int = CHUNK_BYTES) -> DataFrame:
    """Columns ``keep`` and, computed by chunks from the text, the columns ``new``.

    ``make`` is called once per task; what it returns gets the kept arrays and the
    texts of a chunk and gives one array per new column.
    """
    text = F.col(text) if isinstance(text, str) else text
    own = fresh_name("_text", keep)
    source = df.select(text.cast("string").alias(own),
                       *[c.alias(name) for name, c in keep.items()])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    names = [*keep, *StructType.fromDDL(new).names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start, stop, texts in split_texts(batch.column(0), limit):
                columns = [c.slice(start, stop - start) for c in batch.columns[1:]]
                made = [pa.array(a) if isinstance(a, np.ndarray) else a
                        for a in work(columns, texts)]
                yield pa.RecordBatch.from_arrays([*columns, *made], names)

    return source.mapInArrow(run, f"{kept}, {new}" if kept else new)


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
