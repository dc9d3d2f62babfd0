"""Benchmark decontamination by latent semantic retrieval.

Three passes over the documents, each cut into passages of words:

1. document frequencies of hashed words over all passages, and of the benchmark's words
   over all documents;
2. a randomised singular value decomposition of the TF-IDF passages: every task forms its
   part of ``A.T @ (A @ omega)`` for a fixed random ``omega``, Spark adds the parts up, and
   the Nyström form of that one sketch gives the leading right singular vectors;
3. search: every overlapping window of every document is projected into the latent space
   and compared with every benchmark item. Windows above the cosine threshold are
   candidates; a candidate stays if it holds the item's answer (its rarest words) and the
   longest common subsequence of words around the window covers enough of the item. So
   passages with words replaced, dropped or added are found as well as whole copies.

Benchmark passages take part in the decomposition with as much weight as the corpus, or
their vocabulary would be lost between the corpus's topics. The benchmark is the query
set: it is read in blocks of at most ``BLOCK_ITEMS`` items, one search pass each, so that
what is broadcast stays bounded. Sketches have a fixed size.

Defined cases: null and empty texts have no passages; items of fewer than five words are
too short to tell and never match; repeated rows and items give their pairs once; rows with
a null id are searched and reported with a null id; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from .textwords import Texts, map_texts, read_table, split_texts, words_of

BITS = 14
RANK, OVERSAMPLE = 48, 12
STEP = 12  # a window is two steps of words
COSINE = 0.45
LCS = 0.6
ANSWER_WORDS, ANSWER_SHARE = 8, 0.3
LEAST_WORDS = 5
BLOCK_ITEMS = 4096
SEED = 20


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def cuts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of consecutive runs of ``size`` words that do not cross rows, and where the
    runs of each row begin."""
    runs = -(-np.diff(first) // size)
    begin = np.concatenate(([0], np.cumsum(runs)))
    rows = np.repeat(np.arange(len(runs)), runs)
    return first[rows] + size * (np.arange(len(rows)) - begin[rows]), begin


def run_buckets(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Buckets of runs of at most ``size`` words, a row per run; ``2**BITS`` fills up."""
    padded = np.append(buckets(hashes), np.full(size, 1 << BITS))
    ends = np.append(starts[1:], len(hashes))
    at = starts[:, None] + np.arange(size)
    return np.where(at < ends[:, None], padded[at], 1 << BITS)


def run_sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the table's rows named in each row; the table ends in a row of zeros."""
    total = table[rows[:, 0]]
    for j in range(1, rows.shape[1]):
        total += table[rows[:, j]]
    return total


def passage_terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, object]:
    """Passages of two steps as sparse rows: passage, bucket and count of each term."""
    words = words_of(texts)
    starts, _ = cuts(words.first, 2 * STEP)
    passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words.hashes))))
    keys, counts = np.unique((passage << BITS) | buckets(words.hashes), return_counts=True)
    return keys >> BITS, keys & ((1 << BITS) - 1), counts, len(starts), words


def _summed(df: DataFrame, text: str, extra: list, schema: str,
            make: Callable[[], tuple[Callable, Callable]]) -> DataFrame:
    """What the tasks gather: ``take(texts, columns)`` for each chunk, ``give()`` at the end."""
    source = df.select(F.col(text).cast("string").alias("_text"), *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, give = make()
        for batch in batches:
            for start, stop, texts in split_texts(batch.column(0)):
                take(texts, [c.slice(start, stop - start) for c in batch.columns[1:]])
        yield from give()

    return source.mapInArrow(run, schema)


def frequencies(docs: DataFrame, items: DataFrame, text: str, vocabulary: np.ndarray):
    """Passages per bucket over documents and items, passages in all of each kind, and
    documents per word of ``vocabulary`` (sorted hashes)."""
    both = docs.select(F.col(text).alias("text"), F.lit(0).alias("kind")).unionAll(
        items.select(F.col("text"), F.lit(1).alias("kind")))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        known = shared.value
        per_bucket = np.zeros(1 << BITS, np.int64)
        per_word = np.zeros(len(known) + 1, np.int64)
        passages = np.zeros(2, np.int64)

        def take(texts, columns):
            _, bucket, _, n, words = passage_terms(texts)
            np.add(per_bucket, np.bincount(bucket, minlength=1 << BITS), out=per_bucket)
            kind = int(columns[0][0].as_py())  # a partition holds one kind
            passages[kind] += n
            if kind == 0 and len(known):
                at = np.minimum(np.searchsorted(known, words.hashes), len(known) - 1)
                hit = known[at] == words.hashes
                seen = np.unique(words.rows()[hit] * len(known) + at[hit]) % len(known)
                np.add(per_word, np.bincount(seen, minlength=len(known) + 1), out=per_word)

        def give():
            for name, counts in (("bucket", per_bucket), ("word", per_word),
                                 ("passages", passages)):
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int64)),
                     pa.array(counts[at])], ["name", "key", "n"])

        return take, give

    found = _summed(both, "text", ["kind"], "name string, key long, n long", make)
    out = {"bucket": np.zeros(1 << BITS), "word": np.zeros(len(vocabulary) + 1),
           "passages": np.zeros(2)}
    # as many rows as there are buckets and benchmark words
    for r in found.groupBy("name", "key").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.name][r.key] = r.n
    return out


def omega() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return rng.standard_normal((1 << BITS, RANK + OVERSAMPLE)).astype(np.float32)


def sketch(docs: DataFrame, items: DataFrame, text: str, idf: np.ndarray, item_weight: float
           ) -> np.ndarray:
    """``A.T @ (A @ omega)`` of the passages, their rows of length 1 (items: times the
    weight). Each task gives one row per bucket, so few tasks with much input are used."""
    spark = docs.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    both = docs.select(F.col(text).alias("text"), F.lit(1.0).alias("weight")).coalesce(
        tasks).unionAll(items.select("text", F.lit(float(item_weight)).alias("weight")).coalesce(1))
    width = RANK + OVERSAMPLE
    shared = spark.sparkContext.broadcast(idf.astype(np.float32))

    def make():
        weights = shared.value
        random = np.vstack([weights[:, None] * omega(), np.zeros((1, width), np.float32)])
        total = np.zeros((1 << BITS, width))

        def take(texts, columns):
            passage, bucket, counts, n, words = passage_terms(texts)
            if not n:
                return
            value = counts.astype(np.float32) * weights[bucket]
            norm = np.sqrt(np.bincount(passage, weights=value * value, minlength=n))
            norm = np.maximum(norm, 1e-12)
            starts, _ = cuts(words.first, 2 * STEP)
            rows = run_buckets(words.hashes, starts, 2 * STEP)
            scale = float(columns[0][0].as_py()) / (norm * norm)  # both factors are scaled
            y = run_sums(random, rows) * scale[:, None]
            back = weights[bucket] * counts
            for j in range(width):
                total[:, j] += np.bincount(bucket, weights=back * y[passage, j],
                                           minlength=1 << BITS)

        def give():
            at = np.flatnonzero(total.any(axis=1))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)),
                     *[pa.array(total[at, j].astype(np.float32)) for j in range(width)]],
                    ["bucket", *[f"y{j}" for j in range(width)]])

        return take, give

    columns = ", ".join(f"y{j} float" for j in range(width))
    parts = _summed(both, "text", ["weight"], f"bucket int, {columns}", make)
    rows = parts.groupBy("bucket").agg(*[F.sum(f"y{j}").alias(f"y{j}") for j in range(width)])
    out = np.zeros((1 << BITS, width))
    table = rows.toArrow()
    at = table.column("bucket").to_numpy()
    for j in range(width):
        out[at, j] = table.column(f"y{j}").to_numpy()
    return out


def basis(y: np.ndarray) -> np.ndarray:
    """Leading right singular vectors of the passages from their sketch."""
    random = omega().astype(np.float64)
    shift = 1e-6 * max(np.linalg.norm(y), 1e-12)
    y = y + shift * random
    inner = random.T @ y
    root = np.linalg.cholesky((inner + inner.T) / 2 + 1e-9 * np.trace(inner) * np.eye(len(inner)))
    u, _, _ = np.linalg.svd(np.linalg.solve(root, y.T).T, full_matrices=False)
    return u[:, :RANK]


class Item:
    """A benchmark item: its words and which of them are the answer."""

    def __init__(self, item_id, hashes: np.ndarray, document_count):
        self.id, self.hashes = item_id, hashes
        distinct = sorted(set(hashes.tolist()), key=lambda h: (document_count(h), h))
        self.answer = distinct[:min(ANSWER_WORDS, max(1, len(distinct) // 2))]
        self.bits: dict[int, int] = {}
        for i, h in enumerate(hashes.tolist()):
            self.bits[h] = self.bits.get(h, 0) | 1 << i

    def common(self, words: list[int]) -> int:
        """Length of the longest common subsequence with ``words``, a bit per word of the
        item: a cleared bit ends a match."""
        n = len(self.hashes)
        full = (1 << n) - 1
        state = full
        for w in words:
            match = state & self.bits.get(w, 0)
            state = ((state + match) | (state - match)) & full
        return n - state.bit_count()


def _search(docs: DataFrame, id_col: str, text: str, items: list[Item], projection: np.ndarray
            ) -> DataFrame:
    vectors = np.stack([projection[buckets(i.hashes)].sum(0) for i in items])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
    plain = [(i.id, i.hashes, i.answer, i.bits) for i in items]
    shared = docs.sparkSession.sparkContext.broadcast(
        (plain, np.vstack([projection, np.zeros((1, RANK))]).astype(np.float32),
         vectors.T.astype(np.float32)))

    def make():
        rows, project, targets = shared.value
        items = []
        for item_id, hashes, answer, bits in rows:
            item = Item.__new__(Item)
            item.id, item.hashes, item.answer, item.bits = item_id, hashes, answer, bits
            items.append(item)
        pairs = sorted((h, n) for n, i in enumerate(items) for h in i.answer)
        answer_hash = np.array([h for h, _ in pairs], np.uint64)
        answer_item = np.array([n for _, n in pairs], np.int64)

        def work(kept, texts):
            words = words_of(texts)
            found = [[] for _ in range(len(texts))]
            starts, begin = cuts(words.first, STEP)
            if len(starts):
                blocks = run_sums(project, run_buckets(words.hashes, starts, STEP))
                steps = np.diff(begin)
                row = np.repeat(np.arange(len(steps)), np.maximum(steps - 1, np.minimum(steps, 1)))
                left = _window_blocks(steps, begin)
                second = np.minimum(left + 1, begin[row + 1] - 1)
                window = blocks[left] + np.where((second > left)[:, None], blocks[second], 0)
                window /= np.maximum(np.linalg.norm(window, axis=1), 1e-12)[:, None]
                ends = np.append(starts[1:], len(words.hashes))
                _check(words, row, starts[left], ends[second], window, targets, items,
                       answer_hash, answer_item, found)
            return [pa.array(found, pa.list_(pa.struct([
                ("item", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()),
                ("answer", pa.float64())])))]
        return work

    hits = map_texts(
        docs, text, {"id": F.col(id_col)},
        "hits array<struct<item: long, cosine: double, lcs: double, answer: double>>", make)
    return (hits.where(F.size("hits") > 0).select("id", F.explode("hits").alias("h"))
            .groupBy("id", F.col("h.item").alias("item_id"))
            .agg(*[F.max(f"h.{c}").alias(c) for c in ("cosine", "lcs", "answer")]))


def _window_blocks(steps: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """First block of each window: all blocks of a row but the last, or its only one."""
    count = np.maximum(steps - 1, np.minimum(steps, 1))
    row = np.repeat(np.arange(len(steps)), count)
    return begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def _check(words, row, low, high, window, targets, items, answer_hash, answer_item, found):
    """Cosine candidates, then their answers, then their common subsequence."""
    n_items = len(items)
    # the items whose answer words each window holds
    left = np.searchsorted(answer_hash, words.hashes, "left")
    places = np.flatnonzero(
        answer_hash[np.minimum(left, len(answer_hash) - 1)] == words.hashes)
    left = left[places]
    times = np.searchsorted(answer_hash, words.hashes[places], "right") - left
    item = answer_item[np.repeat(left, times) + np.arange(times.sum())
                       - np.repeat(np.cumsum(times) - times, times)]
    place = np.repeat(places, times)
    last = np.searchsorted(low, place, "right") - 1
    marks = [np.zeros(0, np.int64)]
    for back in range(3):  # a place is in two windows, or in three at a row's end
        w = np.maximum(last - back, 0)
        inside = (place >= low[w]) & (place < high[w])
        marks.append(w[inside] * n_items + item[inside])
    marks = np.unique(np.concatenate(marks))
    for first in range(0, n_items, 512):
        near = window @ targets[:, first:first + 512]
        w, n = marks // n_items, marks % n_items
        mine = (n >= first) & (n < first + 512)
        w, n = w[mine], n[mine]
        value = near[w, n - first]
        both = value >= COSINE
        for w, n, cosine in zip(w[both].tolist(), n[both].tolist(), value[both].tolist(),
                                strict=True):
            item, r = items[n], int(row[w])
            size = len(item.hashes)
            begin = max(int(words.first[r]), int(low[w]) - size)
            end = min(int(words.first[r + 1]), int(high[w]) + size)
            near_words = words.hashes[begin:end].tolist()
            share = len(set(item.answer).intersection(near_words)) / len(item.answer)
            if share < ANSWER_SHARE:
                continue
            lcs = item.common(near_words) / size
            if lcs >= LCS:
                found[r].append({"item": item.id, "cosine": cosine, "lcs": lcs, "answer": share})


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text: str = "text", item_col: str = "item_id", item_text: str = "text"
               ) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains, whole or reworded:
    id, item_id, cosine, lcs, answer (shares of the item)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    items = benchmark.select(F.col(item_col).cast("long").alias("item"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    items = items.where(F.col("item").isNotNull()).distinct()
    n_blocks = -(-items.count() // BLOCK_ITEMS)
    empty = spark.createDataFrame(
        [], f"{id_col} {kind}, item_id long, cosine double, lcs double, answer double")
    if not n_blocks:
        return empty
    block_of = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    blocks = []
    for b in range(n_blocks):
        rows = items.where(block_of == b).orderBy("item", "text").collect()
        if not rows:
            continue
        hashes = []
        for _, _, texts in split_texts(pa.array([r.text for r in rows], pa.string())):
            words = words_of(texts)
            hashes += [words.hashes[a:e] for a, e in zip(words.first, words.first[1:])]
        blocks.append([(r.item, h) for r, h in zip(rows, hashes, strict=True)
                       if len(h) >= LEAST_WORDS])
    vocabulary = np.unique(np.concatenate(
        [h for block in blocks for _, h in block] or [np.zeros(0, np.uint64)]))
    if not len(vocabulary):
        return empty
    counts = frequencies(docs, items, text, vocabulary)
    n_docs, n_items = counts["passages"]
    idf = np.log((1 + n_docs + n_items) / (1 + counts["bucket"])) + 1e-3
    y = sketch(docs, items, text, idf, n_docs / max(n_items, 1) if n_docs else 1.0)
    projection = idf[:, None] * basis(y)

    def document_count(h: int) -> float:
        """Words of a few documents are equally rare: which copies of an item lack a word
        must not decide what its answer is."""
        return max(counts["word"][np.searchsorted(vocabulary, np.uint64(h))], 32.0)

    out = empty
    for block in blocks:
        if block:
            found = _search(docs, id_col, text,
                            [Item(i, h, document_count) for i, h in block], projection)
            out = out.unionByName(found.withColumnRenamed("id", id_col))
    return out


@query()
def op1_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"),
                      read_table(spark, sf_dir, "benchmark"))
