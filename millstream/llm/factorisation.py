"""Quality classifier: a factorisation machine over words, structure and metadata.

A document has one feature per distinct hashed word, a dozen statistics of its structure,
and the logarithms of numeric metadata columns. The machine scores
``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise part is computed in time
linear in the features, as half of ``|sum v_i x_i|**2 - sum |v_i x_i|**2``.

It is fitted with Adagrad on at most ``max_rows`` labelled documents, which are reduced to
their features by Spark. The weights have a fixed size (``2**bits`` rows), which is why
they are broadcast; scoring is one pass over the documents without a shuffle.

Defined cases: null texts and empty texts have no words and zero statistics and still get
a score; null metadata counts as 0; without labels every score is 0.5; repeated rows get
equal scores; columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from .labelled import arrays_of, labelled_sample, sampled_rows, with_sample
from .textwords import Texts, fresh_name, map_texts, read_table, remainder, row_keys, words_of

BITS = 18
RANK = 8
MAX_LABELLED = 12_000

_KINDS = np.zeros(256, np.uint8)  # 0 small letters and the rest
_KINDS[65:91] = 1
_KINDS[48:58] = 2
_KINDS[[9, 11, 12, 13, 32]] = 3
_KINDS[10] = 4
_KINDS[[ord(c) for c in ".,;:?'\"-()"]] = 5
_KINDS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_KINDS[128:] = 7
N_STATS = 12


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, 0 for an empty one."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


class Features:
    """Features of a chunk: ``buckets`` row by row (``first`` has the bounds) and
    ``stats``, a row of numbers for each text."""

    def __init__(self, texts: Texts, metadata: list[pa.Array], bits: int):
        n = len(texts)
        words = words_of(texts)
        keys = np.unique(row_keys(words.rows(), words.hashes >> np.uint64(64 - bits)
                                  << np.uint64(64 - bits)))
        self.buckets = ((keys >> np.uint64(52 - bits)) & np.uint64((1 << bits) - 1)).astype(
            np.uint32)
        rows = (keys >> np.uint64(52)).astype(np.int64)
        self.first = np.searchsorted(rows, np.arange(n + 1))
        self.rows = rows
        size = np.maximum(np.diff(texts.offsets), 1)
        n_words = np.diff(words.first)
        self.n_words = n_words
        some = np.maximum(n_words, 1)
        kinds = _KINDS[texts.data]
        shares = [row_sums(kinds == k, texts.offsets) / size for k in range(1, 8)]
        again = np.zeros(len(words.hashes), bool)
        again[1:] = words.hashes[1:] == words.hashes[:-1]
        again[words.first[:-1][n_words > 0]] = False
        length = row_sums(words.ends - words.starts, words.first) / some
        stats = [*shares, np.diff(self.first) / some, row_sums(again, words.first) / some,
                 length / 8, np.log1p(n_words) / 8, size / some / 16]
        for column in metadata:
            value = column.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
            value = np.nan_to_num(value, posinf=0.0, neginf=0.0)
            stats.append(np.sign(value) * np.log1p(np.abs(value)) / 8)
        self.stats = np.stack(stats, axis=1).astype(np.float32)


class Machine:
    """Weights and scores. Words of a document share a length of 1."""

    def __init__(self, bits: int, rank: int, n_stats: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.word = np.zeros(1 << bits, np.float32)
        self.word_v = (0.02 * rng.standard_normal((1 << bits, rank))).astype(np.float32)
        self.stat = np.zeros(n_stats, np.float32)
        self.stat_v = (0.02 * rng.standard_normal((n_stats, rank))).astype(np.float32)
        self.mean = np.zeros(n_stats, np.float32)
        self.scale = np.ones(n_stats, np.float32)

    def parts(self, buckets, first, rows, stats):
        """Scores, and what a gradient needs besides."""
        n = len(first) - 1
        s = np.clip((stats - self.mean) / self.scale, -5, 5)
        x = 1 / np.sqrt(np.maximum(np.diff(first), 1)).astype(np.float32)
        v = self.word_v[buckets]
        total = np.stack([np.bincount(rows, weights=v[:, f], minlength=n)
                          for f in range(v.shape[1])], axis=1) * x[:, None] + s @ self.stat_v
        own = (np.bincount(rows, weights=np.einsum("ij,ij->i", v, v), minlength=n) * x * x
               + (s * s) @ (self.stat_v ** 2).sum(1))
        linear = np.bincount(rows, weights=self.word[buckets], minlength=n) * x + s @ self.stat
        return self.bias + linear + 0.5 * ((total ** 2).sum(1) - own), s, x, v, total

    def score(self, f: Features) -> np.ndarray:
        raw = self.parts(f.buckets, f.first, f.rows, f.stats)[0]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))

    def fit(self, buckets: list[np.ndarray], stats: np.ndarray, labels: np.ndarray,
            epochs: int = 6, batch: int = 64, rate: float = 0.15, decay: float = 1e-5) -> None:
        self.mean, self.scale = stats.mean(0), stats.std(0) + 1e-3
        sums = [np.full_like(w, 1e-4) for w in (self.word, self.word_v, self.stat, self.stat_v)]
        bias_sum, rng = 1e-4, np.random.default_rng(11)
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                take = order[at:at + batch]
                sizes = np.array([len(buckets[i]) for i in take])
                first = np.concatenate(([0], np.cumsum(sizes)))
                rows = np.repeat(np.arange(len(take)), sizes)
                b = np.concatenate([buckets[i] for i in take])
                raw, s, x, v, total = self.parts(b, first, rows, stats[take])
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[take]) / len(take)
                ex = (err * x)[rows]
                used, place = np.unique(b, return_inverse=True)
                g_word = np.bincount(place, weights=ex, minlength=len(used))
                g_v = np.stack([
                    np.bincount(place, weights=ex * (total[rows, f] - v[:, f] * x[rows]),
                                minlength=len(used)) for f in range(v.shape[1])], axis=1)
                g_sv = np.einsum("n,ni,nf->if", err, s, total) - (err @ (s * s))[:, None] * self.stat_v
                steps = ((self.word, sums[0], used, g_word), (self.word_v, sums[1], used, g_v),
                         (self.stat, sums[2], slice(None), err @ s),
                         (self.stat_v, sums[3], slice(None), g_sv))
                for w, total_sq, where, g in steps:
                    g = g + decay * w[where]
                    total_sq[where] += g * g
                    w[where] -= rate * g / np.sqrt(total_sq[where])
                bias_sum += err.sum() ** 2
                self.bias -= rate * err.sum() / np.sqrt(bias_sum)


def fit_quality(docs: DataFrame, labels: DataFrame, trainable, id_col: str = "doc_id",
                text: str = "text", label: str = "quality",
                metadata: Sequence[str] = ("n_chars",), bits: int = BITS, rank: int = RANK,
                max_rows: int = MAX_LABELLED) -> Machine:
    """Fit on at most ``max_rows`` labelled documents for which ``trainable`` holds."""
    sample = labelled_sample(labels, F.col(label), trainable, max_rows, id_col)
    chosen = with_sample(docs, sample, id_col)

    def make():
        def work(kept, texts):
            f = Features(texts, kept[2:], bits)
            return [pa.array([f.buckets[a:b].tobytes() for a, b in zip(f.first, f.first[1:])],
                             pa.binary()),
                    pa.array([r.tobytes() for r in f.stats], pa.binary())]
        return work

    keep = {"id": F.col(id_col), "label": F.col("_label")}
    keep |= {f"meta{i}": F.col(m).cast("double") for i, m in enumerate(metadata)}
    rows = sampled_rows(map_texts(chosen, text, keep, "buckets binary, stats binary", make),
                        "id", "label", "buckets", "stats")
    machine = Machine(bits, rank, N_STATS + len(metadata))
    if not rows.num_rows:
        machine.word_v[:] = machine.stat_v[:] = 0  # nothing is known
    else:
        machine.fit(arrays_of(rows, "buckets", np.uint32),
                    np.stack(arrays_of(rows, "stats", np.float32)),
                    (rows.column("label").to_numpy() > 0).astype(float))
    return machine


def score_quality(docs: DataFrame, machine: Machine, keep: dict, text: str = "text",
                  metadata: Sequence[str] = ("n_chars",), bits: int = BITS,
                  out: str = "score") -> DataFrame:
    """Columns ``keep`` and ``out``, the score, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(machine))
    n = len(keep)

    def make():
        model = Machine.__new__(Machine)
        vars(model).update(shared.value)  # plain arrays travel

        def work(kept, texts):
            return [model.score(Features(texts, kept[n:], bits))]
        return work

    own = {fresh_name(f"_meta{i}", [*keep, out]): F.col(m).cast("double")
           for i, m in enumerate(metadata)}
    return map_texts(docs, text, keep | own, f"{out} double", make).drop(*own)


@query()
def op3_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 4) == 2
    machine = fit_quality(docs, labels, ~held_out)
    scored = score_quality(docs, machine, {"doc_id": F.col("doc_id")})
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))
