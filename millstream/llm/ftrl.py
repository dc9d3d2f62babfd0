"""Toxicity: logistic regression by FTRL-proximal over hashed n-grams and skip-grams.

A document has one feature per distinct hashed word, word pair and pair with one word
between. Every coordinate has a learning rate of its own, and the L1 term keeps the
weights of uninformative coordinates at exactly 0, so that a model is its few thousand
weights that are not. The number of coordinates is fixed, which bounds the broadcast.

It is fitted, one document after the other, on at most ``max_rows`` labelled documents
that Spark has reduced to their features. Scoring is one pass without a shuffle.

Defined cases: null and empty texts have no features and get the score of the bias;
without labels every score is 0.5; repeated rows get equal scores; columns other than id
and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from .labelled import arrays_of, labelled_sample, sampled_rows, with_sample
from .textwords import Texts, grams, map_texts, read_table, remainder, row_keys, words_of

BITS = 20
SHAPES = ((0,), (0, 1), (0, 2))  # words, pairs of neighbours, pairs with one between
MAX_LABELLED = 10_000


def features(texts: Texts, bits: int):
    """For each shape the rows and buckets of the word combinations, repeats included."""
    words = words_of(texts)
    for shape in SHAPES:
        hashes, rows = ((words.hashes, words.rows()) if shape == (0,)
                        else grams(words.hashes, words.first, shape))
        yield rows, (hashes >> np.uint64(64 - bits)).astype(np.uint32)


class Ftrl:
    """State and updates; ``weights`` solves each coordinate in closed form."""

    def __init__(self, bits: int, alpha: float = 1.0, beta: float = 1.0,
                 l1: float = 4.0, l2: float = 0.01):
        self.z = np.zeros((1 << bits) + 1)  # the last coordinate is the bias
        self.n = np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.alpha * w

    def compact(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Coordinates with a weight, their weights, and the bias."""
        w = self.weights(slice(None)).astype(np.float32)
        at = np.flatnonzero(w[:-1])
        return at.astype(np.uint32), w[at], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, trainable, id_col: str = "doc_id",
                 text: str = "text", label: str = "toxic", bits: int = BITS,
                 max_rows: int = MAX_LABELLED, epochs: int = 5, min_docs: int = 5
                 ) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on at most ``max_rows`` labelled documents for which ``trainable`` holds.
    Features of fewer than ``min_docs`` of these would only be learnt by heart."""
    sample = labelled_sample(labels, F.col(label), trainable, max_rows, id_col)
    chosen = with_sample(docs, sample, id_col)

    def make():
        def work(kept, texts):
            keys = np.unique(np.concatenate([
                row_keys(rows, b.astype(np.uint64) << np.uint64(64 - bits))
                for rows, b in features(texts, bits)]))
            rows = (keys >> np.uint64(52)).astype(np.int64)
            buckets = ((keys >> np.uint64(52 - bits)) & np.uint64((1 << bits) - 1)).astype(
                np.uint32)
            first = np.searchsorted(rows, np.arange(len(texts) + 1))
            return [pa.array([buckets[a:b].tobytes() for a, b in zip(first, first[1:])],
                             pa.binary())]
        return work

    keep = {"id": F.col(id_col), "label": F.col("_label")}
    rows = sampled_rows(map_texts(chosen, text, keep, "buckets binary", make),
                        "id", "label", "buckets")
    found = arrays_of(rows, "buckets", np.uint32)
    labels_of = rows.column("label").to_pylist()
    counts = np.zeros((1 << bits) + 1, np.int32)
    for at in found:
        counts[at] += 1
    counts[-1] = min_docs  # the bias
    found = [np.append(at[counts[at] >= min_docs], np.uint32(1 << bits)) for at in found]
    model = Ftrl(bits)
    for _ in range(epochs):
        for at, label_of in zip(found, labels_of, strict=True):
            model.learn(at, float(label_of > 0))
    return model.compact()


def score_toxicity(docs: DataFrame, model, keep: dict, text: str = "text",
                   bits: int = BITS) -> DataFrame:
    """Columns ``keep`` and ``score``, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        at, weights, bias = shared.value
        dense = np.zeros(1 << bits, np.float32)
        dense[at] = weights

        def work(kept, texts):
            found = []
            for rows, buckets in features(texts, bits):
                hit = np.flatnonzero(dense[buckets])
                found.append(row_keys(rows[hit], buckets[hit].astype(np.uint64)
                                      << np.uint64(64 - bits)))
            keys = np.unique(np.concatenate(found))  # a feature counts once per text
            rows = (keys >> np.uint64(52)).astype(np.int64)
            bucket = (keys >> np.uint64(52 - bits)) & np.uint64((1 << bits) - 1)
            raw = bias + np.bincount(rows, weights=dense[bucket], minlength=len(texts))
            return [1 / (1 + np.exp(-np.clip(raw, -30, 30)))]
        return work

    return map_texts(docs, text, keep, "score double", make)


@query()
def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    model = fit_toxicity(docs, labels, ~held_out)
    scored = score_toxicity(docs, model, {"doc_id": F.col("doc_id")})
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
