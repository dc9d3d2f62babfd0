"""Mixing to target weights with soft membership.

Domains come from the labelled table: toxic texts, good texts and poor texts. A softmax
classifier over hashed words and structure, fitted on at most ``max_rows`` labelled
documents, gives every document its posterior over the domains, so a document counts in
each domain with a share of its tokens. Document rates between ``min_rate`` and ``max_rate``
are then fitted by projected gradient steps so that the expected tokens ``E_k = sum n r p_k`` of
the domains meet the targets ``T_k`` in least squares. Residuals are weighted by the inverse
of ``G = sum n p p'`` over the documents whose rates are not at a bound, the tokens per
unit of step, so a rare domain does not hold up the others: without a bound in the way one step
meets the targets. A step that makes the error larger is halved.

The rate of a document follows from its posterior and the history of the few steps. So a step is
one pass over a compact table of token counts and posteriors that returns one row per task, the
history is all the state there is, and a lost task is simply run again. If the targets
are out of reach (no mixture of the documents has these shares, or ``max_rate`` is in the
way), a warning says so, ``_met`` is false, and the rates are the best found. In the end a
document is repeated ``floor(rate)`` times, and once more if a hash of its id and text falls
below the fraction.

Defined cases: null and empty texts have no tokens, a posterior and a rate; a null id hashes
as such; without labels all domains are equally likely; a domain without tokens has no
target, and its weight is left to the others; rows with equal texts get equal rates, and equal
rows as many copies each; an empty table gives no rows; other columns are kept as they are, but
not under the names ``_tokens``, ``_posterior``, ``_rate``, ``_met``, which is an error.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..plans.registry import query
from ..session import cut_lineage
from .factorisation import N_STATS, Features
from .labelled import arrays_of, labelled_sample, sampled_rows, with_sample
from .textwords import map_texts, read_table

DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.87, "poor": 0.08, "toxic": 0.05}
BITS = 16
MAX_LABELLED = 10_000
MAX_STEPS = 60
#: Targets are met if each domain's tokens differ by no more than this share of its target.
TOLERANCE = 1e-3
#: An error that falls by less than this share in a step does not fall any more.
STALLED = 0.01


def domain_label() -> Column:
    """The domain of a labelled row, as an index into ``DOMAINS``."""
    return F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 0).otherwise(1)


class Softmax:
    """Linear scores of the domains from words and statistics. Words seen in fewer than
    ``least`` labelled texts would only be learnt by heart and have no weight."""

    def __init__(self, bits: int, n_stats: int, kinds: int):
        self.word = np.zeros((1 << bits, kinds), np.float32)
        self.stat = np.zeros((n_stats, kinds), np.float32)
        self.bias = np.zeros(kinds, np.float32)
        self.mean = np.zeros(n_stats, np.float32)
        self.scale = np.ones(n_stats, np.float32)

    def posterior(self, buckets, first, rows, stats):
        s = np.clip((stats - self.mean) / self.scale, -5, 5)
        n, kinds = len(first) - 1, len(self.bias)
        raw = s @ self.stat + self.bias
        for k in range(kinds):
            raw[:, k] += np.bincount(rows, weights=self.word[buckets, k], minlength=n)
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True), s

    def fit(self, buckets, stats, labels, epochs: int = 6, batch: int = 64, rate: float = 0.05,
            least: int = 5):
        self.mean, self.scale = stats.mean(0), stats.std(0) + 1e-3
        texts_with = np.zeros(len(self.word), np.int32)
        for b in buckets:
            texts_with[b] += 1
        buckets = [b[texts_with[b] >= least] for b in buckets]
        kinds, rng = len(self.bias), np.random.default_rng(3)
        sums = [np.full_like(w, 1e-4) for w in (self.word, self.stat, self.bias)]
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                take = order[at:at + batch]
                sizes = np.array([len(buckets[i]) for i in take])
                first = np.concatenate(([0], np.cumsum(sizes)))
                rows = np.repeat(np.arange(len(take)), sizes)
                b = np.concatenate([buckets[i] for i in take])
                p, s = self.posterior(b, first, rows, stats[take])
                p[np.arange(len(take)), labels[take]] -= 1
                err = p / len(take)
                used, place = np.unique(b, return_inverse=True)
                g = np.stack([np.bincount(place, weights=err[rows, k],
                                          minlength=len(used)) for k in range(kinds)], axis=1)
                for w, total, where, d in ((self.word, sums[0], used, g),
                                           (self.stat, sums[1], slice(None), s.T @ err),
                                           (self.bias, sums[2], slice(None), err.sum(0))):
                    d = d + 1e-5 * w[where]
                    total[where] += d * d
                    w[where] -= rate * d / np.sqrt(total[where])


def fit_domains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                label: Column | None = None, kinds: int = len(DOMAINS), bits: int = BITS,
                max_rows: int = MAX_LABELLED) -> Softmax:
    label = domain_label() if label is None else label
    known = labels.where(F.col("toxic").isNotNull() & F.col("quality").isNotNull())
    sample = labelled_sample(known, label, F.lit(True), max_rows, id_col)

    def make():
        def work(kept, texts):
            f = Features(texts, [], bits)
            return [pa.array([f.buckets[a:b].tobytes() for a, b in zip(f.first, f.first[1:])],
                             pa.binary()),
                    pa.array([r.tobytes() for r in f.stats], pa.binary())]
        return work

    keep = {"id": F.col(id_col), "label": F.col("_label")}
    features = map_texts(with_sample(docs, sample, id_col), text, keep,
                         "buckets binary, stats binary", make)
    rows = sampled_rows(features, "id", "label", "buckets", "stats")
    model = Softmax(bits, N_STATS, kinds)
    if rows.num_rows:
        model.fit(arrays_of(rows, "buckets", np.uint32),
                  np.stack(arrays_of(rows, "stats", np.float32)),
                  rows.column("label").to_numpy().astype(np.int64))
    return model


def with_posteriors(docs: DataFrame, model: Softmax, keep: dict, text: str = "text",
                    bits: int = BITS) -> DataFrame:
    """Columns ``keep``, ``_tokens`` (words) and ``_posterior``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        model = Softmax.__new__(Softmax)
        vars(model).update(shared.value)

        def work(kept, texts):
            f = Features(texts, [], bits)
            p, _ = model.posterior(f.buckets, f.first, f.rows, f.stats)
            tokens = f.n_words.astype(np.int64)
            ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * p.shape[1])
            return [tokens, pa.ListArray.from_arrays(ends, pa.array(p.astype(np.float64).ravel()))]
        return work

    return map_texts(docs, text, keep, "_tokens long, _posterior array<double>", make)


class Rates(NamedTuple):
    """How rates follow from posteriors, and whether they meet the targets."""

    history: list[np.ndarray]
    least: float
    most: float
    met: bool

    def of(self, posterior: np.ndarray) -> np.ndarray:
        rate = np.clip(np.ones(len(posterior)), self.least, self.most)
        for step in self.history:
            rate = np.clip(rate - posterior @ step, self.least, self.most)
        return rate


def _matrix(column: pa.Array, kinds: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, kinds)


def fit_rates(table: DataFrame, weights: Sequence[float], budget: float | None = None,
              min_rate: float = 0.0, max_rate: float = np.inf, max_steps: int = MAX_STEPS,
              tolerance: float = TOLERANCE) -> Rates:
    """Rates for a ``table`` with ``_tokens`` and ``_posterior``; the budget is all tokens it
    has unless given."""
    kinds = len(weights)
    names = [f"k{i}" for i in range(kinds + kinds * kinds)]

    def totals(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each domain at the rates, and ``G``."""
        rates = Rates(history, min_rate, max_rate, False)

        def add(batches):
            total, free = np.zeros(kinds), np.zeros((kinds, kinds))
            for batch in batches:
                p, n = _matrix(batch.column(1), kinds), batch.column(0).to_numpy()
                r = rates.of(p)
                total += (n * r) @ p
                free += (p * (n * ((r > min_rate) & (r < max_rate)))[:, None]).T @ p
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(x)]) for x in [*total, *free.ravel()]], names)

        parts = table.select("_tokens", "_posterior").mapInArrow(
            add, ", ".join(f"{n} double" for n in names))
        row = np.array([x or 0.0 for x in parts.agg(*[F.sum(n) for n in names]).first()])
        return row[:kinds], row[kinds:].reshape(kinds, kinds)

    now, free = totals([])
    some = now > 1e-12 * max(now.sum(), 1e-9)
    share = np.where(some, np.asarray(weights, float), 0)
    target = (now.sum() if budget is None else budget) * share / max(share.sum(), 1e-12)
    history: list[np.ndarray] = []
    best, halved = np.inf, 0
    for _ in range(max_steps):
        residual = np.where(some, now - target, 0)
        # of what is wanted, so that a rare domain counts as much as the others
        error = np.abs(residual) / np.maximum(np.where(target > 0, target, target.sum()), 1e-9)
        if (error <= tolerance).all():
            return Rates(history, min_rate, max_rate, True)
        error = error.sum()
        if error > (1 - STALLED) * best:
            if halved == 5:
                history.pop()
                break
            history[-1] = history[-1] / 2
            halved += 1
        else:
            best, halved = error, 0
            scale = 1 / np.sqrt(np.maximum(np.diag(free), 1e-300))
            step = np.linalg.lstsq(free * scale[:, None] * scale, residual * scale, rcond=1e-10)[0]
            history.append(step * scale)
        now, free = totals(history)
    warnings.warn(f"targets {target} are not met: {now}", stacklevel=2)
    return Rates(history, min_rate, max_rate, False)


def with_rates(scored: DataFrame, rates: Rates, kinds: int) -> DataFrame:
    """``scored`` and a column ``_rate``."""
    at = scored.columns.index("_posterior")
    schema = StructType([*scored.schema.fields, StructField("_rate", DoubleType())])

    def run(batches):
        for batch in batches:
            rate = rates.of(_matrix(batch.column(at), kinds))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)],
                                             [*batch.schema.names, "_rate"])

    return scored.mapInArrow(run, schema)


def copies(rate: str, *known_by: str | Column, seed: int = 17) -> Column:
    """How often a document is taken: the rate on average over documents."""
    chance = F.pmod(F.xxhash64(F.lit(seed), *known_by), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(F.col(rate) + chance).cast("long")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], keep: dict,
        id_col: str = "doc_id", text: str = "text", budget: float | None = None,
        min_rate: float = 0.0, max_rate: float = np.inf) -> DataFrame:
    """Columns ``keep``, ``_tokens``, ``_posterior``, ``_rate`` and ``_met``, for every row."""
    if taken := {"_tokens", "_posterior", "_rate", "_met"} & set(keep):
        raise ValueError(f"columns are named as the result's own: {sorted(taken)}")
    model = fit_domains(docs, labels, id_col, text)
    scored = cut_lineage(with_posteriors(docs, model, keep, text))
    rates = fit_rates(scored, [weights[d] for d in DOMAINS], budget, min_rate, max_rate)
    return with_rates(scored, rates, len(DOMAINS)).withColumn("_met", F.lit(rates.met))


@query()
def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    mixed = mix(docs, read_table(spark, sf_dir, "labels"), WEIGHTS,
                {"doc_id": F.col("doc_id"), "content": F.xxhash64("text")})
    posterior = [F.col("_posterior")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return mixed.select("doc_id", F.col("_tokens").alias("n_tokens"), *posterior,
                        F.col("_rate").alias("rate"),
                        copies("_rate", "doc_id", "content").alias("copies"),
                        F.col("_met").alias("targets_met"))
