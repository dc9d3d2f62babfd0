import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millstream.llm import factorisation, ftrl, soft_mixing
from millstream.llm.factorisation import Features, Machine
from millstream.llm.textwords import split_texts

from corpus_samples import (  # noqa: F401
    MESSY, labels, messy, no_docs, no_labels, table_rows,
)


def auc(scores, labels):
    rank = np.argsort(np.argsort(scores))
    n = labels.sum()
    return (rank[labels == 1].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


def test_linear_time_is_the_sum_over_all_pairs():
    _, _, texts = next(split_texts(pa.array(["one two three two", "", "FOUR! five | six"])))
    f = Features(texts, [], 10)
    machine = Machine(10, 4, f.stats.shape[1])
    rng = np.random.default_rng(0)
    for name in ("word", "word_v", "stat", "stat_v"):
        getattr(machine, name)[:] = rng.standard_normal(getattr(machine, name).shape)
    raw = machine.parts(f.buckets, f.first, f.rows, f.stats)[0]
    for r in range(3):
        own = f.buckets[f.first[r]:f.first[r + 1]]
        x = np.concatenate([np.full(len(own), 1 / np.sqrt(max(len(own), 1))),
                            np.clip(f.stats[r], -5, 5)])
        w = np.concatenate([machine.word[own], machine.stat])
        v = np.concatenate([machine.word_v[own], machine.stat_v])
        pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert raw[r] == pytest.approx(w @ x + pairs, rel=1e-4, abs=1e-4)


def test_ftrl_weights_are_sparse_and_follow_the_rule():
    model = ftrl.Ftrl(4, alpha=0.5, beta=1.0, l1=1.0, l2=0.1)
    for _ in range(50):
        model.learn(np.array([1, 3, 16]), 1.0)
        model.learn(np.array([2, 3, 16]), 0.0)
    at, weights, _ = model.compact()
    assert 1 in at and 2 in at and 5 not in at
    assert weights[list(at).index(1)] > 0 > weights[list(at).index(2)]
    z, n = model.z[1], model.n[1]
    assert model.weights(1) == pytest.approx(
        -(z - np.sign(z)) / ((1 + np.sqrt(n)) / 0.5 + 0.1))


@pytest.mark.parametrize("module, fit, score", [
    (factorisation, "fit_quality", "score_quality"), (ftrl, "fit_toxicity", "score_toxicity")])
def test_messy_documents(messy, no_docs, labels, no_labels, module, fit, score):
    model = getattr(module, fit)(messy, labels, F.lit(True))
    keep = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    rows = getattr(module, score)(messy, model, keep).collect()
    assert len(rows) == len(MESSY)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert getattr(module, score)(no_docs, model, keep).count() == 0
    blank = getattr(module, fit)(messy, no_labels, F.lit(True))
    assert {r.score for r in getattr(module, score)(messy, blank, keep).collect()} == {0.5}
    getattr(module, fit)(no_docs, labels, F.lit(True))


@pytest.mark.parametrize("query, label, cut, least", [
    (factorisation.op3_factorisation_machine, "quality", 0.7, 0.95),
    (ftrl.op4_ftrl_toxicity, "toxic", 0.5, 0.9)])
def test_held_out(spark, query, label, cut, least):
    truth = dict(table_rows("sf0.1", f"SELECT doc_id, {label} FROM '{{d}}/labels.parquet'"))
    rows = query(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000
    assert all(r.predicted == (r.score >= cut) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(*map(np.array, zip(*held))) > least


def test_domains_and_rates(spark, messy, no_docs, labels, no_labels):
    weights = soft_mixing.WEIGHTS
    for docs, known in ((messy, labels), (messy, no_labels)):
        rows = soft_mixing.mix(docs, known, weights, {"doc_id": F.col("doc_id")}).collect()
        assert len(rows) == len(MESSY)
        assert all(r._rate >= 0 and sum(r._posterior) == pytest.approx(1) for r in rows)
    assert soft_mixing.mix(no_docs, labels, weights, {"doc_id": F.col("doc_id")}).count() == 0


def test_targets_are_met(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.2, 0.1], 500)
    tokens = rng.integers(0, 1000, 500)
    table = spark.createDataFrame(
        [(int(n), [float(x) for x in q]) for n, q in zip(tokens, p)],
        "_tokens long, _posterior array<double>").repartition(3)
    rates = soft_mixing.fit_rates(table, (0.6, 0.3, 0.1), budget=300_000.0)
    assert rates.met
    got = soft_mixing.with_rates(table, rates, 3).collect()
    total = sum(r._tokens * r._rate * np.array(r._posterior) for r in got)
    assert total == pytest.approx(300_000 * np.array([0.6, 0.3, 0.1]), rel=1e-3)
    assert min(r._rate for r in got) >= 0


@pytest.mark.parametrize("rare", [1e-3, 1e-6])
def test_a_rare_domain_meets_its_target(spark, rare):
    """Without losing the documents of the others."""
    rng = np.random.default_rng(4)
    n = 4000
    kind = rng.choice(2, n, p=[0.85, 0.15])
    p = np.full((n, 3), 1e-3)
    p[np.arange(n), kind] = 1
    p[:, 2] *= rare
    p[7] = [1e-3, 1e-3, 1]
    p /= p.sum(1, keepdims=True)
    tokens = rng.integers(100, 2000, n)
    tokens[7] = max(1, int(rare * tokens.sum()))
    table = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)],
                                  "_tokens long, _posterior array<double>").repartition(3)
    weights = np.array([0.7, 0.29, 0.01])
    rates = soft_mixing.fit_rates(table, weights)
    assert rates.met and len(rates.history) <= 3
    got = soft_mixing.with_rates(table, rates, 3).collect()
    total = sum(r._tokens * r._rate * np.array(r._posterior) for r in got)
    assert total == pytest.approx(tokens.sum() * weights, rel=0.01)
    assert np.mean([r._rate < 0.5 for r in got]) < 0.01
    # with a bound it is out of reach, and that is said
    with pytest.warns(UserWarning, match="not met"):
        rates = soft_mixing.fit_rates(table, weights, max_rate=3.0)
    got = soft_mixing.with_rates(table, rates, 3).collect()
    assert not rates.met and max(r._rate for r in got) == 3.0
    assert np.mean([r._rate < 0.5 for r in got]) < 0.01


def test_targets_beyond_any_mixture(spark):
    """Every document is mostly of the first domain."""
    table = spark.createDataFrame([(10, [0.9, 0.1]), (20, [0.8, 0.2])],
                                  "_tokens long, _posterior array<double>")
    with pytest.warns(UserWarning, match="not met"):
        rates = soft_mixing.fit_rates(table, (0.1, 0.9))
    assert not rates.met and len(rates.history) < 10


def test_a_domain_without_tokens_has_no_target(spark):
    table = spark.createDataFrame([(10, [1.0, 0.0]), (30, [1.0, 0.0])],
                                  "_tokens long, _posterior array<double>")
    fitted = soft_mixing.fit_rates(table, (0.5, 0.5), budget=80.0)
    rates = [r._rate for r in soft_mixing.with_rates(table, fitted, 2).collect()]
    assert rates == pytest.approx([2, 2], rel=1e-3)


def test_copies_average_to_the_rate(spark):
    """Also without ids: then the texts decide."""
    ids = spark.range(20_000).withColumn("_rate", F.lit(1.3))
    for known_by in (["id"], [F.lit(None).cast("long"), "id"]):
        n = ids.agg(F.avg(soft_mixing.copies("_rate", *known_by))).first()[0]
        assert n == pytest.approx(1.3, abs=0.02)
