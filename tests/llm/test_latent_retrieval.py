import random
import re

import numpy as np
import pytest
from corpus_samples import ascii_lower, messy, no_docs  # noqa: F401

from millstream.llm.latent_retrieval import (
    RANK, Item, basis, find_leaks, omega, op1_latent_retrieval,
)


def _words(rng, n):
    return [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3
            else "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark):
    """Items whole, with a fifth of the words replaced, with words dropped, and decoys
    that share a line with an item."""
    rng = random.Random(9)
    items = [(i, _words(rng, rng.randint(15, 60))) for i in range(40)]
    docs, want = [], set()
    for d in range(300):
        body, item = _words(rng, rng.randint(20, 400)), items[d % 40]
        words = list(item[1])
        kind = d % 5
        if kind == 1:
            for _ in range(len(words) // 6):
                words[rng.randrange(len(words))] = "changed"
        elif kind == 2:
            words = [w for w in words if rng.random() > 0.12]
        elif kind == 3:
            words = words[:6]
        if kind < 4:
            at = rng.randrange(len(body))
            body[at:at] = words
        if kind < 3:
            want.add((d, item[0]))
        docs.append((d, " ".join(body).capitalize() + "."))
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame([(i, " ".join(w)) for i, w in items],
                                  "item_id long, text string"), want)


def test_planted_passages(planted):
    docs, items, want = planted
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    assert got == want


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randint(5, 30))]
        b = [rng.randrange(5) for _ in range(rng.randint(0, 40))]
        row = [0] * (len(b) + 1)
        for x in a:
            last = list(row)
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        item = Item(0, np.array(a, np.uint64), lambda h: h)
        assert item.common(b) == row[-1]


def test_the_sketch_gives_the_leading_singular_vectors():
    rng = np.random.default_rng(0)
    d = len(omega())
    rows = np.zeros((300, d))
    topics = rng.integers(0, d, (10, 30))
    for r in range(300):
        rows[r, topics[r % 10]] = 3 + rng.random(30)
        rows[r, rng.integers(0, d, 5)] += 0.2
    found = basis(rows.T @ (rows @ omega().astype(float)))
    _, _, vt = np.linalg.svd(rows, full_matrices=False)
    assert found.shape == (d, RANK)
    overlap = np.linalg.norm(found.T @ vt[:10].T, axis=0)
    assert overlap.min() > 0.99


def test_messy_documents(spark, messy, no_docs):  # noqa: F811
    items = spark.createDataFrame(
        [(1, "the cat sat on the mat and the dog did not"), (1, None), (2, ""), (3, "w"),
         (None, "the cat sat on the mat and the dog did not"),
         (4, "a text without an id that is long enough")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(messy, items).collect()}
    assert got == {(1, 1), (2, 1), (None, 4)}
    assert find_leaks(no_docs, items).count() == 0
    assert find_leaks(messy, items.limit(0)).count() == 0


def test_whole_items_in_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    split = lambda t: " ".join(re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t)))
    docs = [(r.doc_id, f" {split(r.text)} ") for r in
            spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, f" {split(r.text)} ") for r in
             spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, b in items if b in t}
    got = {(r.doc_id, r.item_id) for r in op1_latent_retrieval(spark, sf).collect()}
    assert want and want <= got
    assert len(got - want) <= 0.02 * len(docs)
