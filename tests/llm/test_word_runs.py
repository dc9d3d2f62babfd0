import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_samples import LONG, MESSY, messy, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from millstream.llm.textwords import split_texts
from millstream.llm.word_runs import (
    numbered_words, op11_word_runs, planted_repeats, runs_of, word_runs,
)
from pyspark.sql import functions as F


def plain_runs(words, least=12):
    """Every maximal stretch of every period, by looking at all of them."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.sampled_from([2, 4, 12]))
def test_runs_are_those_of_a_full_search(texts, least):
    first = np.cumsum([0, *map(len, texts)])
    codes = np.array([c for t in texts for c in t], np.int64)
    begin, end, period = runs_of(codes, first, least)
    got = sorted(zip(begin.tolist(), (end - begin).tolist(), period.tolist(), strict=True))
    want = sorted((s + f, n, q) for t, f in zip(texts, first, strict=False)
                  for s, n, q in plain_runs(t, least))
    assert got == want


def test_fibonacci_and_one_letter_texts():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    for text in (b, "a" * 500, "ab" * 300 + "c" + "ab" * 200, "abcab" * 90):
        codes = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
        begin, end, period = runs_of(codes, np.array([0, len(codes)]), 2)
        assert list(zip(begin, end - begin, period, strict=True)) == plain_runs(text, 2)


def test_words_are_told_apart_by_their_bytes():
    texts = ["A a \x00 \x00\x00 größe\x0bGRÖSSE", "a", "", " \t"]
    _, _, chunk = next(split_texts(pa.array(texts)))
    codes, first, names = numbered_words(chunk)
    assert first.tolist() == [0, 6, 7, 7, 7]
    assert [names[c].as_py().decode() for c in codes] == ["A", "a", "\x00", "\x00\x00", "größe",
                                                         "GRÖSSE", "a"]


def test_rewrite_follows_the_rule():
    codes, first = np.arange(50), np.array([0, 20, 20, 50])
    h = [10 * 13, 50, 7]  # the last text stays as it is
    out = planted_repeats(codes, first, [pa.array(h, pa.int64())])
    a, p = 13, 1 + 7 // (3 + 13 % 8)
    assert out[:20].tolist() == [i if i < a else a + (i - a) % p for i in range(20)]
    assert out[20:].tolist() == list(range(20, 50))


@pytest.mark.parametrize("fixture", ["messy", "no_docs"])
def test_operator_keeps_every_row(fixture, request):
    docs = request.getfixturevalue(fixture)
    out = word_runs(docs, "text", {"doc_id": F.col("doc_id")}).collect()
    assert len(out) == docs.count()
    by_id = {r.doc_id: r for r in out}
    if out:
        assert by_id[6].runs == [(0, 24000, 6)]
        assert by_id[6].collapsed == LONG[:LONG.index(" lorem")]
        assert (by_id[3].n_words, by_id[3].runs, by_id[3].collapsed) == (0, [], "")


def test_query_equals_plain_search(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(r[0], r[1]) for r in MESSY if r[1] is not LONG]
    for i in range(100, 400):  # about 30 of them go on periodically
        words = rng.integers(0, rng.choice([2, 5, 500]), rng.integers(0, 260))
        rows.append((i, " ".join(f"w{w}" for w in words)))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    out = op11_word_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 30
