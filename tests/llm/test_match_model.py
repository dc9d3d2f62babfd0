import collections
import math
import re
import zlib

import pytest

from millstream.llm.match_model import END, ORDER, PAD, score_texts
from millstream.llm.textwords import remainder

from corpus_samples import MESSY, ascii_lower, messy, no_docs  # noqa: F401


def brute_force(rows):
    """The scores by a trie of dictionaries, symbol after symbol."""
    rows = [(i, ascii_lower(t)) for i, t in rows]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t) + ["<end>"] for _, t in rows]
    symbols = [[PAD] * ORDER + [*t.encode(), END] for _, t in rows]
    counts = collections.Counter(w for h, ws in zip(held, tokens) if not h for w in ws)
    trie = collections.defaultdict(collections.Counter)
    for h, s in zip(held, symbols):
        for j in range(ORDER, len(s) if not h else 0):
            for k in range(ORDER + 1):
                trie[tuple(s[j - k:j])][s[j]] += 1

    def length(s, j):
        ruled_out, p = set(), 1.0
        for k in range(ORDER, -1, -1):
            seen = {x: n for x, n in trie[tuple(s[j - k:j])].items() if x not in ruled_out}
            n = sum(seen.values())
            if s[j] in seen:
                return math.log10(p * seen[s[j]] / (n + len(seen)))
            if n:
                p *= len(seen) / (n + len(seen))
                ruled_out |= set(seen)
        return math.log10(p / (256 - len(ruled_out)))

    total, kinds = sum(counts.values()), len(counts)
    for (i, _), h, ws, s in zip(rows, held, tokens, symbols):
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws)
        yield (i, h, len(ws), sum(counts[w] > 0 for w in ws), total, base,
               sum(length(s, j) for j in range(ORDER, len(s))))


def _compare(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("chunk_bytes", [500, 1 << 20])
def test_messy_documents(messy, chunk_bytes):
    got = score_texts(messy, remainder("doc_id", 7) == 2, chunk_bytes=chunk_bytes).collect()
    _compare(got, brute_force([r[:2] for r in MESSY]))


def test_no_documents_and_no_training(messy, no_docs):
    from pyspark.sql import functions as F

    assert score_texts(no_docs, F.lit(False)).count() == 0
    rows = score_texts(messy, F.lit(True)).collect()
    assert {r.n_known for r in rows} == {0} and {r.train_tokens for r in rows} == {0}
    empty = next(r for r in rows if r.doc_id == 4)
    assert empty.score == pytest.approx(-math.log10(256), rel=1e-6)


def test_query(spark):
    from millstream.llm.match_model import op8_partial_matching

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    _compare(op8_partial_matching(spark, "/root/testdata/sf0.001").collect(),
             brute_force([(r.doc_id, r.text) for r in rows]))


def test_slices_and_batches_of_entries_change_nothing(monkeypatch):
    import numpy as np

    from millstream.llm import match_model as m
    from millstream.llm.textwords import Texts

    raw = [b"", b"abracadabra " * 9, b"x", b"Abra" * 30]
    texts = Texts(np.frombuffer(b"".join(raw), np.uint8),
                  np.cumsum([0] + [len(r) for r in raw]))
    whole = [np.concatenate(a) for a in zip(*m.trie_keys(texts))]
    assert len(whole[0]) == sum(len(r) + 1 for r in raw)
    monkeypatch.setattr(m, "SLICE", 7)
    monkeypatch.setattr(m, "MERGED", 3)
    parts = []
    for keys, rows in m.trie_keys(texts):
        m._tally(parts, keys, rows == 1)
    assert len(parts) < 20
    keys, counts = m._merged(parts)
    assert np.array_equal(keys, np.unique(whole[0]))
    assert counts.sum() == len(raw[1]) + 1
    sliced = [np.concatenate(a) for a in zip(*m.trie_keys(texts))]
    assert all(np.array_equal(a, b) for a, b in zip(whole, sliced))


def test_chances_of_all_symbols_add_up_to_one():
    import numpy as np

    from millstream.llm import match_model as m

    rng = np.random.default_rng(5)
    text = [m.PAD] * m.ORDER + list(rng.integers(97, 101, 400)) + [m.END]
    seen = collections.Counter(
        tuple(text[j - 1:j - m.ORDER - 1:-1]) + (text[j],) for j in range(m.ORDER, len(text)))
    pack = lambda t: int(np.sum([int(b) << 8 * i for i, b in enumerate(reversed(t))]))
    short = collections.Counter()
    for t, n in seen.items():
        short[pack(t[:2] + t[-1:])] += n
    codes = np.array(sorted(short))
    shallow = m.Shallow(codes, np.array([short[c] for c in codes.tolist()]))
    for context in [(97, 98, 99, 97, 97), (100, 100, 1, 2, 3), (5, 6, 7, 8, 9)]:
        counts = collections.Counter({pack(t): n for t, n in seen.items()})
        asked = {pack((*context, s)) for s in range(256)}
        keys = np.array(sorted(asked | {k for k in counts if k >> 24 == pack(context) >> 16}))
        got = 10 ** m.code_lengths(keys, np.array([counts[k] for k in keys.tolist()]), shallow)
        assert got[np.isin(keys, list(asked))].sum() == pytest.approx(1)
