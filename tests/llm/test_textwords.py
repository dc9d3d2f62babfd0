import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millstream.llm.textwords import TOKEN, WORD, grams, split_texts, words_of

from corpus_samples import MESSY, ascii_lower, messy, no_docs  # noqa: F401


def _texts():
    rng = random.Random(1)
    made = ["".join(rng.choice("aB é0 ,\x00\t\n|") for _ in range(rng.randint(0, 30)))
            for _ in range(400)]
    return [r[1] for r in MESSY] + made


@pytest.mark.parametrize("table, pattern", [
    (WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (TOKEN, r"[^\x20\x09-\x0D]+")])
def test_words_and_hashes(table, pattern):
    texts, seen = _texts(), {}
    for start, _, chunk in split_texts(pa.array(texts), 300):
        words = words_of(chunk, table)
        for r in range(len(chunk)):
            want = re.findall(pattern, ascii_lower(texts[start + r]))
            own = slice(words.first[r], words.first[r + 1])
            got = [ascii_lower(chunk.data[a:b].tobytes().decode())
                   for a, b in zip(words.starts[own], words.ends[own])]
            assert got == want
            for word, h in zip(want, words.hashes[own]):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_stay_in_their_row():
    hashes = np.arange(1, 8, dtype=np.uint64)
    got, rows = grams(hashes, np.array([0, 3, 3, 4, 7]), (0, 2))
    assert rows.tolist() == [0, 3] and len(set(got.tolist())) == 2


def test_long_texts_are_chunks_of_their_own():
    parts = list(split_texts(pa.array(["a" * 50, "b" * 500, "", "c"]), 100))
    assert [(a, b) for a, b, _ in parts] == [(0, 1), (1, 2), (2, 4)]
    assert len(parts[1][2].data) == 500
