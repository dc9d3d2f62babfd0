"""Token ids of whole texts, one tokenizer call per distinct piece.

A text is cut before a single space that a plain character follows. Byte-level BPE
with the usual pre-tokenizer always starts a new piece there, so encoding the cuts one by
one gives the ids of the whole text. Distinct cuts of a chunk are encoded once and
kept in a bounded cache.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np

from .textwords import Texts, run_hashes

#: Bytes that may follow the space of a cut: printable ASCII and the first bytes of
#: U+00C0 to U+07FF, none of which is white space.
_PLAIN = np.zeros(256, bool)
RUN_BYTES = 4096
_PLAIN[0x21:0x7F] = _PLAIN[0xC3:0xE0] = True


def shared_encoder(tokenizer_file: str, end_id: int | None) -> PieceEncoder:
    """One encoder per worker process, so that its cache outlives a task. Functions
    travel to workers by value, so the process keeps it in a module of its own."""
    kept = sys.modules.setdefault("_millstream_kept", types.ModuleType("_millstream_kept"))
    encoders = kept.__dict__.setdefault("encoders", {})
    key = (tokenizer_file, end_id)
    if key not in encoders:
        encoders[key] = PieceEncoder(tokenizer_file, end_id)
    return encoders[key]


class PieceEncoder:
    """Ids of the texts of a chunk. The cache never holds more than ``cache_ids`` ids
    beyond those of one chunk."""

    def __init__(self, tokenizer_file: str, end_id: int | None, cache_ids: int = 8_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their names in a text are plain text
        self.end_id = end_id
        self.cache_ids = cache_ids
        # byte-level tokens are written with one character per byte
        words = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(words.values()) + 1, np.int64)
        self.widths[list(words.values())] = [len(w) for w in words]
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.place = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids_of(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and how many each has. Pieces that begin with the space of a
        cut are encoded as one run of text, which falls into the same pieces again; the
        bytes that each id stands for tell where they end."""
        ends = np.cumsum(sizes)
        joined = data[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]
        after = np.minimum(starts + 1, len(data) - 1)
        joins = (sizes > 1) & (data[starts] == 32) & _PLAIN[data[after]]
        part = (ends - sizes) // RUN_BYTES
        breaks = np.flatnonzero(~joins | (np.diff(part, prepend=-1) != 0))
        cuts = np.append((ends - sizes)[breaks], ends[-1]).tolist()
        whole = joined.tobytes()
        found = self.tokenizer.encode_batch_fast(
            [whole[i:j].decode("utf-8") for i, j in zip(cuts, cuts[1:])],
            add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        stops = np.searchsorted(np.cumsum(self.widths[ids]), ends, "right")
        return ids, np.diff(stops, prepend=0)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray,
               sizes: np.ndarray) -> None:
        """Take in new pieces; ``hashes`` are sorted."""
        ids, lengths = self._ids_of(data, starts, sizes)
        places = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, ids])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.place = np.insert(self.place, at, places)
        self.length = np.insert(self.length, at, lengths)

    def _missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return self.known[at] != hashes

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk, and how many belong to each row (end id included)."""
        data, offsets = texts
        cut = np.zeros(len(data), bool)
        cut[:-1] = (data[:-1] == 32) & _PLAIN[data[1:]]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        cut[inner - 1] = False  # the next byte is another text's
        cut[inner] = True
        if len(data):
            cut[0] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes = run_hashes(data.astype(np.uint16) + 1, starts, ends)
        unique, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        miss = self._missing(unique)
        if miss.any():
            if len(self.ids) > self.cache_ids:
                self._clear()
                miss[:] = True
            taken = sample[miss]
            self._learn(unique[miss], data, starts[taken], ends[taken] - starts[taken])
        at = np.searchsorted(self.known, unique)[which] if len(unique) else which
        place, length = self.place[at], self.length[at]
        ids = self.ids
        first = np.searchsorted(starts, offsets)
        if self.end_id is not None:
            ids = np.append(ids, np.uint32(self.end_id))
            place = np.insert(place, first[1:], len(ids) - 1)
            length = np.insert(length, first[1:], 1)
            first = first + np.arange(len(first))
        total = np.concatenate(([0], np.cumsum(length)))
        index = np.arange(total[-1]) + np.repeat(place - total[:-1], length)
        return ids[index], np.diff(total[first])
