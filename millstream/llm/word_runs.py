"""Periodic runs of words, by an enhanced suffix array and branching tandem tests.

A run is a stretch of words whose smallest period ``q`` fits at least twice and that no
neighbouring word extends. Its last square (two equal halves of ``q`` words) begins where the
suffix ``i`` and the suffix ``i + q`` share exactly ``q`` words: both lie in one LCP interval
of depth ``q``, in different children. So every LCP interval is asked, for the suffixes of all
its children but the largest, whether ``i + depth`` or ``i - depth`` is a member (one look at
the inverse suffix array). What is found is rotated to the left as long as the period
holds, and squares that reach the same stretch are one run with the smallest period. A
suffix is in a smaller child at most log(n) times; intervals are pairs of bounds in arrays, there
are no tree nodes.

All texts of a chunk are worked on at once: words are numbers from a dictionary of their bytes,
the text's number comes first in the order of suffixes, and ranks by the first ``2**k`` words are
doubled only where suffixes still tie. The ranks of all ``k`` are kept: they give the common
prefixes of neighbours, and how far a square can be rotated. This takes about
``(8 + 4 log2(longest repeat))`` bytes a word and some 200 more; a text is always whole.

Nothing moves between tasks. Defined cases: a null or blank text has no words, no runs and
an empty collapsed text; repeated rows each give a row; an empty table gives none; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from .textwords import Texts, map_texts, read_table, words_of

MIN_LENGTH = 12

#: Words are told apart byte by byte, without folding; 255 is never part of UTF-8.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[0] = 255
_BYTES[[9, 10, 11, 12, 13, 32]] = 0

#: Gets the numbers of all words, where each row's begin, and the kept columns of the rows.
Rewrite = Callable[[np.ndarray, np.ndarray, list[pa.Array]], np.ndarray]


class Ranks(NamedTuple):
    """``levels[k][i]``: place of the first suffix that shares its first ``2**k`` words with
    suffix ``i``; ``order``: the suffixes in order; ``start``, ``end``: of the text of ``i``."""

    levels: list[np.ndarray]
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray


def numbered_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """A number per word, where each row's begin, and the words by number."""
    words = words_of(texts, _BYTES)
    offsets = np.zeros(len(words.starts) + 1, np.int64)
    np.cumsum(words.ends - words.starts, out=offsets[1:])
    inside = np.ascontiguousarray(texts.data[_BYTES[texts.data] != 0])
    column = pa.Array.from_buffers(pa.large_binary(), len(words.starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(inside)])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.first, coded.dictionary


def _groups(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def suffix_ranks(codes: np.ndarray, first: np.ndarray) -> Ranks:
    n = len(codes)
    sizes = np.diff(first)
    start = np.repeat(first[:-1], sizes)
    end = np.repeat(first[1:], sizes)
    keys = np.repeat(np.arange(len(sizes)), sizes) * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(keys)
    new = _groups(keys[order])
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels, span = [rank], 1
    places = np.flatnonzero(~(new & np.append(new[1:], True)))  # of suffixes that still tie
    while len(places):
        tied = order[places]
        after = np.full(len(tied), -1, np.int64)
        inside = tied + span < end[tied]
        after[inside] = rank[tied[inside] + span]
        keys = rank[tied].astype(np.int64) * (n + 1) + after + 1
        by = np.argsort(keys)
        order[places] = tied = tied[by]
        new = _groups(keys[by])
        heads = np.flatnonzero(new)
        rank = rank.copy()
        rank[tied] = np.repeat(places[heads], np.diff(np.append(heads, len(tied))))
        levels.append(rank)
        places = places[~(new & np.append(new[1:], True))]
        span *= 2
    return Ranks(levels, order, start, end)


def _prefixes(ranks: Ranks) -> np.ndarray:
    """How many words each suffix shares with the one before it in order; 0 at both ends."""
    order, levels = ranks.order, ranks.levels
    out = np.zeros(len(order) + 1, np.int64)
    at = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[at - 1], order[at]
    end = ranks.end[a]
    shared = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        fits = np.flatnonzero((x < end) & (y < end))
        same = levels[k][x[fits]] == levels[k][y[fits]]
        shared[fits[same]] += 1 << k
    out[at] = shared
    return out


def _beyond(depth: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For the places ``at``, the next place in direction ``step`` that is not deeper."""
    out = np.arange(len(depth)) + step
    while len(at):
        to = out[at]
        deeper = depth[to] > depth[at]
        at = at[deeper]
        out[at] = out[to[deeper]]
    return out


def _last_equal(depth: np.ndarray, beyond: np.ndarray, at: np.ndarray) -> np.ndarray:
    """From the places ``at``, the last place of the same interval in a direction."""
    out = np.arange(len(depth))
    out[at] = np.where(depth[beyond[at]] == depth[at], beyond[at], at)
    while True:
        to = out[out[at]]
        if np.array_equal(to, out[at]):
            return out
        out[at] = to


def branching_squares(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Begin and half length of squares whose halves' suffixes part right after the square."""
    order, place = ranks.order, ranks.levels[-1]
    depth = _prefixes(ranks)
    at = np.flatnonzero(depth)
    if not len(at):
        return at, at
    right, left = _beyond(depth, at, 1), _beyond(depth, at, -1)
    low_end, high_end = _last_equal(depth, left, at), _last_equal(depth, right, at)
    interval = low_end[at]  # the first place with the depth names the interval
    lower, upper = left[interval], right[high_end[at]]
    # a child begins at each place, and one more before the first
    firsts = interval == at
    begin = np.concatenate([at, lower[firsts]])
    stop = np.concatenate([right[at], at[firsts]])
    owner = np.concatenate([interval, at[firsts]])
    lower, upper = (np.concatenate([x, x[firsts]]) for x in (lower, upper))
    by = np.lexsort((begin - stop, owner))
    small = by[~_groups(owner[by])]
    size = (stop - begin)[small]
    member = np.repeat(begin[small] - np.cumsum(size) + size, size) + np.arange(size.sum())
    begin, stop, lower, upper, length = (
        np.repeat(x[small], size) for x in (begin, stop, lower, upper, depth[owner]))
    suffix = order[member]
    starts, halves = [], []
    for to, bound_ok in ((suffix + length, suffix + length < ranks.end[suffix]),
                         (suffix - length, suffix - length >= ranks.start[suffix])):
        use = np.flatnonzero(bound_ok)
        there = place[to[use]]
        hit = ((there >= lower[use]) & (there < upper[use])
               & ~((there >= begin[use]) & (there < stop[use])))
        use = use[hit]
        starts.append(np.minimum(suffix[use], to[use]))
        halves.append(length[use])
    return np.concatenate(starts), np.concatenate(halves)


def runs_of(codes: np.ndarray, first: np.ndarray, min_length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and period of all runs, by begin, then period; places count over all rows."""
    ranks = suffix_ranks(codes, first)
    at, period = branching_squares(ranks)
    end = at + 2 * period
    begin = at.copy()
    for k in range(len(ranks.levels) - 1, -1, -1):
        to = begin - (1 << k)
        fits = np.flatnonzero(to >= ranks.start[at])
        level = ranks.levels[k]
        same = fits[level[to[fits]] == level[to[fits] + period[fits]]]
        begin[same] = to[same]
    long = end - begin >= np.maximum(min_length, 2 * period)
    begin, end, period = begin[long], end[long], period[long]
    by = np.lexsort((period, end, begin))
    begin, end, period = begin[by], end[by], period[by]
    smallest = _groups(begin) | _groups(end)
    begin, end, period = begin[smallest], end[smallest], period[smallest]
    by = np.lexsort((period, begin))
    return begin[by], end[by], period[by]


def word_runs(docs: DataFrame, text: str, keep: dict[str, Column],
              min_length: int = MIN_LENGTH, rewrite: Rewrite | None = None) -> DataFrame:
    """Columns ``keep`` and, per text, ``n_words``, its ``runs`` (start, length, period, by
    start and period) and the ``collapsed`` text, in which every run is left with its first
    period only and words are joined by a blank. ``rewrite`` may replace words first."""

    def make():
        def work(kept, texts):
            codes, first, names = numbered_words(texts)
            if rewrite:
                codes = rewrite(codes, first, kept)
            begin, end, period = runs_of(codes, first, min_length)
            change = np.zeros(len(codes) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, end, -1)
            stays = np.cumsum(change[:-1]) == 0
            left = np.concatenate(([0], np.cumsum(stays)))[first]
            lists = pa.ListArray.from_arrays(
                pa.array(left.astype(np.int32)),
                names.take(pa.array(codes[stays])).cast(pa.binary()).cast(pa.string()))
            of = np.searchsorted(begin, first).astype(np.int32)
            start = begin - first[np.searchsorted(first, begin, "right") - 1]
            runs = pa.StructArray.from_arrays(
                [pa.array(start), pa.array(end - begin), pa.array(period)],
                ["start", "length", "period"])
            return [np.diff(first), pa.ListArray.from_arrays(pa.array(of), runs),
                    pc.binary_join(lists, " ")]
        return work

    return map_texts(docs, text, keep, "n_words long, runs array<struct<start: long, "
                     "length: long, period: long>>, collapsed string", make)


def planted_repeats(codes: np.ndarray, first: np.ndarray, kept: list[pa.Array]) -> np.ndarray:
    """The query's rule for its test texts: the kept column ``h`` decides which texts go on
    periodically, from where and with which period."""
    h = kept[-1].to_numpy(zero_copy_only=False)
    n = np.diff(first)
    g = h // 10
    a = g % np.maximum(n, 1)
    p = 1 + (n - a) // (3 + g % 8)
    a = np.where(h % 10 == 0, a, n)  # from the end on: nothing changes
    a, p, base = (np.repeat(x, n) for x in (a, p, first[:-1]))
    at = np.arange(len(codes)) - base
    return codes[base + np.where(at >= a, a + (at - a) % p, at)]


@query()
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id counts as the empty text in the checksum that decides about repeats."""
    docs = read_table(spark, sf_dir, "documents")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = word_runs(docs, "text", {"doc_id": F.col("doc_id"), "h": h}, rewrite=planted_repeats)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("back"), (-r.period).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.short")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
