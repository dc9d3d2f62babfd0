"""Near duplicates by ProbMinHash signatures, banding and exact verification.

A text is the set of its five-word shingles, each weighted by ``1 + ln(count)``. Every
weighted shingle is a Poisson process of arrivals whose rate is its weight; each arrival picks one
of ``M`` components, and a component keeps the shingle that arrived there first. Two texts
agree in a component with the probability Jaccard similarity of their weighted shingles.
Arrivals come from hashes of the shingle alone. Generation stops early: a horizon is set at
which nearly all components have an arrival, later ones can change nothing, and texts with
an empty component go on with a doubled horizon.

Bands of components name buckets. Links are decided on plain sets, and a shingle repeated in
one text only lowers the weighted similarity below the plain one. So a text with repeated
shingles has the bands of its plain set (all weights 1) as well; without repeats both are the
same. Any two texts then meet as their plain similarity says, whatever they repeat.

Equal texts (same words in the same order) are one node, known by a 64-bit hash of its first
text, so copies cost one row each and ids need not be unique. First every bucket has one leader,
the member that meets the most texts over all its buckets: of a group of near copies that is the
text they were made from, if it is there, and all buckets of the group share it. The other members
are compared with it and verified links are contracted. This pass is linear in the members, and
leaves a group of many near copies in a few components. Buckets whose members are one component
are done. In the others members of different components still have to be compared: members
lead, and all members of other components that have not led yet are compared with them,
until everyone outside the bucket's largest component has led. In a bucket of at most ``LARGE``
texts all lead at once; in others more in each round. So no link between
components within a bucket is missed.

Texts that only share a frequent passage can also meet, in buckets that grow with the data.
Members of buckets of more than ``LARGE`` texts that are still split are dealt anew by the
prefix rule: with
the shingles of each text ordered from rare to frequent, two texts of the wanted similarity
must share one among the first ``size - ceil(threshold * size) + 1`` of both. That loses no
link, and shingles of a frequent passage hardly ever come so early. Where two texts meet
at such a shingle, what follows it in the shorter rest bounds their overlap; pairs that
cannot reach the threshold that way are not formed (at the first shingle that they share
the bound holds in full, so a link is never lost).

A link is verified on whole shingle sets: Jaccard similarity of at least ``threshold``.

Defined cases: texts of fewer than five words have no shingles and are near only to equal
texts, byte for byte after folding A-Z; a null text is empty, and empty texts are equal to
each other; rows with a null id are compared with nothing and have no class; rows that share
an id are compared by their own texts; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import query
from ..session import cut_lineage
from .components import contract
from .textwords import (
    Texts, Words, fresh_name, grams, map_texts, mix, read_table, row_keys, run_hashes, words_of,
)

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
LARGE = 32
_MASK = np.uint64((1 << 52) - 1)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: rows, 52-bit hashes (sorted in a row), counts."""
    hashes, rows = grams(words.hashes, words.first, tuple(range(size)))
    keys, counts = np.unique(row_keys(rows, hashes), return_counts=True)
    return (keys >> np.uint64(52)).astype(np.int64), keys & _MASK, counts


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53


def prob_minhash(rows: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int,
                 m: int) -> np.ndarray:
    """Signatures of ``n`` rows: for each component the element that arrives first, as
    ``n`` times ``m`` hashes; 0 in rows without elements."""
    out = np.zeros((n, m), np.uint64)
    mass = np.bincount(rows, weights=weights, minlength=n)
    open_rows = mass > 0
    horizon = np.where(open_rows, m * (np.log(m) + 3) / np.maximum(mass, 1e-300), 0)
    while open_rows.any():
        use = open_rows[rows]
        row, element, weight = rows[use], elements[use], weights[use]
        limit = horizon[row] * weight  # in units of the element's own clock
        clock = np.zeros(len(row))
        cells, times, names, step = [], [], [], 0
        while len(row):
            bits = mix(element * np.uint64(0x9E3779B97F4A7C15)
                       + np.uint64((step * 2 + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
            clock = clock - np.log(_uniform(bits))
            alive = clock < limit
            row, element, weight, limit, clock = (
                x[alive] for x in (row, element, weight, limit, clock))
            place = (mix(bits[alive] + np.uint64(0x632BE59BD9B4E019)) % np.uint64(m)).astype(
                np.int64)
            cells.append(row * m + place)
            times.append(clock / weight)
            names.append(element)
            step += 1
        cell, time, name = map(np.concatenate, (cells, times, names))
        order = np.lexsort((name, time, cell))
        cell, name = cell[order], name[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        full = np.bincount(cell[first] // m, minlength=n) == m
        got = first & full[cell // m]
        out.reshape(-1)[cell[got]] = mix(name[got] + np.uint64(1))
        open_rows &= ~full
        horizon = horizon * 2
    return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(rows):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return h


def row_digests(texts: Texts, words: Words) -> list[np.ndarray]:
    """Two 64-bit hashes of each row's sequence of words; of the folded bytes if there
    are fewer words than a shingle has."""
    fold = np.arange(256, dtype=np.uint16) + 1
    fold[65:91] += 32
    short = np.diff(words.first) < SHINGLE
    out = []
    for salt in (0, 0x5851F42D4C957F2D):
        h = run_hashes(mix(words.hashes + np.uint64(salt)), words.first[:-1], words.first[1:])
        raw = run_hashes(fold[texts.data], texts.offsets[:-1], texts.offsets[1:])
        out.append(np.where(short, mix(raw + np.uint64(salt + 1)), h).view(np.int64))
    return out


def text_bands(words: Words, n: int, bands: int, rows: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bands of the weighted and of the plain shingles of ``n`` rows, each once; where each
    row's begin; how many shingles it has."""
    row, element, counts = shingles(words)
    weighted = band_hashes(prob_minhash(row, element, 1 + np.log(counts), n, bands * rows),
                           bands, rows)
    size = np.bincount(row, minlength=n)
    repeats = np.bincount(row, weights=counts > 1, minlength=n) > 0
    plain = weighted.copy()
    if repeats.any():
        own = np.cumsum(repeats) - 1
        use = repeats[row]
        plain[repeats] = band_hashes(
            prob_minhash(own[row[use]], element[use], np.ones(np.count_nonzero(use)),
                         np.count_nonzero(repeats), bands * rows), bands, rows)
    every = np.hstack([weighted, plain])
    taken = np.hstack([np.broadcast_to((size > 0)[:, None], weighted.shape), plain != weighted])
    return every[taken], np.concatenate(([0], np.cumsum(taken.sum(axis=1)))), size


def signatures(docs: DataFrame, id_col: str, text: str, bands: int, rows: int) -> DataFrame:
    """id, a hash of the text, two digests of the words, the number of shingles and the hashes
    of the bands, for each row."""

    def make():
        def work(kept, texts):
            words = words_of(texts)
            h, first, size = text_bands(words, len(texts), bands, rows)
            return [*row_digests(texts, words), size.astype(np.int32),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)),
                                             pa.array(h.view(np.int64)))]
        return work

    return map_texts(docs, text, {"id": F.col(id_col), "key": content_key(text)},
                     "d1 long, d2 long, size int, bands array<long>", make)


def content_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def shingle_sets(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id and the sorted shingle hashes as 64-bit numbers."""

    def make():
        def work(kept, texts):
            row, element, _ = shingles(words_of(texts))
            size = 8 * np.searchsorted(row, np.arange(len(texts) + 1))
            return [pa.Array.from_buffers(pa.binary(), len(texts), [
                None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(element)])]
        return work

    return map_texts(docs, text, {"id": F.col(id_col)}, "shingles binary", make)


def prefix_buckets(sets: DataFrame, threshold: float) -> DataFrame:
    """``(bucket, id, place, size)`` for the rarest shingles of each text, as many as any text of the
    wanted similarity must share one of; shingles of one text alone are left out."""

    def spread(batches):
        for batch in batches:
            sizes = [len(b.as_buffer()) // 8 for b in batch.column(1)]
            if not sum(sizes):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            values = np.concatenate([np.frombuffer(b.as_buffer(), np.int64)
                                     for b in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(values), pa.array(np.repeat(sizes, sizes).astype(np.int32))],
                ["id", "bucket", "size"])

    kind = sets.schema["id"].dataType.simpleString()
    rows = cut_lineage(sets.select("id", "shingles").mapInArrow(
        spread, f"id {kind}, bucket long, size int"))
    common = rows.groupBy("bucket").agg(F.count("id").alias("texts")).where("texts > 1")
    # shingles of one text come first in its order; how many there are is all that counts
    shared = rows.join(common, "bucket")
    order = Window.partitionBy("id").orderBy("texts", "bucket")  # the shingles of one text
    place = F.row_number().over(order)
    own = F.col("size") - F.count("bucket").over(Window.partitionBy("id"))
    length = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    early = shared.withColumn("place", place + own).where(F.col("place") <= length)
    early = cut_lineage(early.select(
        F.xxhash64(F.lit("prefix"), "bucket").alias("bucket"), "id", "place", "size"))
    again = early.groupBy("bucket").agg(F.count("id").alias("n")).where("n > 1").select("bucket")
    return early.join(again, "bucket")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(u, v)`` whose sets have a Jaccard similarity of ``threshold``."""
    both = (pairs.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
            .join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v"))

    def check(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a = np.frombuffer(a.as_buffer(), np.uint64)
                b = np.frombuffer(b.as_buffer(), np.uint64)
                if len(a) < len(b):
                    a, b = b, a
                common = 0
                if len(b) >= threshold * len(a) and len(a):
                    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                    common = np.count_nonzero(a[at] == b)
                keep.append(common > 0 and common >= threshold * (len(a) + len(b) - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["u"].dataType.simpleString()
    return both.select("u", "v", "a", "b").mapInArrow(check, f"u {kind}, v {kind}")


def _with_components(members: DataFrame, stars: DataFrame) -> DataFrame:
    return members.join(stars.select(F.col("u").alias("id"), "v"), "id", "left").withColumn(
        "comp", F.coalesce("v", "id")).drop("v")


def _first_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Each member of a bucket with the bucket's leader, if their sizes allow a link."""
    mates = members.groupBy("id").agg(F.sum("texts").alias("mates"))
    leaders = members.join(mates, "id").groupBy("bucket").agg(
        F.max(F.struct("mates", "id", "size")).alias("lead"))
    both = members.join(leaders, "bucket").where(
        (F.col("id") != F.col("lead.id"))
        & (F.least("size", "lead.size") >= threshold * F.greatest("size", "lead.size") - 1e-9))
    return both.select(F.least("lead.id", "id").alias("u"),
                       F.greatest("lead.id", "id").alias("v")).distinct()


def _next_pairs(members: DataFrame, stars: DataFrame, led: DataFrame | None, number: int,
                threshold: float) -> tuple[DataFrame, DataFrame]:
    """Leaders ``(bucket, id)`` of a round, and the pairs of them with the members of
    their buckets that belong to other components, have not led and can be near enough."""
    now = _with_components(members, stars)
    if led is not None:
        now = now.join(led.withColumn("led", F.lit(True)), ["bucket", "id"], "left")
    else:
        now = now.withColumn("led", F.lit(None).cast("boolean"))
    now = cut_lineage(now)
    parts = now.groupBy("bucket", "comp").agg(F.count("id").alias("n"))
    split = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "comp")).alias("big"), F.count("comp").alias("k")).where("k > 1")
    able = now.where("led is null").join(
        split.select("bucket", F.col("big.comp").alias("big"), "k"), "bucket").where("comp != big")
    share = F.when(F.col("few"), 1.0).otherwise(2.0 * 32 ** (number - 1) / F.col("k"))
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    able = able.select("bucket", F.struct("id", "place", "size", "comp").alias("lead"),
                       chance.alias("chance"), share.alias("share"))
    least = able.groupBy("bucket").agg(F.min("chance").alias("least"))  # at least one leads
    leaders = cut_lineage(able.join(least, "bucket").where(
        (F.col("chance") < F.col("share")) | (F.col("chance") == F.col("least"))
    ).select("bucket", "lead"))
    rest = F.least(F.col("lead.size") - F.col("lead.place"), F.col("size") - F.col("place")) + 1
    needed = (F.col("lead.size") + F.col("size")) * (threshold / (1 + threshold)) - 1e-6
    others = now.where("led is null").withColumnRenamed("bucket", "b")
    pairs = leaders.join(others, (F.col("bucket") == F.col("b"))
                         & (F.col("comp") != F.col("lead.comp")) & (rest >= needed))
    pairs = pairs.select(F.least("lead.id", "id").alias("u"),
                         F.greatest("lead.id", "id").alias("v")).distinct()
    return leaders.select("bucket", F.col("lead.id").alias("id")), pairs


def _components(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``(u, v)``: every node of a component of near texts, but for the smallest, with that one.
    ``members`` are ``(bucket, id, size, texts)``."""
    stars = contract(verified(cut_lineage(_first_pairs(members, threshold)), sets, threshold))
    left = _with_components(members, stars)
    split = left.groupBy("bucket").agg(F.countDistinct("comp").alias("k")).where("k > 1")
    left = cut_lineage(members.join(split.select("bucket"), "bucket"))
    large = left.where(F.col("texts") > LARGE).select("id").distinct()
    # buckets of the same few texts are one bucket
    few = left.where(F.col("texts") <= LARGE).groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("id", "size"))).alias("all"))
    few = few.select("all").distinct().select(
        F.xxhash64("all").alias("bucket"), F.inline("all"), F.lit(1).alias("place"),
        F.lit(True).alias("few"))
    if not large.isEmpty():
        early = prefix_buckets(sets.join(large, "id", "left_semi"), threshold)
        few = few.unionByName(early.withColumn("few", F.lit(False)))
    members, led, number = cut_lineage(few), None, 1
    while True:
        leaders, pairs = _next_pairs(members, stars, led, number, threshold)
        if leaders.isEmpty():
            return stars
        pairs = cut_lineage(pairs)
        if not pairs.isEmpty():
            stars = contract(verified(pairs, sets, threshold).unionByName(stars))
        led = cut_lineage(leaders if led is None else leaders.unionByName(led))
        number += 1


def _rows_of(docs: DataFrame, firsts: DataFrame, id_col: str, text: str, key: str) -> DataFrame:
    """The rows of ``docs`` that ``firsts`` names by id and key, with the column ``key``; other
    copies of a text are left out before anything is grouped."""
    own_id, own_key = fresh_name("_id", docs.columns), fresh_name("_first", docs.columns)
    wanted = firsts.select(F.col("first.id").alias(own_id), F.col("first.key").alias(own_key))
    return docs.withColumn(key, content_key(text)).join(
        wanted, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)),
        "left_semi")


def content_classes(docs: DataFrame, id_col: str, text: str, threshold: float, bands: int,
                    rows: int) -> tuple[DataFrame, DataFrame]:
    """``(id, key, d1, d2)`` of each row, and for each ``(d1, d2)`` its smallest id
    ``exact_id`` and the ``first`` row of its class: smallest id (null last) and key."""
    base = cut_lineage(signatures(docs, id_col, text, bands, rows))
    nodes = base.groupBy("d1", "d2").agg(F.min(F.struct(
        F.isnull("id").alias("lost"), "id", "key", "size", "bands")).alias("r"))
    nodes = cut_lineage(nodes.select(
        "d1", "d2", F.col("r.key").alias("node"), F.struct("r.lost", "r.id", "r.key")
        .alias("first"), "r.size", "r.bands"))
    rows_of = nodes.select(
        F.explode("bands").alias("bucket"), F.col("node").alias("id"), "size")
    crowded = rows_of.groupBy("bucket").agg(F.count("id").alias("texts")).where("texts > 1")
    members = cut_lineage(rows_of.join(crowded, "bucket"))
    chosen = members.select(F.col("id").alias("node")).distinct().join(nodes, "node").select("first")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    texts = _rows_of(plain, chosen, "id", "text", "_key").groupBy("_key").agg(
        F.min("text").alias("_text"))
    sets = cut_lineage(shingle_sets(texts, "_key", "_text"))
    stars = _components(members, sets, threshold)
    linked = stars.unionByName(stars.select(F.col("v").alias("u"), "v").distinct())
    known = linked.join(nodes.select(F.col("node").alias("u"), F.col("first").alias("own")), "u")
    heads = known.groupBy("v").agg(F.min("own").alias("head"))
    heads = linked.join(heads, "v").select(F.col("u").alias("node"), "head")
    return base, nodes.join(heads, "node", "left").select(
        "d1", "d2", F.col("first.id").alias("exact_id"),
        F.coalesce("head", "first").alias("first"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
                 ) -> DataFrame:
    """One row per row of ``docs``: id, ``exact_id`` (the smallest id with equal words),
    ``class_id`` (the smallest id of its class of near duplicates) and ``kept`` (the row that
    stands for its class, and those equal to it)."""
    base, classes = content_classes(
        docs.where(F.col(id_col).isNotNull()), id_col, text, threshold, bands, rows)
    found = base.select("id", "key", "d1", "d2").join(classes, ["d1", "d2"]).select(
        F.col("id").alias(id_col), "exact_id", F.col("first.id").alias("class_id"),
        ((F.col("id") == F.col("first.id")) & (F.col("key") == F.col("first.key"))).alias("kept"))
    lost = docs.where(F.col(id_col).isNull()).select(
        id_col, *[F.col(id_col).alias(c) for c in ("exact_id", "class_id")],
        F.lit(None).cast("boolean").alias("kept"))
    return found.unionByName(lost)


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                      threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
                      ) -> DataFrame:
    """One whole row of ``docs`` for each class of near contents: the one with the smallest
    id. Rows without an id are compared too and come last in that order. Of rows with equal id
    and text one stays."""
    _, classes = content_classes(docs, id_col, text, threshold, bands, rows)
    key = fresh_name("_key", docs.columns)
    left = _rows_of(docs, classes.select("first").distinct(), id_col, text, key)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return left.groupBy(key).agg(F.first(row).alias("_row")).select("_row.*")


@query()
def op9_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents"))
