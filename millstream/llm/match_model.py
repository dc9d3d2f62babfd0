"""Language-model scores by prediction by partial matching over bytes.

A trie of byte contexts holds, for every context of up to five bytes, how often each byte
followed in the training texts. The code length of a byte is taken at its longest context;
where the byte was not seen there, an escape (method C: distinct symbols over occurrences
plus distinct symbols) leads to the next shorter context, in which the symbols already
ruled out count no more, and at last to a uniform choice of what remains. Texts begin in a
context of five padding bytes and end with an end symbol; both values never occur in UTF-8.

The trie is a table of its deepest entries, sorted by the context read backwards, so that the
entries of every shorter context lie together too. It grows with the corpus and is nowhere
whole: entries are dealt by the last three context bytes, and what is below a context of three
bytes (at most 256**3 entries however large the corpus) is broadcast. So each task knows all
counts that the escapes of its entries need, and gives every entry its code length.

Documents are dealt to chunks of a number of bytes. Each chunk asks for the distinct tokens
and the distinct entries of its texts; token counts and code lengths come back by a join, and
chunk and answers meet in a co-group. No task holds more than a chunk, or the entries of a
context of three bytes.

Defined cases: a null text is empty and has the end as its only token; a null id is never
held out; without training texts all counts are 0; repeated rows are scored each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from ..session import cut_lineage
from .textwords import TOKEN, Texts, read_table, remainder, split_texts, words_of

CHUNK_BYTES = 32 << 20
ORDER = 5
PAD, END = 0xFE, 0xFF
END_KEY = np.int64(0)  # the key of the end token; words have mixed 64-bit hashes
PIECE_DOCS = 256  # texts that are copied out of a batch together
SLICE = 1 << 19  # symbols looked at together, also within one long text
MERGED = 1 << 19  # counts of a chunk that wait until they are added up, or as many as it has
ENTRIES = 1 << 18  # entries whose lengths are computed together, in whole contexts
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def trie_keys(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the trie entries of all bytes and ends of all texts, with their rows, in
    slices. A key is the context from its last byte to its first, then the symbol."""
    n = len(texts)
    first = texts.offsets + (ORDER + 1) * np.arange(n + 1)
    padded = np.full(len(texts.data) + (ORDER + 1) * n, PAD, np.uint8)
    inside = np.ones(len(padded), bool)
    for k in range(ORDER):
        inside[first[:-1] + k] = False
    inside[first[1:] - 1] = False
    padded[inside] = _FOLD[texts.data]
    padded[first[1:] - 1] = END
    for low in range(0, len(padded), SLICE):
        high = min(low + SLICE, len(padded))
        low = max(low, ORDER)
        keys = padded[low:high].astype(np.int64)
        for k in range(1, ORDER + 1):
            keys |= padded[low - k:high - k].astype(np.int64) << (8 * (ORDER + 1 - k))
        own = padded[low:high] != PAD
        rows = np.repeat(np.arange(n), np.diff(np.clip(first, low, high)))
        yield keys[own], rows[own]


def _step(n, total, kinds, lower):
    """Chance of a symbol in a context: its own share, or an escape to ``lower``."""
    whole = np.maximum(total + kinds, 1)
    return np.where(n > 0, n / whole, np.where(total > 0, kinds / whole, 1.0) * lower)


class Shallow:
    """Contexts of up to two bytes, from the sorted entries of order two."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes = np.append(codes, np.iinfo(np.int64).max)
        self.counts = np.append(counts.astype(np.float64), 0.0)
        pair, short = codes >> 8, (codes >> 16 << 8) | (codes & 255)
        self.n1 = np.bincount(short, weights=counts, minlength=1 << 16)
        square = self.n1.reshape(256, 256)
        self.n0 = square.sum(axis=0)
        self.total2 = np.bincount(pair, weights=counts, minlength=1 << 16)
        self.kinds2 = np.bincount(pair, minlength=1 << 16)
        self.total1, self.kinds1 = square.sum(axis=1), np.count_nonzero(square, axis=1)
        # what a context rules out of the next shorter one
        self.ruled2 = np.bincount(pair, weights=self.n1[short], minlength=1 << 16)
        self.ruled1 = np.where(square > 0, self.n0, 0.0).sum(axis=1)

    def count(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, codes)
        return np.where(self.codes[at] == codes, self.counts[at], 0.0)

    def chance(self, codes: np.ndarray, n2, total, kinds) -> np.ndarray:
        """Chances of order two, given the total and kinds that are not ruled out."""
        last, pair, symbol = codes >> 16, codes >> 8, codes & 255
        seen = np.count_nonzero(self.n0)
        p = _step(self.n0[symbol], self.n0.sum() - self.ruled1[last],
                  seen - self.kinds1[last], 1 / max(256 - seen, 1))
        p = _step(self.n1[(last << 8) | symbol], self.total1[last] - self.ruled2[pair],
                  self.kinds1[last] - self.kinds2[pair], p)
        return _step(n2, total, kinds, p)


def code_lengths(keys: np.ndarray, n: np.ndarray, shallow: Shallow) -> np.ndarray:
    """log10 of the probabilities of entries, sorted and in whole contexts of three bytes,
    from their training counts (0: asked for, but not seen)."""
    levels = []  # from the longest context: keys, counts, group of each key, place one level up
    count, place = n.astype(np.float64), None
    for order in range(ORDER, 2, -1):
        if place is not None:
            count = np.bincount(place, weights=count, minlength=len(keys))
        _, group = np.unique(keys >> 8, return_inverse=True)
        total = np.bincount(group, weights=count)
        kinds = np.bincount(group, weights=count > 0)
        levels.append((count, group, total, kinds, place))
        if order > 3:
            keys, place = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
    codes = (keys >> 16 << 8) | (keys & 255)
    count, group, total, kinds, place = levels.pop()
    n2 = shallow.count(codes)
    ruled = np.bincount(group, weights=np.where(count > 0, n2, 0.0))
    p = shallow.chance(codes, n2, shallow.total2[codes >> 8] - ruled[group],
                       shallow.kinds2[codes >> 8] - kinds[group])
    while levels:
        longer, longer_group, longer_total, longer_kinds, longer_place = levels.pop()
        n_here, here = count[place], group[place]
        ruled = np.bincount(longer_group, weights=np.where(longer > 0, n_here, 0.0))
        p = _step(n_here, total[here] - ruled[longer_group],
                  kinds[here] - longer_kinds[longer_group], p[place])
        count, group, total, kinds, place = (
            longer, longer_group, longer_total, longer_kinds, longer_place)
    return np.log10(_step(count, total[group], kinds[group], p))


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    for at in range(0, len(column), PIECE_DOCS):
        for start, stop, texts in split_texts(column.slice(at, PIECE_DOCS)):
            yield at + start, at + stop, texts


def token_keys(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, and where each row begins; the end token is left out."""
    words = words_of(texts, TOKEN)
    keys = words.hashes.view(np.int64).copy()
    keys[keys == END_KEY] = 1
    return keys, words.first


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.concatenate([n for _, n in parts])
    return unique, np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)


def _tally(parts: list, keys: np.ndarray, learns: np.ndarray) -> None:
    """Add the distinct keys with how often they are learnt from."""
    parts.append(np.unique(keys[learns], return_counts=True))
    asked = np.unique(keys[~learns])
    parts.append((asked, np.zeros(len(asked), np.int64)))
    if sum(len(k) for k, _ in parts[1:]) > max(MERGED, len(parts[0][0])):
        parts[:] = [_merged(parts)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, entry, key, n) of the distinct tokens and trie entries of each chunk with
    their training counts. Batches come sorted by chunk."""

    def flush(chunk, found):
        for entry, parts in enumerate(found):
            keys, counts = _merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), chunk, np.int32)),
                 pa.array(np.full(len(keys), bool(entry))), pa.array(keys), pa.array(counts)],
                ["chunk", "entry", "key", "n"])

    current, found = None, ([], [])
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        learns = batch.column(1).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(chunks):  # the run of rows of one chunk
            end = at + int(np.searchsorted(chunks[at:], chunks[at], "right"))
            if current is not None and chunks[at] != current:
                yield from flush(current, found)
                found = ([], [])
            current = chunks[at]
            for start, stop, texts in _pieces(batch.column(2).slice(at, end - at)):
                learn = learns[at + start:at + stop]
                keys, first = token_keys(texts)
                _tally(found[0], keys, np.repeat(learn, np.diff(first)))
                found[0].append((np.array([END_KEY]), np.array([learn.sum()])))
                for keys, rows in trie_keys(texts):
                    _tally(found[1], keys, learn[rows])
            at = end
    if current is not None:
        yield from flush(current, found)


def _lengths(model):
    """Rows (entry, key, value) of trie entries with their code lengths. Batches (key, n) come
    sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shallow = Shallow(*model.value)

        def rows(keys, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(keys), bool)), pa.array(keys),
                 pa.array(code_lengths(keys, n, shallow))], ["entry", "key", "value"])

        keys, counts, held = [], [], 0
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            counts.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= ENTRIES:
                k, n = np.concatenate(keys), np.concatenate(counts)
                whole = int(np.searchsorted(k, k[-1] >> 24 << 24))  # the last context may go on
                if whole:
                    yield rows(k[:whole], n[:whole])
                keys, counts, held = [k[whole:]], [n[whole:]], 0
        if keys and sum(map(len, keys)):
            yield rows(np.concatenate(keys), np.concatenate(counts))

    return run


def _scored(docs: pa.Table, answers: pa.Table, total: int, kinds: int) -> pa.Table:
    entry = answers.column("entry").to_numpy()
    known, values = answers.column("key").to_numpy(), answers.column("value").to_numpy()

    def table(of):
        order = np.argsort(known[of])
        return known[of][order], values[of][order]

    words, counts = table(~entry)
    words, counts = np.append(words, np.iinfo(np.int64).max), np.append(counts, 0.0)
    entries, lengths = table(entry)
    out: list[list[np.ndarray]] = [[], [], [], []]
    floor = np.log10(total + kinds + 1)
    for column in docs.column("text").chunks:
        for start, stop, texts in _pieces(column):
            n = stop - start
            keys, first = token_keys(texts)
            keys = np.insert(keys, first[1:], END_KEY)
            sizes = np.diff(first) + 1
            rows = np.repeat(np.arange(n), sizes)
            at = np.searchsorted(words, keys)
            c = np.where(words[at] == keys, counts[at], 0.0)
            score = np.zeros(n)
            for keys, of in trie_keys(texts):
                score += np.bincount(of, lengths[np.searchsorted(entries, keys)], n)
            out[0].append(sizes)
            out[1].append(np.bincount(rows, weights=c > 0, minlength=n).astype(np.int64))
            out[2].append(np.bincount(rows, weights=np.log10(c + 1.0), minlength=n)
                          - sizes * floor)
            out[3].append(score)
    made = [pa.array(np.concatenate(o)) for o in out]
    return pa.Table.from_arrays(
        [docs.column("id"), docs.column("held_out"), made[0], made[1],
         pa.array(np.full(docs.num_rows, total, np.int64)), made[2], made[3]],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Learn from the rows that ``held_out`` spares and score all rows: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score and score."""
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(64)).alias("n")).first().n or 0
    n_chunks = max(1, -(-size // chunk_bytes))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(n_chunks)).cast("int"))

    dealt = rows.select("chunk", (~F.col("held_out")).alias("learn"), "text")
    asked = cut_lineage(
        dealt.repartition("chunk").sortWithinPartitions("chunk")
        .mapInArrow(_count, "chunk int, entry boolean, key long, n long"))
    counts = cut_lineage(asked.groupBy("entry", "key").agg(F.sum("n").alias("n")))
    words = counts.where(~F.col("entry") & (F.col("n") > 0))
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    entries = counts.where("entry")
    short = F.shiftleft(F.shiftright("key", 32), 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
    model = (entries.where("n > 0").groupBy(short.alias("key")).agg(F.sum("n").alias("n"))
             .sort("key").toArrow())  # at most 256**3 rows
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.column("key").to_numpy(), model.column("n").to_numpy()))
    values = (
        entries.select("key", "n").repartition(F.shiftright("key", 24))
        .sortWithinPartitions("key")
        .mapInArrow(_lengths(shared), "entry boolean, key long, value double")
        .unionAll(words.select("entry", "key", F.col("n").cast("double").alias("value"))))
    answers = asked.select("chunk", "entry", "key").join(values, ["entry", "key"]).select(
        "chunk", "entry", "key", "value")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, total, kinds)

    return (rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"doc_id {rows.schema['id'].dataType.simpleString()}, held_out boolean, "
        "n_tokens long, n_known long, train_tokens long, base_score double, score double")
        .withColumnRenamed("doc_id", id_col))


@query()
def op8_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)
