"""Importance resampling towards a target distribution (operator 12).

Features of a text are its runs of one to three consecutive words; their
CRC-32 deals them to ``BUCKETS`` buckets.  The *gain* of a bucket compares how
often the target and the corpus use it; the weight of a document is the sum of
its features' gains.  Gumbel noise drawn from the document's id turns the
weights into a sample without replacement: the highest scores.

1. Every task counts the features of its texts by bucket; the sums over all
   tasks are one row per bucket.  From these and the target's counts come the
   gains, a table of fixed size, which is broadcast.
2. A document's bucket counts are written as bit planes: plane k holds, for
   every bucket, bit k of its count.  The gains are written as planes too,
   apart by sign.  The AND of a count plane and a gain plane has as many ones
   as buckets with both bits set, each worth two to the power of both places;
   so population counts and powers of two sum up to the exact weight.
3. Rows are range partitioned by their place in the order, written, and
   numbered by their place in the range and the sizes of the ranges before.

CRC-32 is linear over bits: the register after a run of words is that of its
first words, moved on by the length of the last word, XORed with the last
word's own register.  So a word's bytes are read once for all its features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_TABLE, stored

BUCKETS = 10_000
#: bytes of text whose features are held at once
GROUP = 2 << 20
#: documents whose bit planes are held at once
PLANES = 64
#: longer words are read by zlib
LONG_WORD = 64
SEED, MIN_WORDS, PERCENT = 42, 20, 5
ONES, SPACE = np.uint32(0xFFFFFFFF), 32


class Register:
    """CRC-32 registers of many words at once."""

    def __init__(self):
        table = np.zeros(256, np.uint32)
        for b in range(256):
            c = b
            for _ in range(8):
                c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
            table[b] = c
        self.table = table
        #: what a byte adds to the register if j bytes of the word follow it
        self.byte = np.zeros((LONG_WORD, 256), np.uint32)
        self.byte[0] = table
        for j in range(1, LONG_WORD):
            self.byte[j] = self._zero(self.byte[j - 1])
        #: register moved on by n zero bytes, by its four bytes; n up to LONG_WORD
        self.moved = np.zeros((LONG_WORD + 1, 4, 256), np.uint32)
        for k in range(4):
            self.moved[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(1, LONG_WORD + 1):
            self.moved[n] = self._zero(self.moved[n - 1])
        self.byte, self.flat = self.byte.ravel(), self.moved.ravel()

    def _zero(self, register: np.ndarray) -> np.ndarray:
        return self.table[register & np.uint32(255)] ^ (register >> np.uint32(8))

    def space(self, register: np.ndarray) -> np.ndarray:
        return self.table[(register ^ np.uint32(SPACE)) & np.uint32(255)] ^ (register >> np.uint32(8))

    def move(self, register: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Registers after ``size`` more zero bytes each."""
        out, left = register, size
        long = np.flatnonzero(left > LONG_WORD)
        if len(long):
            out, left = out.copy(), left.copy()
            power, step = self.moved[LONG_WORD], LONG_WORD  # moves by 64, 128, 256, ... bytes
            rest = left[long] // LONG_WORD
            left[long] %= LONG_WORD
            while rest.any():
                odd = long[(rest & 1) == 1]
                out[odd] = self._apply(power, out[odd])
                power, step, rest = self._apply(power, power), step * 2, rest >> 1
        base = left.astype(np.int64) << 10
        r = out.astype(np.int64)
        return (self.flat[base + (r & 255)] ^ self.flat[base + 256 + (r >> 8 & 255)]
                ^ self.flat[base + 512 + (r >> 16 & 255)] ^ self.flat[base + 768 + (r >> 24)])

    @staticmethod
    def _apply(move: np.ndarray, r: np.ndarray) -> np.ndarray:
        return (move[0][r & np.uint32(255)] ^ move[1][(r >> np.uint32(8)) & np.uint32(255)]
                ^ move[2][(r >> np.uint32(16)) & np.uint32(255)] ^ move[3][r >> np.uint32(24)])

    def words(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word data[start:stop] the register begun with zero, and the
        one begun with ones (the CRC itself before its last inversion)."""
        size = stop - start
        short = size <= LONG_WORD
        zero = np.zeros(len(start), np.uint32)
        s, n = start[short], size[short]
        if len(s):
            first = np.cumsum(n) - n
            place = np.arange(int(n.sum())) - np.repeat(first, n)  # within the word
            after = np.repeat(n, n) - 1 - place
            value = data[np.repeat(s, n) + place].astype(np.int64)
            zero[short] = np.bitwise_xor.reduceat(self.byte[(after << 8) + value], first)
        begun = self.move(np.full(len(start), ONES), size)
        for i in np.flatnonzero(~short).tolist():
            zero[i] = np.uint32(crc32(data[start[i]:stop[i]].tobytes())) ^ ONES ^ begun[i]
        return zero, begun ^ zero


_REGISTER: list[Register] = []


def _register() -> Register:
    if not _REGISTER:
        _REGISTER.append(Register())
    return _REGISTER[0]


def features(data: bytes, edges: np.ndarray, prior: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Buckets of all features of texts that lie one after another in
    ``data``, the text of each, the number of words of each text, and what the
    next part of the last text needs to go on (``prior`` of that call).

    ``data`` is folded by WORD_TABLE, so that words are what blanks divide;
    text i is data[edges[i]:edges[i + 1]]."""
    r = _register()
    flat = np.frombuffer(data, np.uint8)
    word = flat != SPACE
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < len(flat))]
    begin[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    text = np.searchsorted(edges, start, "right") - 1
    words = np.bincount(text, minlength=len(edges) - 1)[:len(edges) - 1]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words, prior
    size = stop - start
    zero, one = r.words(flat, start, stop)
    # the registers and texts of the two words before each word; the part before goes on in text 0
    before = prior or (np.zeros(2, np.uint32), 0)
    place = np.arange(len(start)) - np.searchsorted(text, text)  # words before it in its text
    place[text == 0] += before[1]
    head_one = np.concatenate([before[0][:1], one[:-1]])
    two = r.move(r.space(head_one), size) ^ zero
    head_two = np.concatenate([before[0][1:], two[:-1]])
    three = r.move(r.space(head_two), size) ^ zero
    has_two, has_three = place >= 1, place >= 2
    crc = np.concatenate([one, two[has_two], three[has_three]]) ^ ONES
    owner = np.concatenate([text, text[has_two], text[has_three]])
    after = (np.array([one[-1], two[-1]], np.uint32), min(2, int(place[-1]) + 1))
    return (crc % np.uint32(BUCKETS)).astype(np.int64), owner, words, after


def parts(text: bytes) -> Iterator[bytes]:
    """A folded text cut at blanks into parts of about GROUP bytes; a longer
    word stays whole."""
    at = 0
    while len(text) - at > GROUP:
        cut = text.find(b" ", at + GROUP)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def grouped(texts: Iterator[str | None]) -> Iterator[list[bytes]]:
    """Texts, folded, in groups of about GROUP bytes; a
    text beyond that stands alone."""
    held, size = [], 0
    for t in texts:
        folded = (t or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE)
        if held and size + len(folded) > GROUP:
            yield held
            held, size = [], 0
        held.append(folded)
        size += len(folded)
    if held:
        yield held


def group_features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, texts, words of each text) of a group, part by part."""
    if len(texts) > 1 or len(texts[0]) <= GROUP:
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        yield features(b"".join(texts), edges)[:3]
        return
    prior = None
    for part in parts(texts[0]):
        bucket, owner, words, prior = features(part, np.array([0, len(part)]), prior)
        yield bucket, owner, words


def bucket_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """bucket, n: how often the features of all texts fall in each bucket;
    buckets without any are left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for group in grouped(t.as_py() for t in batch.column(0)):
                for bucket, _, _ in group_features(group):
                    total += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket; from at most BUCKETS rows of each side."""
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for side, rows in ((s, corpus.collect()), (t, target.collect())):
        for row in rows:
            side[row["bucket"]] = row["n"]
    all_s, all_t = float(s.sum() + BUCKETS), float(t.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t)))
                     for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def planes(values: np.ndarray) -> list[np.ndarray]:
    """Bit planes of a matrix of counts (rows x BUCKETS), lowest bit first;
    each plane has a row of 64-bit words per row of the matrix."""
    out, most = [], int(values.max(initial=0))
    values = values.astype(np.min_scalar_type(most))
    for k in range(most.bit_length()):
        bits = np.packbits((values >> k & 1).astype(bool), axis=1)
        out.append(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64))
    return out


def weigh(counts: np.ndarray, plus: list[np.ndarray], minus: list[np.ndarray]) -> np.ndarray:
    """Sum of count x gain of each row, from bit planes of the counts and of
    the gains above and below zero."""
    out = np.zeros(len(counts), np.int64)
    for k, have in enumerate(planes(counts)):
        for sign, side in ((1, plus), (-1, minus)):
            for j, gain in enumerate(side):
                out += sign * (np.bitwise_count(have & gain).sum(axis=1, dtype=np.int64) << (k + j))
    return out


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plus, minus = planes(np.maximum(shared.value, 0)[None]), planes(np.maximum(-shared.value, 0)[None])
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for group in grouped(t.as_py() for t in batch.column(1)):
                own = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
                for bucket, owner, words in group_features(group):
                    own[0][:] += words
                    own[1][:] += np.bincount(owner, minlength=len(group))
                    order = np.argsort(owner, kind="stable")
                    bucket, owner = bucket[order], owner[order]
                    for a in range(0, len(group), PLANES):
                        b = min(a + PLANES, len(group))
                        lo, hi = np.searchsorted(owner, [a, b])
                        counts = np.bincount((owner[lo:hi] - a) * BUCKETS + bucket[lo:hi], minlength=(b - a) * BUCKETS)
                        own[2][a:b] += weigh(counts.reshape(b - a, BUCKETS), plus, minus)
                for all_, one in zip((n_words, n_features, weight), own, strict=True):
                    all_.append(one)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.concatenate(c), pa.int64()) for c in (n_words, n_features, weight)]],
                ["doc_id", "n_words", "n_features", "weight"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, drawn from the id by its hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("bigint")


def ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows range partitioned by a total order and written with the number of
    their range, so that all that follows meets the same ranges."""
    return stored(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")


def numbered(placed: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Place (from 1) of each row in the order; no task holds more than a
    range of it."""
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    lower = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(lower), F.lit(0)).alias("__offset"))
    own = placed.withColumn(name, F.row_number().over(Window.partitionBy("__range").orderBy(*order)).cast("bigint"))
    return own.join(offsets, "__range").withColumn(name, F.col(name) + F.col("__offset")).drop("__range", "__offset")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score and
    rank.  ``rank`` numbers the drawn documents: of those with at least
    ``min_words`` words the ``percent`` in a hundred (rounded down) with the
    highest scores, ties to the smaller id; null for all others.

    A null or empty text has no feature and weight 0.  A null id takes part
    with the noise of an empty one and stands before all others in a tie; rows
    that repeat an id are drawn apart, those of fewer features and smaller
    weight first.  Without documents or target texts the sums over them are
    zero.  Other columns are not read."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    # written first, since the ranges are drawn from a sample of the rows
    rows = stored(weights(docs, gain, id_col, text_col), "weights").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    fit = F.col("n_words") >= min_words
    order = [fit.desc(), F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc(), F.col("weight").asc()]
    placed = ranges(rows, order)
    drawn = placed.filter(fit).count() * percent // 100
    found = numbered(placed, order, "place")
    return found.withColumn("rank", F.when(fit & (F.col("place") <= drawn), F.col("place"))).drop("place")
