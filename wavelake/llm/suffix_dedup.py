"""Removal of repeated byte strings by a suffix array (operator 3).

A byte goes if it lies in a string of ``LENGTH`` = 100 bytes that also starts
earlier (in a smaller document, or earlier in the same one).

Not every suffix is needed.  Each 100-byte string is represented by the suffix
at its *anchor*: of its 24-byte tokens the one with the least hash, the first
of equals.  The choice depends on the string's content alone, so equal strings
have their anchors at the same place.  Neighbouring strings mostly share their
anchor; they form one *record*: the bytes from the first such string's start
to the last one's end, and the place of the anchor in it.  That is about one
suffix in 39, and no string is left out.

1. The leading tokens of a sample of suffixes give the splitters; a token that
   is frequent in the sample is hot.
2. Each task collapses equal records, so that a group of copies is one record
   per group of texts; the later ones are repeats already.  Records are dealt
   to key ranges by binary search in the splitters and go out as compressed
   blocks.  Records with a hot token are taken apart into their 100-byte
   strings, which are dealt by a hash of all their bytes, so that a hot token
   is spread and equal strings still meet; a task sends a hot string again
   only if it starts earlier than the one it has sent.
3. A bucket sorts its suffixes by multikey quicksort over 8-byte symbols and
   takes the common prefixes of neighbours; the bytes before the anchors are
   sorted the same way, read backwards.  A string with its anchor at byte o
   equals another if both have o, the suffixes share 100 - o bytes and the
   bytes before share o: for each o, two running sums over the common prefixes
   number the classes of equal strings, whose earliest stays.  A token is
   never divided between ranges, except a hot one, whose strings are routed by
   content; so no comparison across bucket boundaries is left over.
4. The repeats meet their document, and the covered bytes are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 100
#: bytes of a token, a multiple of 8; deals suffixes to buckets
TOKEN = 24
#: bytes of records that a bucket holds, about
BUCKET = 32 << 20
#: suffixes drawn per bucket, and at most in all (the splitters go through the driver)
DRAWN, MOST_DRAWN = 256, 1 << 20
#: a token drawn this often is hot
HOT = 8
#: most key ranges; beyond, each range is divided by a hash of the token
MOST_RANGES = 1 << 15
#: bytes of text whose records are collected at once
GROUP = 4 << 20
#: hot strings that a task remembers having sent; forgetting one sends it again
SENT = 50_000
#: bytes of text in one batch of results, about
BATCH = 16 << 20
#: order of rows without an id: after all others
NO_ID = (1 << 63) - 1


def symbols(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number (zeros after
    the end)."""
    x = np.zeros(len(data) + 8, np.uint64)
    x[:len(data)] = data
    for width in (1, 2, 4):
        x[:-width] = (x[:-width] << np.uint64(8 * width)) | x[width:]
    return x[:len(data)]


def record_bounds(data: np.ndarray, length: int, token: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, anchor) of each record of a text."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    s = symbols(data)
    m = len(data) - token + 1
    h = np.zeros(m, np.uint64)
    for k in range(0, token, 8):
        h = (h ^ s[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    # upper half hash, lower half place: the least is the first of the least hash
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    span, width = length - token + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.concatenate([first, [n]])), at[first]


def text_records(text: bytes, length: int, token: int) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Base, bytes and record bounds of a text, about GROUP bytes at a time."""
    for base in range(0, max(1, len(text) - length + 1), GROUP):
        part = text[base:base + GROUP + length - 1]
        first, count, anchor = record_bounds(np.frombuffer(part, np.uint8), length, token)
        if len(first):
            yield base, part, first, count, anchor


class Router:
    """Bucket of a record: key range and, within it, a hash of the token."""

    def __init__(self, splitters: list[bytes], hot: set[bytes], buckets: int):
        self.splitters = np.array(splitters, f"S{TOKEN}") if splitters else np.zeros(0, f"S{TOKEN}")
        self.hot, self.ranges = hot, len(splitters) + 1
        self.parts = max(1, -(-buckets // self.ranges))
        self.buckets = self.ranges * self.parts

    def route(self, tokens: list[bytes]) -> np.ndarray:
        bucket = np.searchsorted(self.splitters, np.array(tokens, f"S{TOKEN}"), "right")
        if self.parts > 1:
            bucket = bucket * self.parts + np.array([crc32(t) % self.parts for t in tokens])
        return bucket

    def route_string(self, piece: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "big") % self.buckets


def pack(columns: np.ndarray, data: bytes) -> bytes:
    """Compressed block: number of records, their columns (id, row, start,
    count, anchor, size), their bytes.  Ids and rows are written as
    differences and a record without bytes by a negative count, all columns
    byte by byte, which leaves long runs of zeros.  A record of ``count``
    starts has the bytes of its first string and one for each further start."""
    out = np.array(columns[:5], "<i8", order="C")
    out[:2] = np.diff(out[:2], axis=1, prepend=0)
    out[3, columns[5] == 0] *= -1
    planes = np.ascontiguousarray(out.view(np.uint8).reshape(5, -1, 8).transpose(0, 2, 1))
    raw = np.array([columns.shape[1]], "<i8").tobytes() + planes.tobytes() + data
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpack(blob: bytes, length: int) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    planes = np.frombuffer(raw, np.uint8, 40 * n, 8).reshape(5, 8, n).transpose(0, 2, 1)
    columns = np.zeros((6, n), np.int64)
    columns[:5] = np.ascontiguousarray(planes).view("<i8").reshape(5, n)
    columns[:2] = np.cumsum(columns[:2], axis=1)
    columns[5] = np.where(columns[3] < 0, 0, columns[3] + length - 1)
    columns[3] = np.abs(columns[3])
    return columns, raw[8 + 40 * n:]


def collect_records(docs: list[tuple[int, int, bytes]], router: Router, length: int,
                    sent: dict[bytes, tuple[int, int, int]]) -> Iterator[tuple[int, bytes]]:
    """(bucket, block) of a group of texts (id, row, bytes) in the order of
    (id, row).  Equal records stay once, as the first; the others go along as
    repeats: records without bytes.  ``sent`` has places of hot strings of
    groups before."""
    seen: set[tuple[bytes, int]] = set()
    place, tokens, strings, pieces, repeats = [], [], [], [], []
    for doc, row, text in docs:
        for base, part, first, count, anchor in text_records(text, length, TOKEN):
            for f, c, a in zip(first.tolist(), count.tolist(), anchor.tolist(), strict=True):
                piece, mark = part[f:f + c + length - 1], part[a:a + TOKEN]
                if (piece, a - f) in seen:
                    if repeats and repeats[-1][1] == row and repeats[-1][2] + repeats[-1][3] == base + f:
                        repeats[-1][3] += c
                    else:
                        repeats.append([doc, row, base + f, c, 0, 0])
                    continue
                seen.add((piece, a - f))
                if mark in router.hot:
                    strings += [(doc, row, base + f + k, 1, a - f - k, piece[k:k + length]) for k in range(c)]
                else:
                    place.append((doc, row, base + f, c, a - f, len(piece)))
                    tokens.append(mark)
                    pieces.append(piece)
    bucket = router.route(tokens) if tokens else np.zeros(0, np.int64)
    known: dict[bytes, None] = {}
    for doc, row, start, one, a, piece in strings:
        if piece in known or piece in sent and sent[piece] < (doc, row, start):
            repeats.append([doc, row, start, one, 0, 0])
        else:
            known[piece] = None
            if len(sent) >= SENT:
                sent.clear()
            sent[piece] = (doc, row, start)
            place.append((doc, row, start, one, a, len(piece)))
            pieces.append(piece)
    if known:
        bucket = np.concatenate([bucket, [router.route_string(p) for p in known]])
    # repeats travel with any bucket; it only hands them on
    place += [tuple(r) for r in repeats]
    pieces += [b""] * len(repeats)
    bucket = np.concatenate([bucket, np.array([r[1] % router.buckets for r in repeats], np.int64)]).astype(np.int64)
    if not place:
        return
    columns = np.array(place, np.int64).T
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]]))
    for a, b in zip(edge, edge[1:], strict=False):
        own = order[a:b]
        yield int(bucket[own[0]]), pack(columns[:, own], b"".join([pieces[i] for i in own.tolist()]))


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of symbols: three-way partition by one
    symbol; the rows equal to the pivot go on with the next symbol."""
    out: list[np.ndarray] = []
    stack = [(np.arange(len(words)), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= 1 or depth == words.shape[1]:
            out.append(rows)
            continue
        column = words[rows, depth]
        if len(rows) <= 2048:  # a small part is sorted by all its symbols at once
            out.append(rows[np.lexsort(words[rows, depth:].T[::-1])])
            continue
        pivot = np.sort(column[:: max(1, len(column) // 65)])[32]
        less, more = column < pivot, column > pivot
        stack += [(rows[more], depth), (rows[~(less | more)], depth + 1), (rows[less], depth)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def suffix_symbols(data: bytes, begin: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Symbols of the suffixes data[begin:end], zeros after their end."""
    width = -(-length // 8) * 8
    flat, out = np.frombuffer(data, np.uint8), np.zeros((len(begin), width // 8), np.uint64)
    for k in range(0, len(begin), 20_000):
        at = begin[k:k + 20_000, None] + np.arange(width)
        inside = at < end[k:k + 20_000, None]
        block = np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0).astype(np.uint8)
        out[k:k + 20_000] = np.ascontiguousarray(block).view(">u8").astype(np.uint64)
    return out


def context_symbols(data: bytes, begin: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Symbols of data[begin:at] read backwards, zeros after their end."""
    width = -(-length // 8) * 8
    flat, out = np.frombuffer(data, np.uint8), np.zeros((len(begin), width // 8), np.uint64)
    for k in range(0, len(begin), 20_000):
        back = at[k:k + 20_000, None] - 1 - np.arange(width)
        block = np.where(back >= begin[k:k + 20_000, None], flat[np.maximum(back, 0)], 0).astype(np.uint8)
        out[k:k + 20_000] = np.ascontiguousarray(block).view(">u8").astype(np.uint64)
    return out


def common_prefixes(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row of the order, but the first, shares with the one
    before it."""
    out = np.full(max(0, len(order) - 1), words.shape[1] * 8, np.int64)
    open_ = np.arange(len(out))
    for k in range(words.shape[1]):
        differ = words[order[open_ + 1], k] ^ words[order[open_], k]
        end, x = open_[differ > 0], differ[differ > 0]
        out[end] = 8 * k + sum((x < np.uint64(1 << 8 * e)).astype(np.int64) for e in range(1, 8))
        open_ = open_[differ == 0]
    return out


def classes(common: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Number of each row's class: rows that share their first ``width`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(common < width)])
    return out


def repeated_strings(data: bytes, offset: np.ndarray, columns: np.ndarray, length: int) -> np.ndarray:
    """Columns row and start of the strings of the records that also start
    earlier, from the common prefixes of neighbours in suffix order."""
    doc, row, start, count, anchor, size = columns
    words = suffix_symbols(data, offset + anchor, offset + size, length)
    order = multikey_quicksort(words)
    after = common_prefixes(words, order)
    del words
    reach = np.zeros(len(order), np.int64)  # bytes shared with a neighbour
    reach[1:] = after
    reach[:-1] = np.maximum(reach[:-1], after)
    near = np.flatnonzero(reach >= length - anchor[order])
    if len(near) < 2:
        return np.zeros((2, 0), np.int64)
    after = np.minimum.reduceat(after[:near[-1]], near[:-1])  # what is left out lies between them
    doc, row, start, count, anchor, offset = (x[order[near]] for x in (doc, row, start, count, anchor, offset))
    here = np.arange(len(near))
    words = context_symbols(data, offset, offset + anchor, length - TOKEN)
    order = multikey_quicksort(words)
    before = common_prefixes(words, order)
    del words
    place = np.empty(len(near), np.int64)
    place[np.lexsort((start + anchor, row, doc))] = here
    found = [np.zeros((2, 0), np.int64)]
    for o in range(int(anchor.max()) + 1):
        right = classes(after, here, length - o)
        own = np.flatnonzero((anchor >= o) & (anchor - count < o))
        own = own[np.bincount(right[own], minlength=1)[right[own]] > 1]
        if len(own):
            key = right[own] * len(near) + classes(before, order, o)[own]
            by = np.lexsort((place[own], key))
            later = own[by[1:][key[by[1:]] == key[by[:-1]]]]
            found.append(np.stack([row[later], start[later] + anchor[later] - o]))
    return np.concatenate(found, axis=1)


def bucket_repeats(blobs: list[bytes], length: int) -> np.ndarray:
    """Repeated starts of a bucket: columns row, start, count."""
    parts = [unpack(b, length) for b in blobs]
    columns = np.concatenate([c for c, _ in parts], axis=1)
    data = b"".join([d for _, d in parts])
    del parts
    known = columns[5] == 0
    offset = np.cumsum(columns[5]) - columns[5]
    row, start = repeated_strings(data, offset[~known], columns[:, ~known], length)
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(start) != 1)])) if len(row) else order
    runs = np.stack([row[first], start[first], np.diff(np.concatenate([first, [len(row)]]))])
    return np.concatenate([columns[1:4, known], runs], axis=1)


def _bounded(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices whose column of bytes holds about BATCH at most."""
    for batch in batches:
        total = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)) // BATCH
        edge = np.flatnonzero(np.concatenate([[True], total[1:] != total[:-1], [True]])) if len(total) else []
        for a, b in zip(edge, edge[1:], strict=False):
            yield batch.slice(int(a), int(b - a))


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (unique), doc_id and text as bytes.  The number of a row depends on
    its place in the scan, so ``docs`` must be a stored table."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def place_splitters(rows: DataFrame, length: int, bucket: int = BUCKET) -> Router:
    """Router for a table: the number of buckets follows its bytes, splitters
    and hot tokens a sample of its suffixes, of at most MOST_DRAWN."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size * 7 // 2 // bucket))  # a byte is in 3.5 records
    wanted = min(DRAWN * buckets, MOST_DRAWN)
    # whole documents are drawn at 8 times the rate, and an eighth of their suffixes
    rate = min(1.0, 8 * wanted * (length - TOKEN + 2) / 2 / max(size, 1))
    keep = wanted * (length - TOKEN + 2) / 2 / max(size, 1) / rate

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for base, part, _, _, anchor in text_records(text.as_py(), length, TOKEN):
                    dice = np.random.default_rng([row, base]).random(len(anchor))
                    tokens += [part[a:a + TOKEN] for a in anchor[dice < keep].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary())], ["token"])
    drawn = rows.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < rate * (1 << 20)).select("row", "text")
    tokens = np.sort(np.array([bytes(r[0]) for r in drawn.mapInArrow(draw, "token binary").collect()], f"S{TOKEN}"))
    ranges = min(buckets, MOST_RANGES)
    split = np.unique(tokens[[len(tokens) * k // ranges for k in range(1, ranges)]]) if len(tokens) else tokens
    value, times = np.unique(tokens, return_counts=True)
    pad = lambda t: t.ljust(TOKEN, b"\0")  # noqa: E731  numpy drops zeros at the end
    return Router([pad(t) for t in split.tolist()], {pad(t) for t in value[times >= HOT].tolist()}, buckets)


def repeated_starts(rows: DataFrame, router: Router, length: int) -> DataFrame:
    """row, start, count: ``count`` strings in a row from ``start`` on that
    also start earlier.  ``rows`` as _numbered gives them."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (router.splitters.tolist(), router.hot, router.buckets))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router([t.ljust(TOKEN, b"\0") for t in shared.value[0]], shared.value[1], shared.value[2])

        def flush(docs):
            docs.sort(key=lambda d: d[:2])
            found = list(collect_records(docs, router, length, sent))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int64()),
                                               pa.array([x for _, x in found], pa.binary())], ["bucket", "blob"])
        held, size, sent = [], 0, {}
        for batch in batches:
            for doc, row, text in zip(batch.column(1), batch.column(0), batch.column(2), strict=True):
                held.append((NO_ID if doc.as_py() is None else doc.as_py(), row.as_py(), text.as_py()))
                size += len(held[-1][2])
                if size >= GROUP:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def compare(table: pa.Table) -> pa.Table:
        row, start, count = bucket_repeats([b.as_py() for b in table.column("blob")], length)
        return pa.table({"row": pa.array(row, pa.int64()), "start": pa.array(start, pa.int64()),
                         "count": pa.array(count, pa.int64())})
    blobs = rows.mapInArrow(deal, "bucket bigint, blob binary")
    return blobs.groupBy("bucket").applyInArrow(compare, "row bigint, start bigint, count bigint")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   bucket: int = BUCKET) -> DataFrame:
    """One row per input row: doc_id, n_bytes, removed spans (start, stop;
    merged) and the remaining bytes.

    A null text is empty; texts under ``length`` bytes stay whole.  Rows
    without an id come after all others; rows of equal id are ordered by their
    place in the table, which must be a stored one (a rescan must give the
    same rows in the same partitions).  Other columns are not read."""
    if length < 2 * TOKEN:
        raise ValueError(f"length must be at least {2 * TOKEN}")
    rows = _numbered(docs, id_col, text_col)
    starts = repeated_starts(rows, place_splitters(rows, length, bucket), length)
    # the runs of a document are bounded by its own size
    spans = starts.groupBy("row").agg(F.collect_list(F.struct("start", "count")).alias("runs"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in _bounded(batches, 2):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([press.compress(t.as_py()) for t in batch.column(2)],
                                                            pa.binary())], ["row", "doc_id", "packed"])
    packed = rows.mapInArrow(squeeze, "row bigint, doc_id bigint, packed binary")
    joined = packed.join(spans, "row", "left").select("doc_id", "packed", "runs")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(ids, size, removed, left):
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(removed, span),
                 pa.array(left, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])
        ids, size, removed, left, held = [], [], [], [], 0
        for batch in batches:
            for doc, blob, runs in zip(*batch.columns, strict=True):
                text, runs = zstandard.ZstdDecompressor().decompress(blob.as_py()), runs.as_py()
                spans, at, kept = [], 0, []
                for r in sorted(runs or [], key=lambda r: r["start"]):
                    a, b = r["start"], r["start"] + r["count"] + length - 1
                    if spans and a <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(b, spans[-1]["stop"])
                    else:
                        spans.append({"start": a, "stop": b})
                for s in spans:
                    kept.append(text[at:s["start"]])
                    at = s["stop"]
                kept.append(text[at:])
                ids.append(doc.as_py())
                size.append(len(text))
                removed.append(spans)
                left.append(b"".join(kept))
                held += len(text)
                if held >= BATCH:
                    yield rows_of(ids, size, removed, left)
                    ids, size, removed, left, held = [], [], [], [], 0
        if ids:
            yield rows_of(ids, size, removed, left)
    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, "
                                  "kept binary")


def removal_report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``remove_repeats``."""
    found = remove_repeats(docs)
    return found.select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
        .alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: the report as DuckDB SQL over ``documents``: every string as a row, spans as islands; two hexadecimal digits a byte
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h
      FROM documents),
s AS (SELECT r, p, substr(h, 2 * p + 1, {2 * LENGTH}) AS x
      FROM (SELECT r, h, unnest(range(0, len(h) // 2 - {LENGTH - 1})) AS p FROM d WHERE len(h) >= {2 * LENGTH})),
f AS (SELECT r, p FROM (SELECT r, p, row_number() OVER (PARTITION BY x ORDER BY r, p) AS k FROM s) WHERE k > 1),
j AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS jump FROM f),
i AS (SELECT r, p, sum(jump) OVER (PARTITION BY r ORDER BY p) AS island FROM j),
z AS (SELECT r, min(p) AS a, max(p) + {LENGTH} AS b FROM i GROUP BY r, island),
k AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM z
      UNION ALL SELECT d.r, coalesce(max(b), 0), len(any_value(h)) // 2 FROM d LEFT JOIN z USING (r) GROUP BY d.r),
t AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM k JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM z GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN t USING (r) LEFT JOIN n USING (r)"""
