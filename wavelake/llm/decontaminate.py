"""Benchmark decontamination with an FM-index per training shard (operator 5).

A shard is a run of up to ``SHARD`` documents and ``SHARD_BYTES`` of a partition.  Its text is a sequence of word
symbols: the words that occur in the benchmark are numbered, every other word
is the separator 0, and so is the end of a document.  A phrase can only lie
inside a stretch of numbered words that is at least as long as the shortest
phrase, so the other stretches are left out of the index; no occurrence is
lost.  Over what is left the shard builds

* the suffix order by prefix doubling,
* its Burrows-Wheeler transform in a wavelet matrix (one bit vector with
  running counts per symbol bit), which answers ``rank``,
* the positions of every ``SAMPLE``-th text position.

All phrases are searched backwards together; each occurrence in a found
interval walks LF steps to a sampled position.  Spans of occurrences are
merged per document.  The phrases go to the tasks as a broadcast of bounded
size: a benchmark of more than ``BLOCK_BYTES`` is searched in several blocks,
one after another, whose spans are merged by document.  Equal items are one
text with several ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_TABLE, stored

WINDOW = 10
SAMPLE = 8
#: documents and bytes of text per shard
SHARD, SHARD_BYTES = 2500, 16 << 20
#: bytes of distinct benchmark texts and item ids that one broadcast holds, about
BLOCK_BYTES = 16 << 20


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


class Wavelet:
    """Wavelet matrix over small integers: ``rank(c, i)`` counts c in [0, i)."""

    def __init__(self, seq: np.ndarray, top: int):
        self.n, self.bits = len(seq), max(1, int(top).bit_length())
        self.ones: list[np.ndarray] = []
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1
            run = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=run[1:])
            self.ones.append(run)
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo = np.zeros_like(i)
        for run, b in zip(self.ones, range(self.bits - 1, -1, -1), strict=True):
            zeros, one = self.n - run[-1], ((c >> b) & 1) == 1
            i, lo = np.where(one, zeros + run[i], i - run[i]), np.where(one, zeros + run[lo], lo - run[lo])
        return i - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for run in self.ones:
            one = run[i + 1] - run[i]
            c = (c << 1) | one
            i = np.where(one == 1, self.n - run[-1] + run[i], i - run[i])
        return c


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    ranked, rank = key[order], np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
    return rank


class FMIndex:
    """Backward search over a text of integers from 0 up."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        t = np.concatenate([np.asarray(text, np.int64) + 1, [0]])  # 0 ends the text and sorts first
        n, width = len(t), 1
        order = np.argsort(t, kind="stable")
        rank = _ranks(t, order)
        while rank.max() < n - 1:  # prefix doubling until every suffix has a rank of its own
            ahead = np.zeros(n, np.int64)
            ahead[:n - width] = rank[width:] + 1
            pair = rank * (n + 1) + ahead
            order = np.argsort(pair, kind="stable")
            rank = _ranks(pair, order)
            width *= 2
        self.n, self.top = n, int(t.max())
        self.wavelet = Wavelet(t[order - 1], self.top)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(t))]).astype(np.int64)
        self.marked = order % sample == 0
        self.marked_before = np.concatenate([[0], np.cumsum(self.marked)]).astype(np.int64)
        self.samples = order[self.marked].astype(np.int64)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of each phrase (rows, right-aligned in the matrix)."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for step in range(width):
            c = phrases[:, width - 1 - step] + 1
            live = np.flatnonzero((lengths > step) & (hi > lo))
            if not len(live):
                break
            known = c[live] <= self.top
            hi[live[~known]] = lo[live[~known]]
            live, c = live[known], c[live[known]]
            lo[live] = self.first[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.first[c] + self.wavelet.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: LF steps up to a sampled one."""
        out, at, steps = np.empty(len(rows), np.int64), rows.copy(), 0
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.marked[at[todo]]
            done = todo[hit]
            out[done] = self.samples[self.marked_before[at[done]]] + steps
            todo = todo[~hit]
            c = self.wavelet.access(at[todo])
            at[todo] = self.first[c] + self.wavelet.rank(c, at[todo])
            steps += 1
        return out


def phrase_table(units: list[tuple[str, list[str]]], window: int) -> dict:
    """Numbered vocabulary, right-aligned phrase matrix and owners of
    ``units`` (words joined by blanks, item ids).  Equal phrases are one row;
    the units of row p are ``unit[begin[p]:begin[p + 1]]``."""
    vocab: dict[bytes, int] = {}
    parts = [np.array([vocab.setdefault(w, len(vocab) + 1) for w in text.encode("utf-8", "surrogatepass").split()],
                      np.int32) for text, _ in units]
    rows, owner = [], []
    for u, ids in enumerate(parts):
        if len(ids) >= window:
            rows.append(np.lib.stride_tricks.sliding_window_view(ids, window))
        elif len(ids):
            rows.append(np.concatenate([np.zeros(window - len(ids), np.int32), ids])[None])
        owner.append(np.full(len(rows[-1]) if len(ids) else 0, u, np.int32))
    matrix = np.ascontiguousarray(np.concatenate([np.zeros((0, window), np.int32), *rows]))
    del parts, rows
    keys = matrix.view(f"V{4 * window}").ravel()
    _, first, phrase = np.unique(keys, return_index=True, return_inverse=True)
    pairs = np.unique(phrase.astype(np.int64) << 32 | np.concatenate([np.zeros(0, np.int32), *owner]).astype(np.int64))
    matrix = matrix[first]
    return {"vocab": vocab, "matrix": matrix, "lengths": (matrix > 0).sum(axis=1), "window": window,
            "begin": np.searchsorted(pairs >> 32, np.arange(len(matrix) + 1)),
            "unit": (pairs & 0xFFFFFFFF).astype(np.int32), "items": [ids for _, ids in units]}


def find_spans(texts: list[str | None], phrases: dict) -> tuple[list[int], list[list[tuple[int, int]]], list[set]]:
    """Per text: its number of words, the merged [start, end) word spans of
    all occurrences, and the items they belong to."""
    vocab, lengths = phrases["vocab"], phrases["lengths"]
    get, n_words, parts = vocab.get, [], []
    for t in texts:
        ids = [get(w, 0) for w in words(t)]
        n_words.append(len(ids))
        ids.append(0)  # matches never cross documents
        parts.append(np.array(ids, np.int64))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    if not len(lengths) or not parts:
        return n_words, spans, items
    text = np.concatenate(parts)
    offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], text > 0, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= lengths.min()
    keep = np.zeros(len(text) + 1, np.int32)
    np.add.at(keep, begin[long], 1)
    np.add.at(keep, end[long] + 1, -1)  # with the separator that ends it
    where = np.flatnonzero(np.cumsum(keep)[:-1])
    if not len(where):
        return n_words, spans, items
    index = FMIndex(text[where])
    lo, hi = index.search(phrases["matrix"], lengths)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return n_words, spans, items
    count = hi[found] - lo[found]
    rows = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    phrase = np.repeat(found, count)
    at = where[index.locate(rows)]
    doc = np.searchsorted(offset, at, "right") - 1
    order = np.lexsort((at, doc))
    for d, s, n in zip(doc[order].tolist(), (at - offset[doc])[order].tolist(), lengths[phrase[order]].tolist(),
                       strict=True):
        if spans[d] and s <= spans[d][-1][1]:
            spans[d][-1] = (spans[d][-1][0], max(s + n, spans[d][-1][1]))
        else:
            spans[d].append((s, s + n))
    begin, unit, own = phrases["begin"], phrases["unit"], np.unique(np.stack([doc, phrase]), axis=1)
    for d in np.unique(own[0]).tolist():
        hit = own[1, slice(*np.searchsorted(own[0], [d, d + 1]))].tolist()
        for u in np.unique(np.concatenate([unit[begin[p]:begin[p + 1]] for p in hit])).tolist():
            items[d].update(phrases["items"][u])
    return n_words, spans, items


SCHEMA = "doc_id bigint, n_words bigint, spans array<struct<start:bigint,stop:bigint>>, items array<string>"


def _units(benchmark: DataFrame, item_col: str, text_col: str, window: int, part_bytes: int) -> DataFrame:
    """Distinct (t, i): the words of an item joined by blanks and its id as
    text.  Long items are cut into parts of about ``part_bytes`` that share
    ``window`` - 1 words, so every window is whole in one part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own, begin, size = words(text.as_py()), 0, 0
                for k, w in enumerate(own):
                    size += len(w) + 1
                    if size >= part_bytes and k - begin >= 2 * window or k == len(own) - 1:
                        texts.append(b" ".join(own[begin:k + 1]).decode("utf-8", "surrogatepass"))
                        ids.append("None" if item is None else item)
                        begin, size = k + 2 - window, 0
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(ids, pa.string())], ["t", "i"])
    return benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")) \
        .mapInArrow(run, "t string, i string").distinct()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> Iterator:
    """Broadcast phrase tables, one after another, and whether it is the last.
    A block holds about ``block_bytes`` of distinct texts and item ids.  A text
    is in one block with all its ids; only the ids of a text that are over an
    eighth of a block by themselves are dealt to all of them (there are at most
    8 such texts a block)."""
    units, context = _units(benchmark, item_col, text_col, window, max(1, block_bytes // 8)), \
        benchmark.sparkSession.sparkContext

    def table(block: DataFrame):
        grouped = block.groupBy("t").agg(F.collect_list("i").alias("i")).toArrow()
        return context.broadcast(phrase_table(list(zip(*(c.to_pylist() for c in grouped.columns), strict=True)), window))
    raw = benchmark.agg(F.sum(F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0))
                              + F.coalesce(F.octet_length(F.col(item_col).cast("string")), F.lit(4)))).first()[0] or 0
    if raw <= block_bytes:
        yield table(units), True
        return
    units = stored(units.withColumn("h", F.xxhash64("t")), "benchmark")
    by_text = units.groupBy("h").agg(F.sum(F.octet_length("i")).alias("ids"), F.max(F.octet_length("t")).alias("size"))
    total = by_text.agg(F.sum(F.col("ids") + F.col("size"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    hot = [r["h"] for r in by_text.filter(F.col("ids") > max(1, block_bytes // 8)).select("h").collect()]
    key = F.when(F.col("h").isin(hot), F.xxhash64("i")).otherwise(F.col("h")) if hot else F.col("h")
    for b in range(blocks):
        yield table(units.filter(F.pmod(key, F.lit(blocks)) == b).select("t", "i")), b == blocks - 1


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its id, number of words, merged word spans to
    remove and the sorted item ids that occur in it.

    A window is ``window`` consecutive words of an item; an item of fewer
    words, but not none, is one window.  Null and empty texts have no words;
    a null item id reads ``None``; repeated items and documents are judged
    each for itself; an empty benchmark hits nothing.  Extra columns of
    either table are not read."""
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # a key that stays with the row while its blocks are merged
    keyed = base.withColumn("key", F.struct(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"),
                                            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("c")))
    parts = []
    for table, last in _blocks(benchmark, item_col, item_text_col, window, block_bytes):
        if last and not parts:
            return _search(base, table)
        found = _search(keyed, table).withColumn("own", F.lit(0 if parts else 1))
        # written at once, so that one block's phrases are held at a time; after the first only hits matter
        parts.append(stored(found.filter(F.size("spans") > 0) if parts else found, "hits"))
        table.destroy()
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    # repeated rows of one id and text have equal spans: they count per row
    merged = (merged.groupBy("key").agg(
        F.max("n_words").alias("n_words"), F.sum("own").cast("bigint").alias("copies"),
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    merged = merged.withColumn("spans", _merged_spans("spans"))
    return merged.select(F.col("key.d").alias("doc_id"), "n_words", "spans", "items",
                         F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_")).drop("_")


def _merged_spans(name: str):
    """Touching and overlapping spans of the array column joined."""
    empty = F.lit([]).cast("array<struct<start:bigint,stop:bigint>>")
    def step(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(
            F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))))
        return F.when((F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["stop"]), joined) \
            .otherwise(F.concat(done, F.array(span)))
    return F.aggregate(F.array_sort(F.array_distinct(F.col(name))), empty, step)


def _search(base: DataFrame, table) -> DataFrame:
    keyed = "key" in base.columns
    schema = SCHEMA + (", key struct<d:bigint,h:bigint,c:bigint>" if keyed else "")
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = table.value
        for batch in _shards(batches):
            n_words, spans, items = find_spans(batch.column("text").to_pylist(), phrases)
            cols = [batch.column("doc_id"), pa.array(n_words, pa.int64()),
                    pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], spans_type),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
            names = ["doc_id", "n_words", "spans", "items"]
            if keyed:
                cols, names = [*cols, batch.column("key")], [*names, "key"]
            yield pa.RecordBatch.from_arrays(cols, names)
    return base.mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, without those that hold a window of
    the benchmark.  Nothing is shuffled: each block of phrases filters what
    the one before let through, which is written in between."""
    for table, last in _blocks(benchmark, item_col, item_text_col, window, block_bytes):
        docs = docs.mapInArrow(_clean_rows(table, text_col), docs.schema)
        if not last:  # written at once, so that one block's phrases are held at a time
            docs = stored(docs, "clean")
            table.destroy()
    return docs


def _shards(batches: Iterator[pa.RecordBatch], text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of at most SHARD rows and, but for one longer text, SHARD_BYTES."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
        begin, held = 0, 0
        for k, size in enumerate(sizes.to_pylist()):
            if k > begin and (k - begin == SHARD or held + size > SHARD_BYTES):
                yield batch.slice(begin, k - begin)
                begin, held = k, 0
            held += size
        if batch.num_rows:
            yield batch.slice(begin)


def _clean_rows(table, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shards(batches, text_col):
            _, spans, _ = find_spans(batch.column(text_col).to_pylist(), table.value)
            yield batch.filter(pa.array([not s for s in spans], pa.bool_()))
    return run


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest columns of ``contamination`` (one row per document)."""
    found = contamination(docs, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


#: the report as DuckDB SQL over ``documents`` and ``benchmark``: windows as strings, joined
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'None') AS item, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS phrase
      FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS k FROM b WHERE len(w) > 0)),
g AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS phrase
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT r, k, n, item FROM g JOIN p USING (n, phrase)),
c AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM h) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN i USING (r)"""
