"""Divergence of sources by their terms (operator 11).

Every language keeps the terms that at least ``MIN_DOCS`` of its documents
hold.  A group, that is a source within a language, and the language as a
whole give each kept term a probability with add-one smoothing, in whole
billionths.  Two groups diverge by the sum of (p - q)^2 / q over all kept
terms; a group's own terms are those that it uses more than its language.

1. *Token starts.*  A task takes slices of its texts as Arrow buffers, ordered
   by group, and marks where terms start: pointers to suffixes that end with
   their term.  Multikey quicksort over 8-byte symbols sorts the pointers, not
   the terms, and keeps equal ones in the order of the texts.  A run of equal
   pointers is a term: the changes of document within it are its document
   frequency, the changes of group divide its counts.
2. The counts of all slices are added by (language, source, term) and written;
   terms under ``MIN_DOCS`` go.
3. *Pairs.*  Kept terms and sources are dealt to blocks by hash.  A task lays
   the probabilities of two blocks of sources over a block of terms out as a
   small matrix and adds up its pairs; a term that neither source holds
   contributes the same everywhere, so only the number of such terms counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, stored

MIN_DOCS = 3
#: how many of a group's own terms are listed
TOP = 200
#: bytes of text whose pointers are sorted at once
SLICE = 16 << 20
#: pointers that are sorted by a symbol at once, and symbols after which whole rests are compared
SMALL, DEEP = 2048, 64
#: terms and sources of a block of pairs, about
TERMS, SOURCES = 4096, 128
#: parts of a group that are ranked apart first
SALT = 32
BILLION = 1_000_000_000

#: A-Z in lower case, other bytes that are no part of a term 0
TERM_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256))


class Pointers:
    """Starts and ends of the terms in folded bytes, and their order."""

    def __init__(self, data: bytes, edges: np.ndarray):
        self.data = data
        flat = np.frombuffer(data, np.uint8) != 0
        begin, end = flat.copy(), flat.copy()
        begin[1:] &= ~flat[:-1]
        end[:-1] &= ~flat[1:]
        inner = edges[(edges > 0) & (edges < len(flat))]  # no term reaches over the edge of a text
        begin[inner] |= flat[inner]
        end[inner - 1] |= flat[inner - 1]
        self.start, self.stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        # the 8 bytes from any place on, read where they are
        self._symbols = np.ndarray(len(data) + 1, ">u8", data + bytes(8), strides=(1,))

    def symbol(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """Bytes 8 x depth to 8 x depth + 7 of the terms as numbers, zeros after their end."""
        at = self.start[rows] + 8 * depth
        left = self.stop[rows] - at
        found = self._symbols[np.minimum(at, len(self.data))].astype(np.uint64)
        cut = ((8 - np.clip(left, 1, 8)) * 8).astype(np.uint64)
        return np.where(left > 0, found >> cut << cut, np.uint64(0))

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the pointers by their terms, equal ones by place, and where
        a new term begins: three-way partition by one symbol; those equal to
        the pivot go on with the next unless their term ends in it."""
        order = np.arange(len(self.start))
        keys, first = self.symbol(order, 0), np.zeros(len(order), bool)
        stack = [(0, len(order), 0)] if len(order) else []
        while stack:
            lo, hi, depth = stack.pop()
            rows, key = order[lo:hi], keys[lo:hi]
            if hi - lo <= SMALL:
                order[lo:hi], first[lo:hi] = self._sort_small(rows, key, depth)
                continue
            drawn = np.sort(key[:: max(1, len(key) // 64)])
            pivot = drawn[len(drawn) // 2]
            less, more = key < pivot, key > pivot
            same = ~(less | more)
            order[lo:hi] = np.concatenate([rows[less], rows[same], rows[more]])
            keys[lo:hi] = np.concatenate([key[less], key[same], key[more]])
            a, b = lo + int(less.sum()), hi - int(more.sum())
            if int(pivot) & 255:
                keys[a:b] = self.symbol(order[a:b], depth + 1)
                stack.append((a, b, depth + 1))
            else:
                first[a] = True
            stack += [part for part in ((lo, a, depth), (b, hi, depth)) if part[0] < part[1]]
        return order, first

    def _sort_small(self, rows: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        open_ = (key & np.uint64(255)) != 0
        deep = depth
        while True:
            alone = first & np.concatenate([first[1:], [True]])
            at = np.flatnonzero(open_ & ~alone)
            if not len(at):
                return rows, first
            deep += 1
            run = np.cumsum(first)[at]
            if deep - depth > DEEP:
                rest = [self.data[a:b] for a, b in zip((self.start[rows[at]] + 8 * deep).tolist(),
                                                       self.stop[rows[at]].tolist(), strict=True)]
                order = np.array(sorted(range(len(at)), key=lambda i: (run[i], rest[i])))
                differ = [rest[a] != rest[b] for a, b in zip(order, order[1:], strict=False)]
                rows[at] = rows[at][order]
                first[at[1:]] |= np.array(differ, bool) & (run[1:] == run[:-1])
                return rows, first
            key = self.symbol(rows[at], deep)
            order = np.lexsort((key, run))
            rows[at], key = rows[at][order], key[order]
            first[at[1:]] |= (run[1:] == run[:-1]) & (key[1:] != key[:-1])
            open_[at] = (key & np.uint64(255)) != 0


def count_runs(data: bytes, edges: np.ndarray, group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray,
                                                                          np.ndarray, np.ndarray]:
    """Terms of texts data[edges[i]:edges[i + 1]] of ascending ``group``; then
    per run and group: the number of the term, the group, its texts that hold
    the term, and how often."""
    pointers = Pointers(data, edges)
    order, first = pointers.sort()
    if not len(order):
        return [], *[np.zeros(0, np.int64) for _ in range(4)]
    text = np.searchsorted(edges, pointers.start, "right")[order] - 1
    own = group[text]
    new_text = first | np.concatenate([[True], text[1:] != text[:-1]])
    new_group = first | np.concatenate([[True], own[1:] != own[:-1]])
    at = np.flatnonzero(new_group)
    heads = order[first]
    terms = [data[a:b] for a, b in zip(pointers.start[heads].tolist(), pointers.stop[heads].tolist(), strict=True)]
    return (terms, np.cumsum(first)[at] - 1, own[at], np.add.reduceat(new_text.astype(np.int64), at),
            np.diff(np.concatenate([at, [len(order)]])))


def _text_parts(text: bytes) -> Iterator[bytes]:
    """A folded text cut between terms into parts of about SLICE bytes."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.find(b"\0", at + SLICE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


COUNTS = "lang string, source string, term string, docs bigint, n bigint"


def _slice_counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Counts of a slice: a batch (lang, source, text) of about SLICE bytes,
    or of one longer text.  Each group also gets a row with an empty term."""
    lang, source = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
    n_source = max(1, len(source.dictionary))
    group = lang.indices.to_numpy().astype(np.int64) * n_source + source.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    text = batch.column(2).cast(pa.large_string()).take(pa.array(order))
    edges = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)
    data = text.buffers()[2].to_pybytes()[:edges[-1]].translate(TERM_TABLE) if edges[-1] else b""
    group = group[order]

    def rows(terms: list[bytes], run, own, docs, n) -> pa.RecordBatch:
        words = pa.array(terms, pa.binary()).cast(pa.string()).take(pa.array(run))
        return pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(own // n_source)), source.dictionary.take(pa.array(own % n_source)), words,
             pa.array(docs, pa.int64()), pa.array(n, pa.int64())], ["lang", "source", "term", "docs", "n"])
    every = np.unique(group)
    zero = np.zeros(len(every), np.int64)
    yield rows([b""], zero, every, zero, zero)
    if len(batch) > 1 or len(data) <= SLICE:
        yield rows(*count_runs(data, edges, group))
        return
    seen: set[bytes] = set()  # terms of this one text; it counts once as a document
    for part in _text_parts(data):
        terms, run, own, _, n = count_runs(part, np.array([0, len(part)]), group)
        yield rows(terms, run, own, np.array([t not in seen for t in terms], np.int64), n)
        seen.update(terms)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, docs, n: documents of the group that hold the term
    and how often it occurs in them.  A row with an empty term stands for the
    group itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy().astype(np.int64))
            at = 0
            while at < len(batch):
                done = size[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(size, done + SLICE, "right")))
                yield from _slice_counts(batch.slice(at, end - at))
                at = end
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return rows.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"),
                                                                              F.sum("n").alias("n"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), exactly; null where nothing is kept."""
    small = F.expr(f"bigint({BILLION})") * (F.least(count, F.lit(8_000_000_000)) + 1)
    large = F.lit(BILLION).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    whole = (total + kept)
    return F.when(kept > 0, 1 + F.when(count <= 8_000_000_000, _div(small, whole))
                  .otherwise(_div(large, whole.cast("decimal(20,0)"))))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _pair_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Partial sums over one block of terms of all ordered pairs between two
    blocks of sources (or within one).  Rows without a term hold a source's
    share of a term that it lacks."""
    lang, _, i, j = (k.as_py() for k in key)
    source, term, p = table.column("source"), table.column("term"), table.column("p").to_numpy()
    base = term.is_null().to_numpy()
    names = source.filter(pa.array(base)).combine_chunks()
    block = table.column("source_block").filter(pa.array(base)).to_numpy()
    place = {n: k for k, n in enumerate(names.to_pylist())}
    own = source.filter(pa.array(~base)).combine_chunks().dictionary_encode()
    row = np.array([place[n] for n in own.dictionary.to_pylist()], np.int64)[own.indices.to_numpy()]
    column = term.filter(pa.array(~base)).combine_chunks().dictionary_encode()
    n_terms = len(column.dictionary)
    shares = np.repeat(p[base][:, None], n_terms, axis=1)
    shares[row, column.indices.to_numpy()] = p[~base]
    out = []
    for a in range(len(names)):
        other = np.flatnonzero(block != block[a]) if i != j else np.flatnonzero(np.arange(len(names)) != a)
        q = shares[other]
        out.append((np.full(len(other), a), other, ((shares[a] - q) ** 2 // q).sum(axis=1, dtype=np.int64)))
    a, b, value = (np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else [()] * 3))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": names.take(pa.array(a, pa.int64())),
                     "item": names.take(pa.array(b, pa.int64())), "value": pa.array(value, pa.int64()),
                     "n_terms": pa.array(np.full(len(a), n_terms), pa.int64())})


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: divergence of each source from each other
    one of its language.  ``kept``: lang, source, term, n of kept terms;
    ``groups``: lang, source, total (of n), n_kept and n_sources of the lang."""
    blocked = groups.select(
        "lang", "source", "total", "n_kept", F.greatest(F.lit(1), F.ceil(F.col("n_kept") / TERMS)).alias("term_blocks"),
        F.ceil(F.col("n_sources") / SOURCES).alias("source_blocks"),
        F.coalesce(share(F.lit(0).cast("bigint"), F.col("total"), F.col("n_kept")), F.lit(1)).alias("none"))
    blocked = blocked.withColumn("source_block", F.pmod(F.xxhash64("source"), F.col("source_blocks")))
    base = blocked.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("term_blocks") - 1)).alias("term_block"),
                          F.lit(None).cast("string").alias("term"), F.col("none").alias("p"))
    terms = kept.join(blocked, ["lang", "source"]).select(
        *[blocked[c] for c in blocked.columns], F.pmod(F.xxhash64("term"), F.col("term_blocks")).alias("term_block"), "term",
        share(F.col("n"), F.col("total"), F.col("n_kept")).alias("p"))
    both = base.unionByName(terms).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                                            F.col("source_blocks") - 1)))
    low, high = F.least("source_block", "other").alias("i"), F.greatest("source_block", "other").alias("j")
    parts = (both.select("lang", "term_block", low, high, "source", "source_block", "term", "p")
             .groupBy("lang", "term_block", "i", "j")
             .applyInArrow(_pair_block, "lang string, source string, item string, value bigint, n_terms bigint"))
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("n_terms").alias("seen"))
    one = blocked.select("lang", "source", "n_kept", F.col("none").alias("p"))
    two = blocked.select("lang", F.col("source").alias("item"), F.col("none").alias("q"))
    found = summed.join(one, ["lang", "source"]).join(two, ["lang", "item"])
    rest = (F.col("n_kept") - F.col("seen")) * divergence(F.col("p"), F.col("q"))
    return found.select("lang", "source", "item", (F.col("value") + rest).alias("value"))


def own_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: kept terms that a source uses more than its
    language.  Also needs n_lang of ``kept`` and lang_total of ``groups``."""
    p = share(F.col("n"), F.col("total"), F.col("n_kept"))
    q = share(F.col("n_lang"), F.col("lang_total"), F.col("n_kept"))
    found = kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"),
                                                         q.alias("q"))
    return found.filter(F.col("p") > F.col("q")).select("lang", "source", "item",
                                                        divergence(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of two parts: ``pair``,
    the divergence of a source from each other source of its language, and
    ``term``, its ``top`` own terms.  Ranks run from 1 within a group and part
    by value, largest first, ties by item in the order of its bytes.

    Nulls in any of the three columns count as empty strings, so an empty
    language or source is one like any other.  A row is a document, repeated
    rows too.  A language without kept terms has pairs of value 0; an empty
    table gives no row.  Other columns are not read."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    terms = counts.filter(F.col("term") != "")
    kept_terms = stored(terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"))
                        .filter(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    kept = stored(terms.drop("docs").join(kept_terms, ["lang", "term"]), "kept-counts")
    languages = (counts.filter(F.col("term") == "").groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
                 .join(kept_terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_kept"),
                                                      F.sum("n_lang").alias("lang_total")), "lang", "left"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(counts.filter(F.col("term") == "").select("lang", "source").join(languages, "lang")
                    .join(totals, ["lang", "source"], "left").fillna(0, ["n_kept", "lang_total", "total"]), "groups")
    order = [F.col("value").desc(), F.col("item").asc()]
    in_part = F.row_number().over(Window.partitionBy("lang", "source", "salt").orderBy(*order))
    in_group = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    first = (own_terms(kept, groups).withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALT)))
             .withColumn("rank", in_part).filter(F.col("rank") <= top).drop("rank", "salt"))
    listed = first.withColumn("rank", in_group).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    pairs = source_pairs(kept, groups).withColumn("rank", in_group).withColumn("part", F.lit("pair"))
    return pairs.unionByName(listed).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t
  FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (
  SELECT w.lang, w.source, w.term, count(*) AS n
  FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY ALL),
tot AS (SELECT lang, source, sum(n) AS total FROM cnt GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + ({BILLION}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v))::BIGINT AS p,
         (1 + ({BILLION}::HUGEINT * (k.n + 1)) // (l.total + l.v))::BIGINT AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN tot t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN cnt c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k FROM rows)
SELECT lang, source, part, item, value, k::INTEGER AS rank FROM ranked WHERE part = 'pair' OR k <= {TOP}
"""
