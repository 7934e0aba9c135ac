"""SimHash near-duplicates by BK-trees (operator 1).

1. One pass computes a 64-bit fingerprint per text; equal fingerprints are
   collapsed by a map-side combined aggregate (a group of copies of any size
   becomes one row).
2. Distinct fingerprints are cut into ``PARTS`` bit fields.  Two that differ
   in at most ``max_bits`` = 3 bits agree on at least ``PARTS - 3`` = 2 whole
   fields, so they meet in the shard named by these two fields' values; there
   are C(5, 2) = 10 such pairs of fields.  Only shards of two or more
   fingerprints go on.
3. A shard of over ``SHARD`` fingerprints is dealt into blocks.  Each block's
   tree is sent to every block of the shard (block pairs i <= j), so that no
   task holds a hot shard and no pair is missed.  The trees are sent by a
   shuffle on the shard's key: their total grows with the corpus, hence no
   broadcast variable has a proven bound.
4. A task builds the BK-trees of its shards as one forest in arrays: a node's
   children stand side by side, ordered by the integer Hamming distance to
   the parent.  All queries walk it level by level and follow only edges in
   [d - r, d + r].
5. A shard reports each fingerprint's smallest linked one, not all pairs.
   Components of these links come from alternating large-star and small-star
   rounds, each written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

SHINGLE = 3
MAX_BITS = 3
PARTS = 5
SHARD = 4096
#: pairs of query and tree node that a task holds at once
FRONTIER = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if set in over half of the shingles' XXH64 (seed 42)."""
    if not text:
        return 0
    raw = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not raw:
        return 0
    gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    if len(gaps) < shingle:  # the whole sequence is the only shingle
        return xxhash.xxh64_intdigest(raw, 42)
    digest = xxhash.xxh64_intdigest
    begin = [0, *(gaps[:len(gaps) - shingle + 1] + 1).tolist()]
    end = [*gaps[shingle - 1:].tolist(), len(raw)]
    h = np.array([digest(raw[a:b], 42) for a, b in zip(begin, end, strict=True)], "<u8")
    ones, block = np.zeros(64, np.int64), 1 << 16
    for k in range(0, len(h), block):  # bit 8 * i + j is bit j of byte i
        ones += np.unpackbits(h[k:k + block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (as a signed 64-bit number) and a hash of the text
    per row."""
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fp)], ["doc_id", "text_hash", "fp"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    return map_batches(rows, fn, "doc_id bigint, text_hash bigint, fp bigint")


class BKForest:
    """BK-trees over fingerprints, one per value of ``tree``, in flat arrays.

    Built level by level: of the fingerprints below a node, the first with
    each distance to the node becomes the child on that edge, the others go
    below that child."""

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        order = np.argsort(tree, kind="stable")
        self.values, self.item = np.zeros(len(values), np.uint64), np.zeros(len(values), np.int64)
        first = np.concatenate([[True], tree[order][1:] != tree[order][:-1]])
        self.trees = tree[order][first]
        self.roots = np.arange(len(self.trees))
        self.child_from = np.zeros(len(values), np.int64)
        self.child_to = np.zeros(len(values), np.int64)
        self.edge = np.zeros(len(values), np.int64)
        n = len(self.roots)
        self.item[:n] = order[first]
        self.values[:n] = values[order[first]]
        rest, below = order[~first], (np.cumsum(first) - 1)[~first]
        while len(rest):
            d = np.bitwise_count(values[rest] ^ self.values[below]).astype(np.int64)
            by = np.lexsort((d, below))
            rest, below, d = rest[by], below[by], d[by]
            new = np.concatenate([[True], (below[1:] != below[:-1]) | (d[1:] != d[:-1])])
            node = n + np.cumsum(new) - 1
            at = np.arange(n, n + int(new.sum()))
            self.item[at], self.edge[at] = rest[new], d[new]
            self.values[at] = values[rest[new]]
            parent = below[new]
            self.child_to[parent] = at + 1  # children of one parent stand side by side
            head = np.concatenate([[True], parent[1:] != parent[:-1]])
            self.child_from[parent[head]] = at[head]
            n += len(at)
            rest, below = rest[~new], node[~new]
        self.heavy = self.child_to - self.child_from

    def search(self, queries: np.ndarray, tree: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) pairs within ``radius``, in pieces of bounded size."""
        at = np.minimum(np.searchsorted(self.trees, tree), len(self.trees) - 1)
        known = np.flatnonzero(self.trees[at] == tree) if len(self.trees) else np.zeros(0, np.int64)
        todo = [(known, self.roots[at[known]])]
        while todo:
            q, node = todo.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                todo += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            if not len(q):
                continue
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], self.item[node[hit]]
            inner = self.heavy[node] > 0
            q, node, d = q[inner], node[inner], d[inner]
            step = max(1, FRONTIER // 64)  # a node has at most 64 children
            for k in range(0, len(q), step):
                n = self.heavy[node[k:k + step]]
                child = np.repeat(self.child_from[node[k:k + step]] - np.concatenate([[0], np.cumsum(n)[:-1]]),
                                  n) + np.arange(n.sum())
                near = np.abs(self.edge[child] - np.repeat(d[k:k + step], n)) <= radius
                todo.append((np.repeat(q[k:k + step], n)[near], child[near]))


def _smallest_linked(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Label of each item: the smallest item linked to it, over all pieces."""
    label = np.arange(size)
    for a, b in pairs:
        a, b = a[a != b], b[a != b]
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                break
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def shard_links(batch: pa.Table, radius: int) -> pa.RecordBatch:
    """Links of the shards in ``batch`` (columns shard, fp, tree): the trees
    hold the rows marked ``tree``, and all rows query them."""
    fp = batch.column("fp").to_numpy().view(np.uint64)
    _, shard = np.unique(batch.column("shard").to_numpy(), return_inverse=True)
    in_tree = np.flatnonzero(batch.column("tree").to_numpy(zero_copy_only=False))
    forest = BKForest(fp[in_tree], shard[in_tree])
    # items in the order of their value, so that a label is the smallest value
    order = np.argsort(fp, kind="stable")
    place = np.empty(len(fp), np.int64)
    place[order] = np.arange(len(fp))
    pairs = ((place[q], place[in_tree[t]]) for q, t in forest.search(fp, shard, radius))
    label = _smallest_linked(len(fp), pairs)
    moved = np.flatnonzero(label != np.arange(len(fp)))
    ordered = fp[order]
    a, b = ordered[moved].view(np.int64), ordered[label[moved]].view(np.int64)
    apart = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[apart]), pa.array(b[apart])], ["a", "b"])


def links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS, shard_size: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect
    all pairs of at most ``max_bits`` differing bits."""
    if not 0 <= max_bits < parts:
        raise ValueError("max_bits must be below parts")
    edges = [64 * i // parts for i in range(parts + 1)]
    fields = [F.shiftrightunsigned("fp", edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1)
              for i in range(parts)]
    kept = list(combinations(range(parts), parts - max_bits))
    shards = F.array(*[F.xxhash64(F.lit(k), *[fields[i] for i in c]) for k, c in enumerate(kept)])
    rows = distinct.select("fp", F.explode(shards).alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # the shard's size travels with its rows; AQE splits a hot key of this join
    rows = rows.join(shared, "key").withColumn("blocks", F.ceil(F.col("n") / shard_size).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int"))
    # block i is the tree of pairs (i, j >= i) and queries pairs (j <= i, i)
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("key", F.least("own", "with"), F.greatest("own", "with"))
    rows = rows.select(pair.alias("shard"), "fp", (F.col("own") <= F.col("with")).alias("tree"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the partition is sorted by shard: whole shards, about ROWS rows at once
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard").to_numpy()
            if held and count >= 4 * shard_size:
                last = held[-1].column("shard")[-1].as_py()
                cut = int(np.searchsorted(shard, last, "right")) if shard[0] <= last else 0
                if cut < len(shard):
                    yield shard_links(pa.Table.from_batches([*held, batch.slice(0, cut)]), max_bits)
                    held, count = [], 0
                    batch = batch.slice(cut)
            held.append(batch)
            count += batch.num_rows
        if held:
            yield shard_links(pa.Table.from_batches(held), max_bits)
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of each component: (node, root) for nodes other than the
    root.  Rounds of large-star and small-star; a round is two min-aggregates
    with map-side combine and two joins on a node, whose hot keys AQE splits."""
    def tally(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(edges.distinct(), "links")
    seen = tally(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every edge now points from the greater to the smaller node
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = stored(small.filter("a <> b").distinct(), "links")
        before, seen = seen, tally(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits),
    component_id, the smallest id reachable over links of at most
    ``max_bits`` differing bits, and text_hash (of the text as it is).

    A null, empty or blank text has fingerprint zero and is linked like any
    other.  Rows without an id take part; they never name a component, and a
    component of such rows only has a null id.  Repeated rows stay repeated.
    Other columns are not read; an empty table gives an empty result."""
    own = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(smallest, "root").select("fp", "component_id")
    return own.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash")
