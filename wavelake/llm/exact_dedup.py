"""Exact dedup by content-defined chunk recipes (operator 4, built-ins only).

A normalised text (A-Z in lower case) is cut into chunks where its content
says so: after a line end or full stop at least ``LEAST`` characters into the
chunk, at a blank if there is none within ``MOST``, else after ``MOST``.  Equal
texts have equal chunks, and a shared passage has mostly equal ones.

1. Chunks are deduplicated: grouped by fingerprint *and* content, combined on
   the map side, so each task moves a chunk once, however many copies it has.
   The grouping compares the bytes.  A fingerprint that names one chunk only
   is a verified identifier; chunks that collide get a rank of their own.
2. A document's recipe is the ordered list of its identifiers, computed where
   the text is read.  Documents are equal if and only if their recipes are.
   From here on only recipes move, never texts.
3. Recipes are grouped (partial aggregates: a group of copies is combined
   before the shuffle).  Groups of two or more are written, and their kept id
   is joined back to the rows; the written side has no partitioning that the
   join must keep, so that Spark can split a hot recipe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

LEAST, MOST = 512, 2048
#: the shortest prefix of at least LEAST characters that ends a line or
#: sentence within MOST, or up to the last blank there, or all there is
CHUNK = rf"(?s).{{{LEAST},{MOST}}}?[\n.]|.{{{LEAST},{MOST}}} |.{{1,{MOST}}}"


def chunk_fingerprint(chunk: Column) -> Column:
    """128 bits: two 64-bit hashes of the chunk (the second over a prefixed
    text)."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit("\x01"), chunk).alias("b"))


def recipes(docs: DataFrame, id_col: str, text_col: str,
            fingerprint: Callable[[Column], Column] = chunk_fingerprint) -> DataFrame:
    """doc_id, text_sha256, text_key and recipe per row; the recipe lists the
    verified identifiers (fingerprint, rank among colliding chunks)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("raw"))
    base = base.select("doc_id", "raw", ascii_lower(F.col("raw")).alias("text"))
    chunks = F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    distinct = (base.select(F.explode(chunks).alias("chunk"))
                .select(fingerprint(F.col("chunk")).alias("f"), "chunk").distinct())
    collided = stored(distinct.groupBy("f").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("f"), "collided")
    rows = base.select("doc_id", F.xxhash64("raw").alias("text_key"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), chunks.alias("chunks"))
    if collided.isEmpty():  # every fingerprint is verified: no text moves again
        return rows.select("doc_id", "text_key", "text_sha256", F.transform(
            "chunks", lambda c: F.struct(fingerprint(c).alias("f"), F.lit(0).alias("rank"))).alias("recipe"))
    # colliding chunks are ranked by content; only documents that hold one of
    # their fingerprints are taken apart and put together again
    by_content = Window.partitionBy("f").orderBy("c")
    ranks = distinct.withColumnRenamed("chunk", "c").join(collided, "f").withColumn(
        "rank", F.row_number().over(by_content))
    whole = stored(rows.withColumn("row", F.monotonically_increasing_id()), "chunked")
    parts = whole.select("row", F.posexplode("chunks").alias("pos", "c")).withColumn("f", fingerprint(F.col("c")))
    parts = parts.join(ranks, ["f", "c"], "left").select(
        "row", F.struct("pos", F.struct("f", F.coalesce("rank", F.lit(0)).alias("rank")).alias("id")).alias("p"))
    lists = parts.groupBy("row").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return whole.join(lists, "row", "left").select(
        "doc_id", "text_key", "text_sha256",
        F.coalesce(F.col("p.id"), F.array().cast(lists.select("p.id").schema[0].dataType)).alias("recipe"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     fingerprint: Callable[[Column], Column] = chunk_fingerprint) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest id of the equal texts),
    group_size, kept, text_sha256 (of the normalised text) and text_key (hash
    of the text as it is).

    A null text counts as empty, and empty texts are equal to each other.
    Rows without an id count in group_size; they are kept only if no row of
    their group has an id.  Rows that repeat the kept id are one document and
    all read kept.  Other columns are not read."""
    own = stored(recipes(docs, id_col, text_col, fingerprint), "recipes")
    groups = own.groupBy("recipe").agg(F.max("doc_id").alias("largest"), F.count(F.lit(1)).alias("n"))
    copies = stored(groups.filter("n > 1"), "copies")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("largest"))
    return own.join(copies, "recipe", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", "text_key")


ORACLE_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""
