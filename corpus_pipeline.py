"""Corpus pipeline: documents to token digests in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  ``run`` writes each result as Parquet
below the shared checkpoint folder and rereads it as the next one's input, so
that a lost executor never costs more than one stage, and releases what no
later stage reads.

Rows are told apart by id and text together: a stage's decision holds for all
rows that repeat both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake import scratch
from wavelake.llm import bpe, decontaminate, exact_dedup, langid, simhash
from wavelake.llm.common import stored, table
from wavelake.llm.queries import TOKENIZERS

#: columns that the stages add while they decide; no column of a table is named so
_ID, _TEXT = "__stage_id", "__stage_text"


def _without(docs: DataFrame, dropped: DataFrame, text: Column | None = None) -> DataFrame:
    """``docs`` without the rows whose (doc_id, hash of the text) is among
    ``dropped`` (columns _ID and _TEXT); null ids compare as equal.  ``text``
    is what the stage hashes, if not the column as it is."""
    marked = docs.withColumn(_TEXT, F.xxhash64("text" if text is None else text))
    # stored first, so that Spark knows its size and moves the texts only if it is large
    d = dropped.select(F.col(_ID).alias("__drop_id"), F.col(_TEXT).alias("__drop_text")).distinct()
    d = stored(d, "dropped")
    same = marked[_TEXT].eqNullSafe(d["__drop_text"]) & marked["doc_id"].cast("bigint").eqNullSafe(d["__drop_id"])
    return marked.join(d, same, "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language stay; ``und`` (null text or no
    letter) goes."""
    vocabulary = langid.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    model = langid.train(docs.filter(~langid.held_out()), vocabulary)
    if not model.languages:  # nothing to learn from: only what has no letter goes
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    # under other names, so that columns of the documents come through
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns)}
    found = langid.predict(docs.withColumnsRenamed(names), model, names["text"])
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select(*[F.col(n).alias(c) for c, n in names.items()])


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z the document with the largest id
    stays."""
    found = exact_dedup.exact_duplicates(docs)
    dropped = found.filter(~F.col("kept")).select(F.col("doc_id").alias(_ID), F.col("text_key").alias(_TEXT))
    return _without(docs, dropped, F.coalesce("text", F.lit("")))  # a null text counts as empty there


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id
    stays; a row without an id stays only in a component without any."""
    found = simhash.near_duplicates(docs)
    dropped = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    return _without(docs, dropped.select(F.col("doc_id").alias(_ID), F.col("text_hash").alias(_TEXT)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; the others stay as they are."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token and round-trip digests of what is left."""
    return bpe.encoding_report(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: language ID and BPE cannot be said in SQL; the test compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``.  What a stage wrote for
    itself goes when its result is written, and that result when the next one
    is; only the last input is left, for the reader of the rows."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch.scope(spark) as own:
            after = own.keep(scratch.write(stage(spark, docs, sf_dir), f"llm-{name.replace(' ', '-')}"))
        if before is not None:
            before.release()
        before, docs = after, after.df
    return STAGES[-1][1](spark, docs, sf_dir)
