"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import store

#: A-Z in lower case, every byte outside [0-9a-z\x80-\xff] a space
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, nothing else (``lower`` would also change other letters;
    it is used where the text is ASCII, because it is faster)."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` on every Arrow batch; batches without rows are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Lineage cut: written below the shared checkpoint folder and read back,
    so that a lost executor costs a reread, not a recomputation.  The copy
    belongs to the innermost ``scratch.scope``, else to the session."""
    return store(df, f"llm-{name}")


def values(column: pa.Array, step: int = 256) -> Iterator:
    """The values of an Arrow column; only ``step`` of them are Python objects
    at a time."""
    for k in range(0, len(column), step):
        yield from column.slice(k, step).to_pylist()
