"""Land a wide, all-string bronze wave as columnar Parquet, once.

A questionnaire wave is a wide CSV (hundreds of columns) and each silver
table needs a different subset of them.  Reading the CSV once per silver
table would scan the whole text three times.  ``land`` writes it once as
Parquet and every later read is pruned to the columns it uses.

Parquet forbids some characters that questionnaire headers contain (spaces,
commas, parentheses), so columns are stored under positional names and the
original headers are restored on read with ``toDF``: the headers themselves
travel with the path as a small JSON file written by the driver, never rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..session import read_text, write_text

HEADERS_FILE = "_headers.json"


def _slot(i: int) -> str:
    return f"c{i:05d}"


def land(df: DataFrame, path: str, partition_cols: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` (any column names) as Parquet at ``path`` and return the
    landed table with the original column names."""
    spark = df.sparkSession
    headers = list(df.columns)
    stored = df.toDF(*[_slot(i) for i in range(len(headers))])
    parts = [_slot(headers.index(c)) for c in partition_cols]
    writer = (stored.hint("rebalance", *parts) if parts else stored).write.mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    write_text(spark, f"{path.rstrip('/')}/{HEADERS_FILE}", json.dumps(headers, ensure_ascii=False))
    return read_landed(spark, path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    headers = json.loads(read_text(spark, f"{path.rstrip('/')}/{HEADERS_FILE}"))
    df = spark.read.parquet(path)
    by_slot = {_slot(i): h for i, h in enumerate(headers)}
    # partition columns come back last; map every stored column to its header
    return df.toDF(*[by_slot[c] for c in df.columns])
