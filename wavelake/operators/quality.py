"""Quality checks as DataFrames a job can assert on (not console prints)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import safe_col
from ..sources.versions import NULL_PARTITION, Table
from .harmonize import union_waves


def row_counts(tables: Mapping[str, DataFrame], wave: str = "wave") -> DataFrame:
    """Rows per (table, wave) for several tables in one job: each table
    contributes only its wave column, the union is aggregated once."""
    parts = [df.select(F.lit(name).alias("table_name"), F.col(wave).alias(wave)) for name, df in tables.items()]
    return union_waves(parts).groupBy("table_name", wave).agg(F.count(F.lit(1)).alias("row_count"))


def recorded_counts(spark: SparkSession, tables: Mapping[str, Table], wave: str = "wave") -> DataFrame:
    """``row_counts`` of published tables as the tasks that wrote them counted
    (see ``versions.write_run``): a few rows per table, no scan."""
    rows = [(name, value, n) for name, t in tables.items() for value, n in t.rows.items()]
    return spark.createDataFrame(rows, "table_name string, value string, row_count bigint").select(
        "table_name", F.when(F.col("value") != NULL_PARTITION, F.col("value")).cast("int").alias(wave), "row_count")


def distribution(df: DataFrame, keys: Sequence[str], count_name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))


def sample(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows by a total order (a top-n sort: each task keeps n)."""
    return df.orderBy(*order).limit(n)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (empty after a correct dedupe)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


#: copies of a row that are laid out at once
_AT_ONCE = 1 << 16


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either frame that the other lacks, as often as it lacks them:
    ``a EXCEPT ALL b`` and ``b EXCEPT ALL a`` together, by one aggregate over
    both.  Where both are partitioned by some of their columns already, no row
    moves."""
    signed = a.select("*", F.lit(1).alias("_n")).unionByName(b.select("*", F.lit(-1).alias("_n")))
    found = signed.groupBy(*[safe_col(c) for c in a.columns]).agg(F.abs(F.sum("_n")).alias("_n")).filter("_n > 0")
    found = found.withColumn("_k", F.explode(F.expr(f"sequence(0L, (_n - 1) DIV {_AT_ONCE})")))
    found = found.withColumn("_k", F.explode(F.expr(f"sequence(1L, least({_AT_ONCE}L, _n - _k * {_AT_ONCE}))")))
    return found.select(*[safe_col(c) for c in a.columns])


def schema_check(df: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """Differences between ``df``'s schema and the expected (name, type)
    list, as rows (column, expected_type, actual_type, problem); empty when
    they agree.  Built from the schema only (metadata, no rows read)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = dict(expected)
    rows = []
    for name, typ in expected:
        if name not in actual:
            rows.append((name, typ, None, "missing"))
        elif actual[name] != typ:
            rows.append((name, typ, actual[name], "type"))
    rows += [(name, None, typ, "unexpected") for name, typ in actual.items() if name not in wanted]
    order = [n for n, _ in expected if n in actual]
    if not rows and order != [n for n in df.columns if n in wanted]:
        rows.append(("*", None, None, "order"))
    schema = "column string, expected_type string, actual_type string, problem string"
    return df.sparkSession.createDataFrame(rows, schema)
