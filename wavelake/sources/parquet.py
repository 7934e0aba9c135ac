"""Wave-partitioned Parquet tables.

Layout: ``partitionBy(wave)``.  Before the write the rows are *rebalanced*
on the wave column (``REBALANCE`` hint): AQE keeps each wave's rows together
but splits a big wave over many tasks and files, instead of the
one-task-per-wave layout of a plain ``repartition(n, wave)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, file_names
from . import versions
from .versions import NULL_PARTITION


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("wave",),
                      mode: str = "overwrite", dynamic: bool = False) -> None:
    """``dynamic=False`` replaces the whole table (like a full rebuild);
    ``dynamic=True`` replaces only the partitions present in ``df``."""
    (df.hint("rebalance", *partition_cols).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .partitionBy(*partition_cols).parquet(path))


def replace_waves(df: DataFrame, path: str, wave: str, held: Iterable[int | None]) -> None:
    """Replace the partitions of the waves in ``held`` by the rows of ``df``
    and leave every other wave as it is.  A held wave without rows ends up
    without a partition.  For one table in place, without a commit; tables
    that change together are written by ``versions``."""
    spark = df.sparkSession
    folders = [f"{path.rstrip('/')}/{wave}={NULL_PARTITION if w is None else w}" for w in set(held)]
    before = {f: file_names(spark, f) for f in folders}
    write_partitioned(df, path, [wave], dynamic=True)
    for f in folders:
        if before[f] and file_names(spark, f) == before[f]:  # not replaced: no rows any more
            delete_path(spark, f)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned table; partition columns come back typed and last.
    A folder of published versions (see ``versions``) is read as last
    published."""
    found = versions.locate(spark, path)
    return versions.read_current(spark, *found) if found else spark.read.parquet(path)
