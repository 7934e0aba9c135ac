"""Report export: header CSV, every value quoted (dashboard import format)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scope, write
from ..session import concatenate, delete_path, list_folder, write_text
from .csv import WRITE_OPTIONS, read_wave_csv

#: a report over this many bytes is no single file
SINGLE_FILE_BYTES = 1 << 30


def export_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Numbers are written in Spark's shortest text form (31.0, 75.1).  The
    files are numbered in the order of the partitions, so the parts of an
    ORDER BY result follow one another by name.

    With ``single_file`` they are put together to one file: by the file
    system where it can append blocks, else copied through a small buffer.  No
    task holds the result.  A result over ``SINGLE_FILE_BYTES`` fails before
    anything is replaced."""
    spark = df.sparkSession
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    options = {**WRITE_OPTIONS, "quoteAll": "true"}
    if not single_file:
        out.write.mode("overwrite").options(**options).csv(path)
        return
    with scope(spark):
        parts = write(out, "report", "csv", **{**options, "header": "false"})
        names = [n for n in list_folder(spark, parts.path) if n.startswith("part-")]
        head = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns) + "\n"
        delete_path(spark, f"{parts.path}/_SUCCESS")
        write_text(spark, f"{parts.path}/head", head)
        concatenate(spark, [f"{parts.path}/{n}" for n in ["head", *names]], f"{path.rstrip('/')}/part-00000.csv",
                    SINGLE_FILE_BYTES)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return read_wave_csv(spark, path)
