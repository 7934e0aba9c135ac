"""Wide CSV waves: every field read as a string, header names kept verbatim.

An empty field, quoted or not, reads as NULL: the forms make no difference
between the two.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import safe_col
from ..operators.harmonize import union_waves
from ..session import first_line
from .quoted import read_quoted

#: headers read at once
READERS = 16

CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",   # no inference: types cannot drift between waves
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',            # "" inside a quoted field is one quote
    "multiLine": "false",
}
# outer spaces belong to the value
WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


class HeaderDrift(ValueError):
    """Files of one wave whose headers do not go together."""


def file_headers(spark: SparkSession, path: str | Sequence[str], options: Mapping[str, str] | None = None
                 ) -> dict[tuple[str, ...], list[str]]:
    """Files by their header.  The driver reads the first line of each file,
    ``READERS`` at a time, and no row; empty files are left out."""
    options = {**CSV_OPTIONS, **(options or {})}
    files = sorted(spark.read.text(path if isinstance(path, str) else list(path)).inputFiles())
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line:
            text = line.decode(options["encoding"]).removeprefix("\ufeff")
            if text.count(options["quote"]) % 2:
                raise HeaderDrift(f"{file}: the header holds a line end inside quotes")
            names = next(csv.reader([text], delimiter=options.get("sep", ","), quotechar=options["quote"]))
            found.setdefault(tuple(names), []).append(file)
    return found


def read_wave_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                  quoted_line_ends: bool = False, **options: str) -> DataFrame:
    """Read one wave, all columns as strings.

    With ``columns`` no header is looked at first; every file's header must
    carry these names in this order, or the read fails.  Without, the headers
    of all files are read: files with the same columns in another order are
    each read under their own header and united by name; files with other
    columns are refused by name (``HeaderDrift``).

    ``quoted_line_ends`` allows line ends inside quoted values (see
    ``quoted``); otherwise each line is a record."""
    options, paths = {**CSV_OPTIONS, **options}, path if isinstance(path, str) else list(path)
    if columns is not None and not quoted_line_ends:
        return _read(spark, paths, list(columns), False, options)
    headers = file_headers(spark, paths, options)
    if not headers:  # no file, or empty ones
        return spark.read.options(**options).csv(paths) if columns is None else _read(spark, paths, columns, False, options)
    first, files = next(iter(headers.items()))
    for header, other in headers.items():
        if columns is not None and header != tuple(columns):
            raise HeaderDrift(f"{other[0]} ({len(other)} files): the header is not {list(columns)[:10]}")
        if sorted(header) != sorted(first):
            raise HeaderDrift(f"{other[0]} ({len(other)} files) and {files[0]} ({len(files)} files) differ in columns "
                              f"{sorted(set(header) ^ set(first))[:10]}")
    if "" in first or len({c.lower() for c in first}) < len(first):  # Spark gives such columns names of its own
        if len(headers) > 1 or quoted_line_ends:
            raise HeaderDrift(f"{files[0]}: empty or repeated column names")
        return spark.read.options(**options).csv(paths)
    if len(headers) == 1:
        return _read(spark, paths, first, quoted_line_ends, options)
    return union_waves([_read(spark, f, h, quoted_line_ends, options).select(*[safe_col(c) for c in first])
                        for h, f in headers.items()])


def _read(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], quoted_line_ends: bool,
          options: Mapping[str, str]) -> DataFrame:
    if quoted_line_ends:
        return read_quoted(spark, paths, columns, options)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.options(**options).option("enforceSchema", "false").schema(schema).csv(
        paths if isinstance(paths, str) else list(paths))


def write_wave_csv(df: DataFrame, path: str, mode: str = "overwrite", quote_all: bool = False) -> None:
    """Write string columns as header CSV with the same quoting rules."""
    df.write.mode(mode).options(**WRITE_OPTIONS, quoteAll=str(quote_all).lower()).csv(path)
