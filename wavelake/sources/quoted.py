"""CSV whose quoted values hold line ends, read in splits like any other text.

Spark's ``multiLine`` reads each file in one task.  Here files are split.
Whether a line end is inside quotes depends on the quotes before it, so

1. the quotes of every split are counted, and their running sum over the
   splits of a file says which splits begin inside a value;
2. every split puts its lines together to records, given that state; they are
   written, since how files are split can change with the cluster and both
   passes must agree on it, which is tested;
3. a record that crosses splits has a piece in each; the pieces, at most two a
   split, are joined in order.

Quotes inside values must be doubled.  A record of a file whose quotes do not
pair up goes on to the end of the file, as in any reader.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import scope, store, write

RECORD = "file string, start bigint, place bigint, head boolean, whole boolean, record string"
#: passes that may meet other splits before giving up
TRIES = 3


def split_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file, start (of the split) and value of every line, in order within a
    split.  Only ``\\n`` ends a line: a ``\\r`` may belong to a value."""
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        "value")


def split_states(lines: DataFrame, quote: str) -> DataFrame:
    """file, start and whether the split begins inside a quoted value; a short
    row per split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def split_records(lines: DataFrame, quote: str, opened: Sequence[tuple[str, int]]) -> DataFrame:
    """Records of every split, numbered in it by ``place``.  Those that do not
    lie within the split (``whole`` is false) are pieces: ``head`` is true
    where the record began in an earlier one."""
    shared = lines.sparkSession.sparkContext.broadcast(frozenset(opened))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: tuple[str, int] | None = None
        held: list[str] = []       # lines of a record that is not closed yet
        place, head = 0, False     # records of the split so far; whether the held one began before it

        def out(rows: list[tuple[int, bool, bool, str]]) -> pa.RecordBatch:
            types = pa.int64(), pa.bool_(), pa.bool_(), pa.string()
            return pa.RecordBatch.from_arrays(
                [pa.array([split[0]] * len(rows), pa.string()), pa.array([split[1]] * len(rows), pa.int64()),
                 *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]],
                ["file", "start", "place", "head", "whole", "record"])
        for batch in batches:
            file, start, value = batch.columns
            n = len(batch)
            differs = np.ones(n, bool)
            differs[1:] = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(
                zero_copy_only=False)
            quotes = pc.count_substring(value, quote).to_numpy(zero_copy_only=False).astype(np.int64)
            edges = [*np.flatnonzero(differs).tolist(), n]
            for a, b in zip(edges, edges[1:], strict=False):
                if (file[a].as_py(), start[a].as_py()) != split:
                    if held:
                        yield out([(place, head, False, "\n".join(held))])
                    split = (file[a].as_py(), start[a].as_py())
                    held, place, head = [], 0, split in shared.value
                    open_ = head
                closed = (open_ + np.cumsum(quotes[a:b])) % 2 == 0
                if closed.all() and not held and not head:  # every line is a record
                    no, yes = pa.array(np.zeros(b - a, bool)), pa.array(np.ones(b - a, bool))
                    yield pa.RecordBatch.from_arrays(
                        [file.slice(a, b - a), start.slice(a, b - a), pa.array(np.arange(place, place + b - a)), no, yes,
                         value.slice(a, b - a)], ["file", "start", "place", "head", "whole", "record"])
                    place += b - a
                    continue
                rows, texts, at = [], value.slice(a, b - a).to_pylist(), 0
                for end in np.flatnonzero(closed).tolist():
                    held += texts[at:end + 1]
                    rows.append((place, head, not head, "\n".join(held)))
                    held, head, at, place = [], False, end + 1, place + 1
                held += texts[at:]
                open_ = not closed[-1]
                if rows:
                    yield out(rows)
        if held:
            yield out([(place, head, False, "\n".join(held))])
    return lines.mapInArrow(run, RECORD)


def joined_pieces(found: DataFrame) -> DataFrame:
    """Records from their pieces; each begins with a piece that is no head."""
    order = Window.partitionBy("file").orderBy("start", "place")  # one or two rows per split
    numbered = found.withColumn("n", F.sum(F.when(~F.col("head"), 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "place", "record")))  # the pieces of one record
    return numbered.groupBy("file", "n").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))


def _agreed_records(spark: SparkSession, paths: str | Sequence[str], quote: str) -> DataFrame:
    for _ in range(TRIES):
        with scope(spark) as own:
            lines = split_lines(spark, paths)
            states = store(split_states(lines, quote), "splits")
            # a short row per split that begins inside a value; the driver's own list of splits is longer
            opened = [(r["file"], r["start"]) for r in states.filter("inside").select("file", "start").collect()]
            found = write(split_records(lines, quote, opened), "records")
            # each split has a first record or piece
            strange = found.df.filter("place = 0").join(states, ["file", "start"], "left_anti")
            if strange.isEmpty():
                return own.keep(found).df
    raise RuntimeError("the files were split in another way each time; set spark.sql.leafNodeDefaultParallelism")


def read_quoted(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], options: Mapping[str, str]
                ) -> DataFrame:
    """The rows of CSV files with one header of ``columns``, all strings; read
    from a written copy of the records (see ``scratch``)."""
    found = _agreed_records(spark, paths, options["quote"])
    # the first record of a file is its header
    records = found.filter("whole AND NOT (start = 0 AND place = 0)").select("record").unionAll(
        joined_pieces(found.filter("NOT whole")).select("record"))
    fields = ", ".join(f"c{i} string" for i in range(len(columns)))
    kept = {k: v for k, v in options.items() if k not in ("header", "inferSchema", "encoding")}
    row = F.from_csv(F.regexp_replace("record", "\r$", ""), fields, {**kept, "multiLine": "true"})
    return (records.filter("record NOT IN ('', '\r')").select(row.alias("row"))
            .select(*[F.col("row").getField(f"c{i}").alias(c) for i, c in enumerate(columns)]))
