"""Token counts of flat token files by a separator scan (operator 6).

A token file is a plain run of 16-bit (or 32-bit) little-endian ids in which
an end-of-document id follows each document; there is no index.  Files are cut
into byte ranges, which are dealt over the tasks and read there, so that a file
of any size is spread; a range is cut into blocks of ``BLOCK`` ids.  Each block
is searched for the separator with one vectorised comparison and reports only
its size and the places of its separators.  A prefix scan over a file's blocks (running sums of ids and
separators, running maximum of the last separator's place) gives every
document its number and start, also where it spans blocks.  It runs in two
levels, within runs of ``RUN`` blocks and over the runs, and orders four
numbers a block, neither ids nor places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

#: ids per block
BLOCK = 1 << 20
#: bytes that are read at once, about; bytes of ids in a row of a written file, at least; rows in a written file
RANGE, ROW_BYTES, FILE_ROWS = 32 << 20, 1 << 20, 256
#: bytes of ranges per task, about
TASK_BYTES = 64 << 20
#: block numbers whose sizes are summed together
RUN = 4096


def write_token_files(docs: DataFrame, path: str, model_file: str, text_col: str = "text", eod: int = 2) -> None:
    """Encode the texts with a SentencePiece model of at most 65,536 ids and
    write flat files of 16-bit ids, ``eod`` after each document.

    Spark's text writer puts the bytes there, with the separator as its line
    end, so any file system that Spark writes to will do.  It takes separators
    whose bytes are characters, as those of small ids are.  A null text is an
    empty document.  A partition's file goes on in another one after
    ``FILE_ROWS`` rows; each ends with a document."""
    if eod > 127:
        raise ValueError("the separator's bytes must be ASCII characters")
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([eod], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        encoder = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        if encoder.get_piece_size() > 1 << 16:
            raise ValueError("the model has ids of more than 16 bits")
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], ["ids"])
        held, size = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 32):
                texts = [t or "" for t in batch.column(0).slice(k, 32).to_pylist()]
                for ids in encoder.encode(texts, num_threads=1):
                    held.append(np.array(ids, "<u2").tobytes())
                    size += len(held[-1]) + len(end)
                    if size >= ROW_BYTES:  # a row of the file holds some documents
                        yield row()
                        held, size = [], 0
        if held:
            yield row()
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", end.decode()).option(
        "maxRecordsPerFile", FILE_ROWS).text(path)


def _opened(path: str):
    """A file as ``binaryFile`` names it, opened for reading at any place."""
    if path.startswith("file:"):
        return pa.OSFile("/" + path[5:].lstrip("/"))
    from pyarrow.fs import FileSystem
    system, name = FileSystem.from_uri(path)
    return system.open_input_file(name)


def _ranges(files: DataFrame, step: int) -> DataFrame:
    """path, length, offset and size of byte ranges, dealt over tasks by the
    bytes of all files."""
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    offset = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(step).cast("bigint")))
    parts = files.filter("length > 0").select("path", "length", offset.alias("offset")).repartition(tasks)
    return parts.withColumn("size", F.least(F.lit(step), F.col("length") - F.col("offset")))


def scan_blocks(files: DataFrame, eod: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """file, block, n_ids and seps (places of separators in the block) of
    rows of files: path and length, or path and content."""
    width = np.dtype(dtype).itemsize
    step = block * width * max(1, RANGE // (block * width))

    def blocks(path: str, raw, first: int) -> Iterator[pa.RecordBatch]:
        ids = np.frombuffer(raw, dtype)
        found = [(first + k // block, ids[k:k + block]) for k in range(0, len(ids), block)]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(found), pa.string()),
                 pa.array([b for b, _ in found], pa.int64()), pa.array([len(x) for _, x in found], pa.int64()),
                 pa.array([np.flatnonzero(x == eod) for _, x in found], pa.list_(pa.int64()))],
                ["file", "block", "n_ids", "seps"])

    def check(path: str, size: int) -> None:
        if size % width:
            raise ValueError(f"{path} is no whole number of ids")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                raw = content.as_buffer()
                if raw is not None:
                    check(path.as_py(), raw.size)
                    yield from blocks(path.as_py(), raw, 0)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, offset, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                check(path, length)
                with _opened(path) as f:
                    f.seek(offset)
                    raw = f.read(size)
                if len(raw) != size:
                    raise ValueError(f"{path} is shorter than it was")
                yield from blocks(path, raw, offset // width // block)
    schema = "file string, block bigint, n_ids bigint, seps array<bigint>"
    if "content" in files.columns:
        return files.select("path", "content").mapInArrow(whole, schema)
    return _ranges(files, step).mapInArrow(ranges, schema)


def token_counts(files: DataFrame, eod: int = 2, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """One row per document: file, doc_no (from 0 within the file), start
    (place of its first id), n_tokens (without the separator) and closed
    (whether a separator ends it; ids after a file's last separator are one
    more document that is not closed).

    Neighbouring separators enclose an empty document.  An empty file has no
    documents, an empty table of files no rows."""
    return stitched(scan_blocks(files, eod, dtype, block))


def stitched(blocks: DataFrame) -> DataFrame:
    """Documents of the blocks of each file, in the order of their numbers.

    The blocks are written and read again.  The scan orders their sizes only,
    in two levels: within runs of ``RUN`` block numbers, then over the runs of
    a file; the separators meet the sums by block number."""
    blocks = stored(blocks, "blocks")
    at = blocks.select("file", "block", (F.col("block") - F.pmod("block", F.lit(RUN))).alias("run"), "n_ids",
                       F.size("seps").cast("bigint").alias("n_seps"), F.array_max("seps").alias("last"))
    own = Window.partitionBy("file", "run").orderBy("block")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("offset", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    at = at.withColumn("last", F.col("offset") + F.col("last"))
    at = at.withColumns({"doc": F.coalesce(F.sum("n_seps").over(before), F.lit(0)),
                         "open": F.max("last").over(before) + 1, "ends_run": F.lead("block").over(own).isNull()})
    runs = at.groupBy("file", "run").agg(F.sum("n_ids").alias("ids"), F.sum("n_seps").alias("n_seps"),
                                         F.max("last").alias("last"))
    all_runs = Window.partitionBy("file").orderBy("run")
    before = all_runs.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_offset", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    runs = runs.withColumn("last", F.col("run_offset") + F.col("last"))
    runs = runs.select("file", "run", "run_offset", F.coalesce(F.sum("n_seps").over(before), F.lit(0)).alias("run_doc"),
                       F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("run_open"),
                       F.lead("run").over(all_runs).isNull().alias("ends_file"))
    at = at.join(runs, ["file", "run"]).select(
        "file", "block", (F.col("offset") + F.col("run_offset")).alias("offset"),
        (F.col("doc") + F.col("run_doc")).alias("doc"),
        F.coalesce(F.col("open") + F.col("run_offset"), F.col("run_open")).alias("open"),
        (F.col("ends_run") & F.col("ends_file")).alias("final"))
    at = blocks.join(at, ["file", "block"])
    # the end of the file closes what is left after its last separator
    at = at.withColumn("ends", F.when(F.col("final"), F.concat("seps", F.array("n_ids"))).otherwise(F.col("seps")))
    docs = at.select("file", "doc", "offset", "open", "seps", F.col("n_ids"), F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(
        F.col("offset") + F.try_element_at("seps", F.col("i")) + 1)
    docs = docs.select("file", (F.col("doc") + F.col("i")).alias("doc_no"), start.alias("start"),
                       (F.col("offset") + F.col("end") - start).alias("n_tokens"),
                       (F.col("i") < F.size("seps")).alias("closed"))
    return docs.filter("closed or n_tokens > 0")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the files, whose ranges the tasks read; also content,
    whole, where only Spark can open them."""
    files = spark.read.format("binaryFile").load(path)
    names = files.select("path", "length")  # no content is read for these
    some = names.filter("length > 0").limit(1).collect()
    try:
        for r in some:
            _opened(r["path"]).close()
    except (OSError, ValueError, pa.ArrowException):
        return files
    return names


def document_token_counts(docs: DataFrame, model_file: str, eod: int = 2) -> DataFrame:
    """Write the documents as flat token files below the shared checkpoint
    folder and count each document's ids by scanning them: file_no, doc_no,
    start, n_tokens.  The files of one partition are counted as one."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-tokens")
    write_token_files(docs, path, model_file, eod=eod)
    blocks = scan_blocks(read_token_files(spark, path), eod)
    name = lambda group: F.regexp_extract("file", r"part-(\d+).*-c(\d+)[^/]*$", group)
    blocks = blocks.select(name(1).alias("file"), (name(2).cast("bigint") * (1 << 32) + F.col("block")).alias("block"),
                           "n_ids", "seps")
    return stitched(blocks).select(F.col("file").cast("int").alias("file_no"), "doc_no", "start", "n_tokens")
