"""Session helpers: a tuned SparkSession and a shared scratch folder.

Scratch data (CSV/Parquet round trips, lineage cuts) always goes below the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting
is missing *and* the session runs in local mode (tests, laptops) do we create
our own folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (about 100 TB of waves, ~1000 executors).  The
# shuffle starts wide and AQE coalesces each stage to ~256 MB partitions, so
# the big stages (line-level flags, dedupe) get tens of thousands of tasks
# while the aggregated ones shrink to a few.  Input splits of 512 MB keep
# scan tasks in the thousands.  Skew handling is on for joins and rebalanced
# writes; lost executors are tolerated by task/stage retries and by
# decommissioning that migrates shuffle blocks.
LARGE_SCALE_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "wavelake",
              shuffle_partitions: int | None = None, extra: dict | None = None,
              large_scale: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if large_scale:
        conf.update(LARGE_SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session; a folder of our own is created only for a
    local-mode session that has none (tests)."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return sc.getCheckpointDir() or found
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster job needs a shared folder")
    local = tempfile.mkdtemp(prefix="wavelake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.  All of a
    session's scratch lies in one folder of its own, which is deleted when
    the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        root = f"{checkpoint_dir(spark).rstrip('/')}/wavelake-scratch-{uuid.uuid4().hex[:12]}"
        fs, p = _fs(spark, root)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _SCRATCH[app] = root
    return f"{_SCRATCH[app]}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def file_names(spark: SparkSession, path: str) -> set[str]:
    """Names of the files in a folder; empty if there is no such folder."""
    fs, p = _fs(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such."""
    return sorted(file_names(spark, path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def first_line(spark: SparkSession, path: str, step: int = 4096) -> bytes | None:
    """The first line of a file, compressed or not, without its end; None if
    the file is empty."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)) if "%" in path else jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        stream = codec.createInputStream(stream) if codec is not None else stream
        data = b""
        while b"\n" not in data:
            more = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
                jvm.org.apache.commons.io.input.BoundedInputStream(stream, step)))
            data += more
            if len(more) < step:
                break
    finally:
        stream.close()
    return data.split(b"\n", 1)[0].rstrip(b"\r") if data else None


def concatenate(spark: SparkSession, files: list[str], target: str, most: int) -> None:
    """Put files one after another into a new file that replaces the folder of
    ``target``.  On a file system that appends whole files by their blocks
    (HDFS) nothing is copied; elsewhere the bytes pass a small buffer."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, _ = _fs(spark, files[0])
    size = sum(fs.getFileStatus(_fs(spark, f)[1]).getLen() for f in files)
    if size > most:
        raise ValueError(f"{size} bytes are too many for one file; export without single_file")
    goal, p = _fs(spark, target)
    goal.delete(p.getParent(), True)
    goal.mkdirs(p.getParent())
    if fs.getScheme() == goal.getScheme() == "hdfs" and len(files) > 1:
        rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(files) - 1)
        for i, f in enumerate(files[1:]):
            rest[i] = _fs(spark, f)[1]
        fs.concat(_fs(spark, files[0])[1], rest)
        fs.rename(_fs(spark, files[0])[1], p)
        return
    out = goal.create(p, True)
    try:
        for f in files:
            stream = fs.open(_fs(spark, f)[1])
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file in one step; False if the target exists already."""
    jvm = spark.sparkContext._jvm
    _, p = _fs(spark, source)
    _, q = _fs(spark, target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else
                                                                _fs(spark, source)[0].getUri(),
                                                                spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(p, q, options)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


__all__ = ["LARGE_SCALE_CONF", "get_spark", "checkpoint_dir", "concatenate", "first_line", "scratch_path", "path_exists", "file_names", "delete_path",
           "list_folder", "local_path", "read_text", "rename_new", "write_text"]
