import glob
import re
import os

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from wavelake.llm import token_files

from .helpers import ODD, documents, prose

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def write(tmp_path, **files):
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    return str(tmp_path)


def result(df):
    return sorted((os.path.basename(r.file), r.doc_no, r.start, r.n_tokens, r.closed) for r in df.collect())


def plain(files, eod):
    out = []
    for name, ids in files.items():
        start = doc = 0
        for k, x in enumerate([*ids, eod]):
            if x == eod:
                if k < len(ids) or k > start:
                    out.append((name, doc, start, k - start, k < len(ids)))
                start, doc = k + 1, doc + 1
    return sorted(out)


@pytest.mark.parametrize("block, run", [(1, 5), (3, 4), (7, 2), (7, 1), (7, 4096), (1 << 20, 4096)])
def test_boundaries_are_stitched_across_blocks(spark, tmp_path, monkeypatch, block, run):
    monkeypatch.setattr(token_files, "RUN", run)
    rng = np.random.default_rng(5)
    files = {"a": rng.integers(0, 4, 200).tolist(), "b": [2], "c": [5] * 50, "d": [5] * 20 + [2], "e": [2, 2, 2, 9],
             "f": [], "g": [0x0200, 0x0002, 0x0002, 0x0200, 7, 2]}
    df = token_files.read_token_files(spark, write(tmp_path, **files))
    assert result(token_files.token_counts(df, 2, block=block)) == plain(files, 2)


def test_written_documents_have_their_token_counts(spark, tmp_path):
    texts = [*prose(41, 300), *ODD]
    docs = documents(spark, list(enumerate(texts)))
    encoder = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted(len(encoder.encode(t or "")) for t in texts)
    got = token_files.document_token_counts(docs, MODEL).collect()
    assert sorted(r.n_tokens for r in got) == want
    # in the order of each file, ids and all
    path = str(tmp_path / "flat")
    token_files.write_token_files(docs.coalesce(1), path, MODEL)
    (file,) = glob.glob(f"{path}/part-*")
    flat = np.fromfile(file, "<u2").tolist()
    assert flat == [i for t in texts for i in [*encoder.encode(t or ""), 2]]


def test_broken_files_and_empty_tables(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number"):
        token_files.token_counts(token_files.read_token_files(spark, str(tmp_path))).collect()
    none = spark.range(0).select(F.lit("p").alias("path"), F.lit(b"").alias("content"))
    assert token_files.token_counts(none).collect() == []
    assert token_files.document_token_counts(documents(spark, []), MODEL).collect() == []
    with pytest.raises(ValueError):
        token_files.write_token_files(documents(spark, []), str(tmp_path / "x"), MODEL, eod=50256)


def test_a_file_is_dealt_over_tasks_and_stitched(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE", 64)
    rng = np.random.default_rng(6)
    files = {"a b%20": rng.integers(0, 9, 1000).tolist(), "c": [5] * 300, "d": [2]}
    rows = token_files.read_token_files(spark, write(tmp_path, **files))
    assert "content" not in rows.columns
    blocks = token_files.scan_blocks(rows, 2, block=8)
    tasks = blocks.filter("file like '%a b%'").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1 and result(token_files.token_counts(rows, 2, block=8)) == plain(files, 2)
    # a file with a hole, larger than a whole row may be
    with open(tmp_path / "c", "wb") as f:
        f.truncate((2 << 30) + 64)
        f.seek(1 << 31)
        f.write(np.array([2, 7], "<u2").tobytes())
    monkeypatch.setattr(token_files, "RANGE", 32 << 20)
    large = token_files.read_token_files(spark, str(tmp_path / "c"))
    assert result(token_files.token_counts(large)) == [("c", 0, 0, 1 << 30, True), ("c", 1, (1 << 30) + 1, 31, False)]


def test_no_places_pass_a_window(spark, tmp_path):
    rows = token_files.read_token_files(spark, write(tmp_path, a=[1, 2, 3] * 50))
    plan = token_files.token_counts(rows, 2, block=8)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    windows = re.findall(r"\) Window\n(Input[^\n]*)\n", plan)
    assert len(windows) >= 2 and not any(re.search(r"\b(seps|ends)#", w) for w in windows)
    assert all("run#" in w for w in windows)


def test_written_files_are_rolled(spark, tmp_path, monkeypatch):
    texts = prose(42, 300)
    docs = documents(spark, list(enumerate(texts))).coalesce(1)
    want = sorted(tuple(r) for r in token_files.document_token_counts(docs, MODEL).collect())
    monkeypatch.setattr(token_files, "ROW_BYTES", 100)
    monkeypatch.setattr(token_files, "FILE_ROWS", 10)
    token_files.write_token_files(docs, str(tmp_path / "flat"), MODEL)
    assert len(glob.glob(f"{tmp_path}/flat/part-*")) > 3
    assert sorted(tuple(r) for r in token_files.document_token_counts(docs, MODEL).collect()) == want
