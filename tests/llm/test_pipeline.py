import hashlib

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wavelake.llm.decontaminate import words

from .helpers import ODD, documents, prose
from .test_simhash import plain_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_run(rows, bench):
    """What the stages leave, by loops: ids and texts."""
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    last = {}
    for d, t in rows:
        last[t.translate(LOWER)] = max(d, last.get(t.translate(LOWER), d))
    rows = [(d, t) for d, t in rows if last[t.translate(LOWER)] == d]
    stays = {d for d, _, c in plain_components(rows) if d == c}
    rows = [(d, t) for d, t in rows if repr(d) in stays]
    windows = {tuple(w[k:k + 10]) for w in map(words, bench) if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    return [(d, t) for d, t in rows if not any(tuple(w[k:k + n]) in windows for w in [words(t)] for n in sizes
                                               for k in range(len(w) - n + 1))]


def test_stages_have_their_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup",
                                                     "benchmark decontamination", "BPE encoding and decoding"]


def test_run_matches_plain_loops(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    lib, want = Tokenizer.from_file(f"{corpus_pipeline.TOKENIZERS}/byte_bpe_50k.json"), []
    for d, t in plain_run(docs, bench):
        ids = lib.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(got) == sorted(want) and 0 < len(got) < len(docs)


def test_stages_keep_columns_on_odd_rows(spark, sf):
    base = prose(51, 8)
    upper = base[0].translate({v: k for k, v in LOWER.items()})
    rows = [*enumerate([*base, upper, base[1] + "!", *ODD])] + [(None, base[2]), (None, None), (3, base[3])]
    docs = documents(spark, rows).withColumn("text_key", F.lit(1)).withColumn("score", F.lit("s"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema.simpleString() == docs.schema.simpleString()
        left = out.collect()
        assert left and len(left) < len(rows) or stage is corpus_pipeline.decontamination
        assert stage(spark, docs.limit(0), sf).collect() == []
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.exact_dedup_stage(spark, docs, sf).collect()}
    assert (0, base[0]) not in kept and (8, upper) in kept and (2, base[2]) in kept and (None, base[2]) not in kept


def test_exact_dedup_drops_null_texts_that_op4_marks(spark):
    docs = documents(spark, [(1, None), (2, None), (3, ""), (4, "a"), (5, "A"), (6, None)])
    left = corpus_pipeline.exact_dedup_stage(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == [5, 6]


def test_run_releases_what_no_later_stage_reads(spark, sf, monkeypatch):
    """While stages run scratch shrinks again; the last input alone is left."""
    from wavelake import scratch
    from wavelake.session import path_exists
    copies, alive, write = [], [], scratch.write

    def seen(df, name, *args, **options):
        copies.append(write(df, name, *args, **options))
        alive.append(sum(c.alive for c in copies))
        return copies[-1]
    monkeypatch.setattr(scratch, "write", seen)
    rows = corpus_pipeline.run(spark, sf)
    assert max(alive) < len(copies) and any(b < a for a, b in zip(alive, alive[1:]))
    left = [c for c in copies if c.alive]
    assert len(left) == 1 and path_exists(spark, left[0].path)
    assert not any(path_exists(spark, c.path) for c in copies if not c.alive)
    assert rows.count() == left[0].df.count()
