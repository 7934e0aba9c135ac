import numpy as np
import pyarrow as pa

from wavelake.llm import decontaminate
from wavelake.llm.decontaminate import FMIndex, words

from .helpers import ODD, documents, prose


def plain(rows, bench, window=10):
    phrases = {}
    for item, text in bench:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w = words(text)
        hit, items = [False] * len(w), set()
        for p, owners in phrases.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit[k:k + len(p)] = [True] * len(p)
                    items |= owners
        out.append((repr(doc), len(w), sum(hit), sorted(items)))
    return sorted(out)


def tables(spark):
    bench = [(i, t) for i, t in enumerate(prose(11, 12))] + [(20, "short item"), (21, "Short, ITEM"), (22, None), (23, ""),
                                                            (None, "a null id here"), (1, prose(11, 12)[1])]
    b = [t.split() for _, t in bench[:12]]
    texts = [*prose(12, 20), *[" ".join(["before", *w[3:15], "after", *w[2:14]]) for w in b],
             *[" ".join(w[:9]) for w in b], *[" ".join([*w, *w]) for w in b[:3]], "a SHORT? item!",
             "a null id here", "short item " * 50, *ODD]
    rows = [*enumerate(texts), (None, " ".join(b[0])), (7, texts[25]), (7, texts[25])]
    return rows, bench, documents(spark, rows), spark.createDataFrame(
        [(i, t, "x", 1) for i, t in bench], "item_id bigint, text string, n_words string, spans int")


def result(df):
    return sorted((repr(r.doc_id), r.n_words, sum(s.stop - s.start for s in r.spans), r["items"]) for r in df.collect())


def test_matches_scanning_and_blocks_agree(spark):
    rows, bench, docs, items = tables(spark)
    want = plain(rows, bench)
    assert result(decontaminate.contamination(docs, items)) == want
    assert result(decontaminate.contamination(docs, items, block_bytes=1500)) == want
    report = decontaminate.decontamination_report(docs, items).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_hit) for r in report) == sorted(w[:3] for w in want)
    assert all(r.contaminated == (r.n_hit > 0) for r in report)


def test_one_text_may_be_a_third_of_many_blocks(spark):
    rows, bench, docs, _ = tables(spark)
    many = [*bench, *[(1000 + k, bench[0][1]) for k in range(300)], (7000, " ".join(t for _, t in bench[:12]))]
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in many], "item_id bigint, text string, n_words string, "
                                  "spans int")
    blocks = [(t.value, last) for t, last in decontaminate._blocks(items, "item_id", "text", 10, 3000)]
    assert len(blocks) > 2 and [last for _, last in blocks] == [False] * (len(blocks) - 1) + [True]
    for block, _ in blocks:  # neither the copies nor a long item go to one block whole
        assert sum(len(i) for ids in block["items"] for i in ids) < 300 * 4
    assert result(decontaminate.contamination(docs, items, block_bytes=3000)) == plain(rows, many)


def test_equal_phrases_are_one_row_with_all_owners():
    text = " ".join(f"w{k}" for k in range(12))
    table = decontaminate.phrase_table([(text, ["a"]), (text + " z", ["b", "c"]), ("w1 w2", ["d"])], 10)
    assert len(table["matrix"]) == 5 and sorted(table["lengths"].tolist()) == [2, 10, 10, 10, 10]
    owners = sorted(table["unit"][a:b].tolist() for a, b in zip(table["begin"], table["begin"][1:], strict=False))
    assert owners == [[0, 1], [0, 1], [0, 1], [1], [2]]
    assert decontaminate.phrase_table([], 10)["matrix"].shape == (0, 10)


def test_shards_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["aaaa", None, "bbbb", "c" * 50, "dd", "", "e" * 9]})
    shards = [s.column("text").to_pylist() for s in decontaminate._shards(iter([batch, batch.slice(0, 0)]))]
    assert shards == [["aaaa", None, "bbbb"], ["c" * 50], ["dd", ""], ["e" * 9]]


def test_clean_keeps_rows_and_columns_as_they_are(spark):
    rows, bench, docs, items = tables(spark)
    clean = {w[0] for w in plain(rows, bench) if not w[2]}
    for size in (decontaminate.BLOCK_BYTES, 1500):
        left = decontaminate.clean(docs, items, block_bytes=size)
        assert left.columns == docs.columns and {repr(r.doc_id) for r in left.collect()} == clean
        assert left.exceptAll(docs).isEmpty()


def test_empty_tables(spark):
    _, _, docs, items = tables(spark)
    assert decontaminate.decontamination_report(docs.limit(0), items).collect() == []
    assert not [r for r in decontaminate.decontamination_report(docs, items.limit(0)).collect() if r.contaminated]


def test_index_finds_and_locates_every_occurrence():
    rng = np.random.default_rng(7)
    for text in (rng.integers(0, 4, 500), np.tile([1, 2, 0], 60), np.zeros(9, np.int64), np.array([3])):
        index = FMIndex(text)
        phrases = [rng.integers(1, 4, rng.integers(1, 7)) for _ in range(60)]
        matrix = np.zeros((60, 6), np.int64)
        for r, p in enumerate(phrases):
            matrix[r, 6 - len(p):] = p
        lo, hi = index.search(matrix, np.array([len(p) for p in phrases]))
        for p, a, b in zip(phrases, lo, hi, strict=True):
            want = [k for k in range(len(text) - len(p) + 1) if (text[k:k + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want
