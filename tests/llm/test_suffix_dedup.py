import hashlib
import random

import numpy as np
import pytest

from wavelake.llm import suffix_dedup

from .helpers import ODD, documents, prose


def plain(rows, length=100):
    """(id, bytes, removed, runs, digest) of each row, string by string."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((repr(doc), len(data), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus():
    rnd = random.Random(5)
    base = prose(2, 30)
    passage = base[0][:260]
    rows = [*base, *base[:5]]
    rows += [t[:k] + " " + passage + " " + t[k:] for t in prose(3, 25) for k in [rnd.randrange(len(t))]]
    rows += ["abc" * 200, "ab" * 400, passage[:99], passage[:100], passage[3:103], base[2] + base[2]]
    return list(enumerate([*rows, *ODD]))


def test_matches_string_by_string(spark):
    rows = [*corpus(), (None, prose(2, 1)[0])]
    assert result(suffix_dedup.removal_report(documents(spark, rows))) == plain(rows)


def test_many_buckets_hot_tokens_and_small_groups(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 2000)
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    monkeypatch.setattr(suffix_dedup, "MOST_RANGES", 5)
    monkeypatch.setattr(suffix_dedup, "GROUP", 3000)
    monkeypatch.setattr(suffix_dedup, "SENT", 50)
    monkeypatch.setattr(suffix_dedup, "BATCH", 2000)
    docs = documents(spark, corpus())
    router = suffix_dedup.place_splitters(suffix_dedup._numbered(docs, "doc_id", "text"), 100, 2000)
    assert router.hot and router.parts > 1 and router.buckets > 20
    found = suffix_dedup.remove_repeats(docs, bucket=2000).collect()
    want = {r[0]: r for r in plain(corpus())}
    for r in found:
        assert want[repr(r.doc_id)][4] == hashlib.sha256(r.kept).hexdigest()
        assert want[repr(r.doc_id)][2] == sum(s.stop - s.start for s in r.spans)


def test_rows_of_one_id_keep_one_copy(spark):
    text = prose(9, 1)[0]
    found = suffix_dedup.remove_repeats(documents(spark, [(4, text), (4, text), (4, text)])).collect()
    assert sorted(len(r.kept) for r in found) == [0, 0, len(text.encode())]


def test_multikey_quicksort_orders_rows():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 4, (9000, 5)).astype(np.uint64)
    assert (words[suffix_dedup.multikey_quicksort(words)] == words[np.lexsort(words.T[::-1])]).all()


def test_common_prefixes_are_exact():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 4000).astype(np.uint8).tobytes() + b"\0" * 50
    begin, at = np.arange(0, 3900), np.arange(40, 3940)
    for words, rows in ((suffix_dedup.suffix_symbols(data, at, at + 24, 24), [data[a:a + 24] for a in at]),
                        (suffix_dedup.context_symbols(data, begin, at, 24), [data[a - 24:a][::-1] for a in at])):
        order = suffix_dedup.multikey_quicksort(words)
        ranked = [rows[i] for i in order]
        assert ranked == sorted(ranked)
        want = [next((k for k in range(24) if x[k] != y[k]), 24) for x, y in zip(ranked, ranked[1:], strict=False)]
        assert suffix_dedup.common_prefixes(words, order).tolist() == want
        for width in (1, 9, 24):
            groups = suffix_dedup.classes(np.array(want), order, width)
            assert len(set(groups)) == len({r[:width] for r in rows})
            assert len({(g, r[:width]) for g, r in zip(groups, rows, strict=True)}) == len(set(groups))


def test_a_task_sends_a_hot_string_again_only_if_it_starts_earlier():
    text = prose(4, 1)[0].encode()[:100]
    router = suffix_dedup.Router([], {text[a:a + 24] for a in range(77)}, 1)
    sent = {}
    blocks = [list(suffix_dedup.collect_records([(doc, doc, text)], router, 100, sent)) for doc in (5, 7, 3)]
    columns = [suffix_dedup.unpack(own[0][1], 100)[0][5].tolist() for own in blocks]
    assert columns == [[100], [0], [100]]
    found = suffix_dedup.bucket_repeats([b for own in blocks for _, b in own], 100)
    assert sorted(found.T.tolist()) == [[5, 0, 1], [7, 0, 1]]


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    first, count, anchor = suffix_dedup.record_bounds(data, 100, 24)
    at = np.repeat(anchor, count) - np.arange(len(data) - 99)
    assert at.min() >= 0 and at.max() <= 76 and count.sum() == 2901
    moved = np.concatenate([rng.integers(97, 100, 777).astype(np.uint8), data])
    first, count, anchor = suffix_dedup.record_bounds(moved, 100, 24)
    assert (at == (np.repeat(anchor, count) - np.arange(len(moved) - 99))[777:]).all()


def test_empty_table_and_short_length(spark):
    assert suffix_dedup.removal_report(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents(spark, []), length=40)
