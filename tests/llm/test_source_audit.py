import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from wavelake.llm import source_audit

from .helpers import ODD, prose

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, term string, docs string, n int, "
          "p double, rank string, salt int, item string")


def docs(spark, rows):
    """Rows of (text, lang, source)."""
    return spark.createDataFrame([(i, *r, 1, "t", "d", 2, 0.5, "r", 3, "i") for i, r in enumerate(rows)], SCHEMA)


def terms(text):
    return [t for t in (text or "").encode().translate(source_audit.TERM_TABLE).split(b"\0") if t]


def brute(rows, top=200):
    """Rows of the audit by plain loops over all pairs and all kept terms."""
    count, total, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        count[lang, source].update(terms(text))
        total[lang].update(terms(text))
        df[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in df[lang].items() if n >= 3)
        v = len(kept)

        def shares(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + v) for t in kept}
        q, p = shares(total[lang]), {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            own = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, top)):
                found.sort(key=lambda x: (-x[0], x[1]))
                out += [(lang, s, part, i.decode(), value, k + 1) for k, (value, i) in enumerate(found[:most])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus():
    rnd = random.Random(12)
    texts = prose(51, 120, words=150)
    rows = [(t, rnd.choice(["en", "de", "", None]), rnd.choice(["a", "b", "é", "z", None, ""])) for t in texts]
    rows += [(texts[0], "en", "a")] * 60                                           # a third is one text
    rows += [(t, "fr", f"s{i}") for i, t in enumerate(ODD)]
    rows += [("only once", "xx", "one"), (None, "xx", "two"), ("!", "yy", "alone")]  # nothing kept
    return rows


def test_audit_equals_plain_loops(spark):
    assert result(source_audit.audit(docs(spark, corpus()))) == brute(corpus())
    assert source_audit.audit(docs(spark, [])).collect() == []


def test_small_blocks_slices_and_lists_change_nothing(spark, monkeypatch):
    rows = corpus() + [("many words " * 40 + " ".join(prose(5, 3)), "en", f"w{i % 7}") for i in range(30)]
    monkeypatch.setattr(source_audit, "TERMS", 16)
    monkeypatch.setattr(source_audit, "SOURCES", 2)
    frame = source_audit.audit(docs(spark, rows), top=5)
    assert result(frame) == brute(rows, top=5)


def check_runs(texts, group):
    data = b"".join(texts).translate(source_audit.TERM_TABLE)
    edges = np.cumsum([0, *map(len, texts)])
    found, run, own, n_docs, n = source_audit.count_runs(data, edges, np.array(group))
    want, want_docs = Counter(), Counter()
    for t, g in zip(texts, group, strict=True):
        for term, k in Counter(x for x in t.translate(source_audit.TERM_TABLE).split(b"\0") if x).items():
            want[term, g] += k
            want_docs[term, g] += 1
    got = {(found[r], g): (k, d) for r, g, d, k in zip(run.tolist(), own.tolist(), n_docs.tolist(), n.tolist(), strict=True)}
    assert got == {k: (v, want_docs[k]) for k, v in want.items()}
    assert found == sorted(set(found))


@pytest.mark.parametrize("small", [2, 8, 2048])
def test_runs_of_sorted_pointers(monkeypatch, small):
    monkeypatch.setattr(source_audit, "SMALL", small)
    rnd = random.Random(small)
    for letters in ("ab ", "abcdefgh é日 ", "a", "aB .1"):
        for _ in range(20):
            texts = ["".join(rnd.choice(letters) * rnd.choice([1, 1, 8, 9]) for _ in range(rnd.randint(0, 200))).encode()
                     for _ in range(12)]
            texts += [b"", b"a" * rnd.choice([7, 8, 9, 16, 5000]), b"a" * 700 + b"b", b"a" * 700 + b"b"]
            check_runs(texts, sorted(rnd.randint(0, 4) for _ in texts))
    check_runs([], [])
    check_runs([b"", b" "], [0, 1])


def test_a_long_text_is_one_document(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(source_audit, "SLICE", 64)
    text = "alpha beta gamma " * 20 + "x" * 200 + " alpha"
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["s"]), pa.array([text])], ["lang", "source", "text"])
    docs_of, n_of = Counter(), Counter()
    for part in source_audit._slice_counts(batch):
        for row in part.to_pylist():
            docs_of[row["term"]] += row["docs"]
            n_of[row["term"]] += row["n"]
    assert docs_of == Counter({"alpha": 1, "beta": 1, "gamma": 1, "x" * 200: 1, "": 0})
    assert n_of == Counter({"alpha": 21, "beta": 20, "gamma": 20, "x" * 200: 1, "": 0})


def test_shares_are_exact_beyond_64_bits(spark):
    F = source_audit.F
    rows = [(8_000_000_000, 9_000_000_000_000_000, 10), (8_000_000_001, 9_000_000_000_000_000, 10),
            (4_000_000_000_000_000_000, 4_000_000_000_000_000_001, 7), (0, 0, 3), (5, 9, 0)]
    df = spark.createDataFrame(rows, "c bigint, t bigint, v bigint")
    got = [r[0] for r in df.select(source_audit.share(F.col("c"), F.col("t"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 1) // (t + v) if v else None for c, t, v in rows]
