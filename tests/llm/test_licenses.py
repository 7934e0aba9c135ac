import re

import duckdb
import pytest

from wavelake.llm import licenses

from .helpers import ODD, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(rows):
    out = []
    for doc, text in rows:
        w, places, labels = words(text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            found = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        out.append((repr(doc), len(w), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(labels))))
    return sorted(out, key=repr)


def rows():
    a = prose(31, 6)
    texts = [*a, a[0] + " GNU General-Public License, apache LICENSE", "mit license mit license mit mit license",
             "cc by", "the cc, by nc", "gnu general public licence", "Apache", "Éapache license", "apache licenseé",
             "Released under the MIT License.", *licenses.TEMPLATES, *ODD, *licenses.TEXTS.values(),
             "released under the mit license mit license mit license mit license",
             "mit license " * 40 + "released under the mit license" + " the mit license" * 40,
             "in the software the software of the software " * 30 + licenses.TEXTS["mit-whole"] + " of the software" * 50]
    return [*enumerate(texts), (None, "cc by"), (8, "cc by"), (8, "cc by")]


def test_base_columns_match_scanning(spark):
    got = licenses.scan(documents(spark, rows())).collect()
    assert sorted(((repr(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got),
                  key=repr) == plain(rows())
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_edited_templates_are_found_and_prose_is_not(spark):
    mit = next(t for t, k in licenses.TEMPLATES.items() if k == "mit-text").split()
    edited = " ".join([*mit[:6], "extra", *mit[6:12], *mit[13:]])  # a word put in, a word lost
    half = " ".join(mit[:8])
    df = licenses.scan(documents(spark, [(1, f"Start. {edited} end"), (2, half), (3, " ".join(prose(32, 5)))]))
    got = {r.doc_id: r for r in df.collect()}
    assert got[1].labels == "mit-text" and 0.75 <= got[1].score < 1
    span = got[1].spans[0]
    assert span.start == 1 and words(f"Start. {edited} end")[span.start:span.stop] == edited.split()
    assert got[2].labels == got[3].labels == "" and got[2].score == 0


def test_repeated_pairs_beside_a_copy_do_not_hide_it(spark):
    notice = "released under the mit license"
    whole = licenses.TEXTS["mit-whole"].split()
    edited = " ".join([*whole[:40], "extra", *whole[40:90], *whole[92:]])
    texts = [notice + " mit license" * 3, "mit license " * 40 + notice + " the mit license" * 40, edited,
             "of the software " * 200 + edited + " in the software" * 200, "of the software in the software " * 300,
             " ".join(whole[:80])]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, list(enumerate(texts)))).collect()}
    assert got[0].labels == got[1].labels == "mit,mit-notice" and got[0].score == got[1].score == 1
    for k in (2, 3):
        assert got[k].labels == "mit-text,mit-whole"
        (span,) = (s for s in got[k].spans if s.label == "mit-whole")
        assert 0.9 < span.share < 1 and span.stop - span.start <= 2 * len(words(licenses.TEXTS["mit-whole"]))
    assert got[4].labels == "" and got[5].labels == "mit-text"


def test_oracle_says_the_same(spark):
    docs = documents(spark, rows())
    with duckdb.connect() as db:
        db.register("documents", docs.select("doc_id", "text").toArrow())
        want = db.execute(licenses.oracle_sql()).fetchall()
    got = [tuple(r) for r in licenses.scan(docs).drop("spans").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("n", [0, 1])
def test_plan_is_built_ins_only_and_empty_table(spark, n):
    df = licenses.scan(documents(spark, [(1, None)][:n]))
    assert len(df.collect()) == n and "Python" not in df._jdf.queryExecution().toString()
