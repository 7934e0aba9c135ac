import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wavelake.llm import langid

from .helpers import ODD, documents

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def segmentations(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in segmentations(word[k:]):
            yield [word[:k], *rest]


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "ab", "b", "ba", "▁a", "c"]
    rng = np.random.default_rng(0)
    prob = rng.random((len(pieces) + 1, 2))
    words = ["abab", "c", "bxa", "a"]
    lattice = langid.Lattice(langid.Trie(pieces), len(pieces), words)
    index = {p: i for i, p in enumerate(pieces)} | {"x": len(pieces)}
    for w, got in zip(words, lattice.forward(prob)[lattice.end], strict=True):
        want = sum(np.prod([prob[index[p]] for p in s], axis=0) for s in segmentations("▁" + w)
                   if all(p in index for p in s))
        assert np.allclose(got, want)
    for w, got in zip(words, lattice.backward(prob[:, 1])[lattice.begin], strict=True):
        want = sum(np.prod([prob[index[p], 1] for p in s]) for s in segmentations("▁" + w) if all(p in index for p in s))
        assert np.isclose(got, want)


@pytest.mark.parametrize("budget", [None, 1])
def test_words_of_any_length_are_scored_whole(monkeypatch, budget):
    if budget:  # one word, window and row at a time
        for name in ("MEMO_BYTES", "TOGETHER_BYTES", "SLICE_BYTES", "GROUP"):
            monkeypatch.setattr(langid, name, budget)
    pieces = ["▁", "a", "ab", "abba", "b", "babab", "▁a", "▁abab", "c"]
    rng = np.random.default_rng(1)
    prob = rng.random((len(pieces) + 1, 3)) / len(pieces)
    index = {p: i for i, p in enumerate(pieces)}
    model = langid.Model(pieces, ["x", "y", "z"], prob, np.log([0.2, 0.3, 0.5]))

    def plain(word):  # all segmentations, by one position after the other
        text, alpha = "▁" + word, [np.ones(3)]
        for end in range(1, len(text) + 1):
            edges = [(k, index[text[k:end]]) for k in range(max(0, end - 6), end) if text[k:end] in index]
            edges += [] if text[end - 1] in index else [(end - 1, len(pieces))]
            alpha.append(sum(alpha[k] * prob[i] for k, i in edges))
        return np.log(alpha[-1])
    words = ["".join(rng.choice(list("abcd"), n)) for n in (1, 2, 15, 16, 17, 30, 31, 32, 40, 47, 48, 49, 100, 150)]
    words += ["ab" * 40, words[8], words[0]]
    scorer = langid.Scorer(model)
    got = np.concatenate([scorer.scores(words[k:k + scorer.step]) for k in range(0, len(words), scorer.step)])
    assert np.allclose(got, [plain(w) for w in words])
    assert np.allclose(scorer.long(words), got)
    assert np.isfinite(scorer.long(["abc" * 20_000])).all()  # no underflow
    texts = [" ".join(words), None, "12", words[9], "", "a " * 500]
    for text, post in zip(texts, scorer.posteriors(pa.array(texts)), strict=True):
        score = sum((plain(w) for w in langid.words_of(text)), model.prior)
        want = np.exp(score - score.max())
        assert post is None if not langid.words_of(text) else np.allclose(post, want / want.sum())


def test_forty_letters_by_enumeration():
    pieces, word = ["▁", "a", "b", "ab", "abcd", "cd", "c", "d", "▁ab"], "abcd" * 10
    prob = np.random.default_rng(2).random((len(pieces) + 1, 2))
    index = {p: i for i, p in enumerate(pieces)}

    def ways(text):
        if not text:
            yield np.ones(2)
        for p in pieces:
            if text.startswith(p):
                yield from (prob[index[p]] * rest for rest in ways(text[len(p):]))
    # 40 letters whole: the sum over "abcd" blocks, each enumerated, and the start
    block = sum(ways("abcd"))
    first = sum(ways("▁abcd"))
    scorer = langid.Scorer(langid.Model(pieces, ["x", "y"], prob, np.zeros(2)))
    assert np.allclose(scorer.scores([word])[0], np.log(first) + 9 * np.log(block))


def test_memory_with_a_thousand_languages():
    pieces = [chr(97 + i) for i in range(26)] + ["▁"]
    prob = np.random.default_rng(3).random((len(pieces) + 1, 1000)) / 30
    scorer = langid.Scorer(langid.Model(pieces, [str(i) for i in range(1000)], prob, np.zeros(1000)))
    rng = np.random.default_rng(4)
    text = " ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (30_000, 6)))
    tracemalloc.start()
    assert len(list(scorer.posteriors(pa.array([text, "q" * 2000])))) == 2
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30


def test_copies_are_drawn_each_for_itself(spark):
    rows = [(i, "the house and the dog", "en") for i in range(400)] + [(i, f"das haus {'ab'[i % 2]}", "de") for i in range(9)]
    model = langid.train(documents(spark, rows), langid.read_vocabulary(VOCABULARY), sample_docs=40)
    scorer = langid.Scorer(model)
    for p in scorer.posteriors(pa.array(["the dog and the house"])):
        assert model.languages[int(np.argmax(p))] == "en"


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = langid.language_report(docs, langid.read_vocabulary(VOCABULARY)).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 40 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_and_clashing_columns(spark):
    train = [(i, t, k) for i, (t, k) in enumerate([("the house and the dog", "en"), ("das haus und der hund", "de")] * 30)]
    rows = train + [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "the dog", "en"), (5, "the dog"), (5, "the dog")]
    docs = documents(spark, rows)
    out = langid.language_report(docs, langid.read_vocabulary(VOCABULARY)).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out} <= {"en", "de", "und"}
    by_text = {r.doc_id: r for r in out}
    for i, t in enumerate(ODD):
        assert (by_text[100 + i].lang_pred == "und") == (t is None or not any(c.isalpha() for c in t))
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    model = langid.train(docs.filter(~langid.held_out()), langid.read_vocabulary(VOCABULARY))
    wide = langid.predict(docs, model)  # a column lang_pred is replaced, the others stay
    assert wide.columns == [*[c for c in docs.columns if c != "lang_pred"], "lang_pred", "score"]
    wrong = documents(spark, [(i, "the dog and the house", "zz") for i in range(3)])
    assert {r.lang_pred for r in langid.predict(wrong, model).collect()} == {"en"}  # lang is no input


def test_nothing_to_learn_from_and_empty_table(spark):
    vocabulary = langid.read_vocabulary(VOCABULARY)
    out = langid.language_report(documents(spark, [(1, "words"), (2, None)]), vocabulary).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert langid.language_report(documents(spark, []), vocabulary).collect() == []


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    docs = spark.range(9).select(F.lit("text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs, ["a"])
