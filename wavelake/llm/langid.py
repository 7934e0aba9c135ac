"""Language identification by segmentation-marginalised unigrams (operator 2).

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum, over all ways to cut it into pieces, of
the product of their probabilities; a forward pass over the word's positions
computes it for all languages at once.  A text's score is the product over
its words times the language's share of the training rows.

Words of any length are scored whole: a long one is passed in windows that
carry the probabilities of the last positions, as many as the longest piece
has characters.

Training is EM over the distinct words of a bounded sample: forward and
backward passes give the expected count of every piece; there words of over
``LONGEST`` letters count in parts.  The sample is drawn by a hash of the text
and the row's id with a rate per language, so that about ``sample_docs`` rows
of each language are used however many there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, stored, values

#: rows of each language that training uses, about
SAMPLE_DOCS = 3000
ROUNDS = 3
#: added to every expected count
SMOOTH = 0.01
#: most learned languages; the model is broadcast, so its size must be bounded
MAX_LANGUAGES = 1000
#: longer words are scored in windows, and trained on in parts of this many characters
LONGEST = 30
#: positions of a window
WINDOW = 16
#: words whose scores a task keeps, new words and words of texts that it scores at once, and the bytes of each
MEMO, TOGETHER, SLICE = 150_000, 10_000, 200_000
MEMO_BYTES, TOGETHER_BYTES, SLICE_BYTES = 256 << 20, 128 << 20, 64 << 20
#: characters of the texts that are taken together; a longer text stands alone
GROUP = 1 << 21
UNKNOWN = "und"
#: probability of a character that no piece stands for, in every language
UNKNOWN_CHARACTER = 1e-6
WORD = re.compile(r"[^\W\d_]+")
START = "▁"  # marks the start of a word in the vocabulary


def read_vocabulary(path: str) -> list[str]:
    """Distinct pieces of letters, in lower case, with or without the mark of
    a word's start."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if p.lstrip(START).isalpha() and p.rfind(START) <= 0} | {START})


@dataclass
class Model:
    pieces: list[str]
    languages: list[str]
    prob: np.ndarray  # pieces and the unknown character last, by languages
    prior: np.ndarray  # log share of each language


class Trie:
    """The pieces as a trie in arrays: sorted keys (node, character) of its
    edges, the node each leads to, and the piece that ends at a node or -1."""

    def __init__(self, pieces: list[str]):
        child: dict[int, int] = {}
        ends = {}
        self.longest = max(map(len, pieces), default=1)
        for i, piece in enumerate(pieces):
            node = 0
            for c in piece:
                node = child.setdefault(node << 21 | ord(c), len(child) + 1)
            ends[node] = i
        self.keys = np.array(sorted(child), np.int64)
        self.child = np.array([child[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.full(len(child) + 1, -1)
        self.piece[list(ends)] = list(ends.values())

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces in a text; all starts walk the
        trie together, one character a step."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        start, node, depth = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        found = [(np.zeros(0, np.int64),) * 3]
        while len(start) and len(self.keys):
            key = node << 21 | chars[start + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[edge] == key
            start, node, depth = start[on], self.child[edge[on]], depth + 1
            piece = self.piece[node]
            hit = piece >= 0
            found.append((start[hit], start[hit] + depth, piece[hit]))
            inside = start + depth < len(chars)
            start, node = start[inside], node[inside]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Lattice:
    """All pieces inside a list of words, as edges between positions."""

    def __init__(self, trie: Trie, unknown: int, words: list[str]):
        size = [len(w) + 1 for w in words]  # the mark and the word's characters
        self.begin = np.concatenate([[0], np.cumsum([s + 1 for s in size])])[:-1]
        self.end = self.begin + np.array(size)
        # position i of the text is node i; no piece holds the line end between words
        source, target, piece = trie.matches(START + ("\n" + START).join(words))
        # a character that no piece stands for alone is an unknown one
        self.nodes = int(self.end[-1]) + 1
        alone = np.ones(self.nodes, bool)
        alone[self.end] = False
        alone[source[target == source + 1]] = False
        alone = np.flatnonzero(alone)
        source, target = np.concatenate([source, alone]), np.concatenate([target, alone + 1])
        piece = np.concatenate([piece, np.full(len(alone), unknown)])
        at = np.repeat(np.arange(len(words)), np.array(size) + 1)
        depth = target - self.begin[at[target]]
        order = np.argsort(depth * self.nodes + target)
        self.source, self.target, self.piece = source[order], target[order], piece[order]
        self.levels = np.concatenate([[0], np.cumsum(np.bincount(depth)[1:])])
        self.word = at[self.target]

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """Per node and language the probability of all ways to reach it."""
        alpha = np.zeros((self.nodes, prob.shape[1]))
        alpha[self.begin] = 1
        for a, b in zip(self.levels, self.levels[1:], strict=False):
            t = self.target[a:b]
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            alpha[t[first]] = np.add.reduceat(alpha[self.source[a:b]] * prob[self.piece[a:b]], first, axis=0)
        return alpha

    def backward(self, prob: np.ndarray) -> np.ndarray:
        beta = np.zeros(self.nodes)
        beta[self.end] = 1
        for a, b in reversed(list(zip(self.levels, self.levels[1:], strict=False))):
            np.add.at(beta, self.source[a:b], beta[self.target[a:b]] * prob[self.piece[a:b]])
        return beta


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def parts_of(text: str | None) -> list[str]:
    """The words of a text for training, long ones in parts."""
    return [w[i:i + LONGEST] for w in words_of(text) for i in range(0, len(w), LONGEST)]


class Scorer:
    """Log probabilities of words per language.  What it keeps and what it
    works on at once is bounded in words and in bytes."""

    def __init__(self, model: Model):
        self.model, self.trie = model, Trie(model.pieces)
        row = 8 * max(1, len(model.languages))
        self.step = max(1, min(SLICE, SLICE_BYTES // row))
        self.room = max(self.step, min(MEMO, MEMO_BYTES // row))
        self.together = max(1, min(TOGETHER, TOGETHER_BYTES // (row * (LONGEST + 2))))
        self.windows = max(1, TOGETHER_BYTES // (4 * row * (WINDOW + self.trie.longest)))
        self.row: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        """Keep the scores of words of at most ``LONGEST`` letters."""
        new = list(words.difference(self.row))
        if len(self.row) + len(new) > self.room:
            self.row, self.table, new = {}, self.table[:0], list(words)
        parts = [self.table]
        for k in range(0, len(new), self.together):
            lattice = Lattice(self.trie, len(self.model.pieces), new[k:k + self.together])
            parts.append(np.log(np.maximum(lattice.forward(self.model.prob)[lattice.end], 1e-300)))
        start = len(self.row)
        self.row.update((w, start + i) for i, w in enumerate(new))
        self.table = np.concatenate(parts)

    def long(self, words: list[str]) -> np.ndarray:
        """Scores of words of any length, a window of positions at a time."""
        prob, back = self.model.prob, self.trie.longest
        text = ["\n" * (back - 1) + START + w for w in words]  # no piece holds the line ends
        out, scale = np.zeros((len(words), prob.shape[1])), np.zeros((len(words), prob.shape[1]))
        live, at = np.arange(len(words)), 0
        carry = np.zeros((len(words), back, prob.shape[1]))  # of the positions up to ``at``
        carry[:, -1] = 1
        while len(live):
            part = [text[i][at:at + back - 1 + WINDOW] for i in live]
            size = np.array([len(p) for p in part])
            begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
            source, target, piece = self.trie.matches("\n".join(part))
            word = np.searchsorted(begin, source, "right") - 1
            source, target = source - begin[word], target - begin[word]
            # a character that no piece stands for alone is an unknown one
            alone = np.arange(back - 1 + WINDOW) < size[:, None]
            alone[:, :back - 1] = False
            alone[word[target == source + 1], source[target == source + 1]] = False
            lone, place = np.nonzero(alone)
            word, source, target = (np.concatenate(x) for x in ((word, lone), (source, place), (target, place + 1)))
            piece = np.concatenate([piece, np.full(len(lone), len(self.model.pieces))])
            order = np.lexsort((word, target))
            order = order[target[order] >= back]  # those before are carried
            word, source, target, piece = word[order], source[order], target[order], piece[order]
            alpha = np.concatenate([carry, np.zeros((len(live), WINDOW, prob.shape[1]))], axis=1)
            bounds = np.searchsorted(target, np.arange(back, back + WINDOW + 1))
            for d, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False), back):
                if a < b:
                    w = word[a:b]
                    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                    alpha[w[first], d] = np.add.reduceat(alpha[w, source[a:b]] * prob[piece[a:b]], first, axis=0)
            ends = np.array([len(text[i]) for i in live]) <= at + back - 1 + WINDOW
            done = np.flatnonzero(ends)
            out[live[done]] = np.log(np.maximum(alpha[done, size[done]], 1e-300)) + scale[live[done]]
            carry, live, at = alpha[~ends, WINDOW:], live[~ends], at + WINDOW
            top = np.maximum(carry.max(axis=1), 1e-300)
            carry = carry / top[:, None]
            scale[live] += np.log(top)
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probabilities per word and language."""
        self.learn({w for w in words if len(w) <= LONGEST})
        at = np.array([self.row.get(w, -1) for w in words])
        far = np.flatnonzero(at < 0)
        out = self.table[at] if len(self.table) else np.zeros((len(words), len(self.model.languages)))
        if len(far):
            distinct = sorted({words[i] for i in far}, key=len)
            place = {w: i for i, w in enumerate(distinct)}
            found = np.concatenate([self.long(distinct[k:k + self.windows])
                                    for k in range(0, len(distinct), self.windows)])
            out[far] = found[[place[words[i]] for i in far]]
        return out

    def posteriors(self, texts: pa.Array) -> Iterator[np.ndarray | None]:
        """Posterior per language; None for texts without a letter."""
        group, size = [], 0
        for text in values(texts):
            if group and size + len(text or "") > GROUP:
                yield from self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text or "")
        yield from self._group(group)

    def _group(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        words = [words_of(t) for t in texts]
        score = np.zeros((len(texts), len(self.model.languages))) + self.model.prior
        flat, owner = list(chain.from_iterable(words)), np.repeat(np.arange(len(words)), [len(w) for w in words])
        for k in range(0, len(flat), self.step):
            own = owner[k:k + self.step]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            score[own[first]] += np.add.reduceat(self.scores(flat[k:k + self.step]), first, axis=0)
        for own, s in zip(words, score, strict=True):
            if not any(map(str.isalpha, own)) and not any(c.isalpha() for w in own for c in w):
                yield None
                continue
            s = np.exp(s - s.max())
            yield s / s.sum()


def train(labelled: DataFrame, vocabulary: list[str], text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, smooth: float = SMOOTH,
          id_col: str = "doc_id") -> Model:
    """Model of the languages in ``lang_col`` (rows without one or without
    text don't count).  Where there is an ``id_col``, copies of a text are drawn
    each for itself.  Piece counts of each round are summed by Spark; the
    driver gets the model only: pieces by languages."""
    own = F.col(id_col).cast("string") if id_col in labelled.columns else F.lit(None).cast("string")
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), own.alias("own")).filter(
        "text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    languages = sorted(counts)
    n, spark = len(vocabulary) + 1, labelled.sparkSession
    prob = np.full((n, len(languages)), 1.0 / n)
    prob[-1] = UNKNOWN_CHARACTER
    if not languages:
        return Model(vocabulary, [], prob, np.zeros(0))
    prior = np.log(np.array([counts[k] for k in languages]) / sum(counts.values()))
    rate = F.element_at(F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(
        min(1.0, sample_docs / counts[k])))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("text", "own"), F.lit(1_000_000)) < rate * 1_000_000
    place = {k: i for i, k in enumerate(languages)}

    def count_words(batch: pa.RecordBatch) -> pa.RecordBatch:
        tally: dict[tuple[int, str], int] = {}
        for text, lang in zip(values(batch.column(0)), values(batch.column(1)), strict=True):
            for w in parts_of(text):
                tally[place[lang], w] = tally.get((place[lang], w), 0) + 1
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in tally], pa.int32()), pa.array(
            [k[1] for k in tally], pa.string()), pa.array(list(tally.values()), pa.int64())], ["k", "word", "n"])
    words = map_batches(rows.filter(drawn).drop("own"), count_words, "k int, word string, n bigint")
    words = stored(words.groupBy("k", "word").agg(F.sum("n").alias("n")), "words")
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((vocabulary, prob))
        expected = words.mapInArrow(_expect(model), "k int, piece int, n double").groupBy("k", "piece").agg(
            F.sum("n").alias("n")).toArrow()
        count = np.full(prob.shape, smooth)
        np.add.at(count, (expected["piece"].to_numpy(), expected["k"].to_numpy()), expected["n"].to_numpy())
        prob = count / count.sum(axis=0)
        prob[-1] = UNKNOWN_CHARACTER
        model.unpersist()
    return Model(vocabulary, languages, prob, prior)


def _expect(model):
    """Expected piece counts of the words of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, prob = model.value
        trie, total = Trie(pieces), np.zeros(prob.shape)
        for batch in batches:
            k, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            words = batch.column(1).to_pylist()
            for lang in np.unique(k).tolist():
                own = np.flatnonzero(k == lang)
                lattice = Lattice(trie, len(pieces), [words[i] for i in own])
                p = prob[:, lang]
                alpha, beta = lattice.forward(p[:, None])[:, 0], lattice.backward(p)
                weight = n[own] / np.maximum(alpha[lattice.end], 1e-300)
                total[:, lang] += np.bincount(
                    lattice.piece, alpha[lattice.source] * p[lattice.piece] * beta[lattice.target]
                    * weight[lattice.word], len(total))
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()),
                                          pa.array(total[piece, lang])], ["k", "piece", "n"])
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns lang_pred and score added (columns of these
    names in ``docs`` are replaced).  Only the text is an input.

    Null texts and texts without a letter, and all texts if the model has no
    language, get ``und`` and score 0."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.pieces, model.languages, model.prob, model.prior))
    rest = docs.drop("lang_pred", "score")
    schema = T.StructType([*rest.schema, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        scorer = Scorer(model)
        for batch in batches:
            lang, score = [], []
            texts = batch.column(text_col)
            for p in scorer.posteriors(texts) if model.languages else [None] * len(texts):
                best = None if p is None else int(np.argmax(p))
                lang.append(UNKNOWN if p is None else model.languages[best])
                score.append(0.0 if p is None else float(p[best]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             [*batch.schema.names, "lang_pred", "score"])
    return rest.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """A third of the documents, by a checksum of the id; a row without an id
    is neither held out nor trained on."""
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def language_report(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score per row; learned from the rows
    that are not held out."""
    model = train(docs.filter(~held_out(id_col)), vocabulary, text_col, lang_col, id_col=id_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
