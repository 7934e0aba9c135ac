"""Byte-level BPE by dynamic programming over prefixes (operator 13).

A rank file gives token bytes and ranks; merges join the neighbours whose
joined bytes have the least rank.  The encoding of a byte string is the one
split into tokens in which every two neighbours are a *valid pair*: merging
their joined bytes gives just these two.  So the encoding of a prefix ends in
exactly one token: the one that ends there, and whose neighbour, the last
token of the prefix before it, forms a valid pair with it.  ``Prefixes`` holds
that last token for every prefix of a piece of text.  Bytes are appended
without looking at earlier ones again, and an edit is redone only from its
place to where the last tokens agree with the old ones over the length of the
longest token.  ``Document`` does the same for a text and the pieces in which
the pattern splits it.

Pieces repeat, so a task keeps their codes in a memo whose bytes are bounded.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: characters of a text that are split at once
WINDOW = 1 << 23
#: bytes that the memo of a task may take, about; a full memo is emptied, which changes no result
MEMO_BYTES = 160 << 20
#: longer pieces are not kept
LONG_PIECE = 512
#: bytes of one memo entry besides its strings, and token pairs whose validity is kept
ENTRY, PAIRS = 250, 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks from a file with lines of base64 and rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{path} lacks the single bytes {missing[:5]}")
    return ranks


#: above every rank
NO_MERGE = 1 << 62


class Vocabulary:
    """Ranks with what the prefix tables look up."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.size_of = [len(self.bytes_of.get(i, b"")) for i in range(max(self.bytes_of) + 1)]
        self.longest = max(self.size_of)
        #: by before << 32 | token
        self._valid: dict[int, bool] = {}
        self._edges: dict[int, tuple[list, list, bool]] = {}

    def edges(self, token: int) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]], bool]:
        """How the first and the last part of a token grow while its bytes are
        merged: (least rank up to which merges must be done, part), from the
        single byte on, for both ends; and whether they end as this token."""
        found = self._edges.get(token)
        if found is None:
            data, ranks = self.bytes_of[token], self.ranks
            parts = [data[i:i + 1] for i in range(len(data))]
            ends = [(-1, parts[0])], [(-1, parts[-1])]
            most = [-1, -1]
            while len(parts) > 1:
                rank, i = min((ranks.get(a + b, NO_MERGE), i) for i, (a, b) in enumerate(pairwise(parts)))
                if rank == NO_MERGE:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                for side, grown in ((0, i == 0), (1, i == len(parts) - 1)):
                    most[side] = max(most[side], rank)
                    if grown:
                        ends[side].append((most[side], parts[-side]))
                        most[side] = -1
            found = self._edges[token] = (*ends, len(parts) == 1)
        return found

    def valid(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: stand first): neither
        the merges inside them nor one across their border spoil them."""
        found = self._valid.get(before << 32 | token)
        if found is None:
            if len(self._valid) >= PAIRS:
                self._valid.clear()
            found = self._valid[before << 32 | token] = self.edges(token)[2] and (before < 0 or self._apart(before, token))
        return found

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes first: both ends grow in
        the order of their ranks, of equal ranks the leftmost place first."""
        _, a, whole = self.edges(left)
        b, ranks = self.edges(right)[0], self.ranks
        if not whole:
            return False
        i = j = 0
        while True:
            across = ranks.get(a[i][1] + b[j][1], NO_MERGE)
            grow_left = a[i + 1][0] if i + 1 < len(a) else NO_MERGE
            grow_right = b[j + 1][0] if j + 1 < len(b) else NO_MERGE
            if across < grow_left and across <= grow_right and across < NO_MERGE:
                return False
            if grow_left == grow_right == NO_MERGE:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1


class Prefixes:
    """The last token of the encoding of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.redone = 0  # prefixes computed so far
        self.append(data)

    def _extend(self, data: bytes, last: list[int], old: list[int] | None = None, shift: int = 0, tail: int = 0) -> None:
        """Appends to ``last`` the last tokens of the prefixes of ``data`` that
        it lacks.  With ``old``, the bytes from ``tail`` on are those that
        table has ``shift`` before; it is taken over where both agree."""
        ranks, pairs = self.vocabulary.ranks.get, self.vocabulary._valid.get
        add, begin, agree = last.append, len(last), 0
        valid, size_of = self.vocabulary.valid, self.vocabulary.size_of
        for end in range(begin + 1, len(data) + 1):
            # the last token of the prefix before, longer by this byte, is the right one most often
            start = end - 1 - (size_of[last[-1]] if end > 1 else 0)
            token = ranks(data[start:end])
            fits = False
            if token is not None:
                before = last[start - 1] if start else -1
                fits = pairs(before << 32 | token)
                if fits is None:
                    fits = valid(before, token)
            start = end
            while not fits:  # exactly one fits, so the order does not matter
                start -= 1
                token = ranks(data[start:end])
                if token is not None:
                    before = last[start - 1] if start else -1
                    fits = pairs(before << 32 | token)
                    if fits is None:
                        fits = valid(before, token)
                if not start and not fits:
                    raise ValueError("the ranks give this prefix no encoding")
            add(token)
            if old is not None and end > tail:
                agree = agree + 1 if token == old[end - shift - 1] else 0
                if agree >= self.vocabulary.longest:
                    self.redone += end - begin
                    last.extend(old[end - shift:])
                    return
        self.redone += len(data) - begin

    def append(self, more: bytes) -> Prefixes:
        self.data += more
        self._extend(self.data, self.last)
        return self

    def edit(self, start: int, stop: int, new: bytes) -> Prefixes:
        """data[start:stop] becomes ``new``; what follows is computed only
        until it is as before for the length of the longest token."""
        data, last = self.data[:start] + new + self.data[stop:], self.last[:start]
        self._extend(data, last, self.last, len(data) - len(self.data), start + len(new))
        self.data, self.last = data, last
        return self

    def restart(self, data: bytes) -> Prefixes:
        """Only the common prefix stays: cheapest for pieces in sorted order."""
        head = _common(self.data, data)
        del self.last[head:]
        self.data = data
        self._extend(data, self.last)
        return self

    def become(self, data: bytes) -> Prefixes:
        """The same for whatever turns the bytes into ``data``."""
        head = _common(self.data, data)
        tail = _common(self.data[head:][::-1], data[head:][::-1])
        return self.edit(head, len(self.data) - tail, data[head:len(data) - tail])

    def ids(self) -> list[int]:
        """Walks back from the last token.  A piece that is a token is that
        token, even where no merges lead to it."""
        whole = self.vocabulary.ranks.get(self.data)
        if whole is not None:
            return [whole]
        out, end, last, size_of = [], len(self.data), self.last, self.vocabulary.size_of
        while end:
            token = last[end - 1]
            out.append(token)
            end -= size_of[token]
        return out[::-1]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class Document:
    """A text with the prefix tables of its pieces, kept for edits."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.pattern, self.text = vocabulary, regex.compile(pattern), text
        self.starts, self.tables = [], []
        for m in self.pattern.finditer(text):
            self.starts.append(m.start())
            self.tables.append(Prefixes(vocabulary, _utf8(m.group())))

    def edit(self, start: int, stop: int, new: str) -> Document:
        """text[start:stop] becomes ``new``.  A match looks at most two
        characters past its end and never back, so the pieces up to the third
        last before the edit stay, and so do all from the first place behind
        it where an old and a new piece start together."""
        text, shift = self.text[:start] + new + self.text[stop:], len(new) - (stop - start)
        first = max(0, sum(s <= start for s in self.starts) - 3)
        place = {s: i for i, s in enumerate(self.starts)}
        begin = self.starts[first] if self.starts else 0
        starts, tables, at = self.starts[:first], self.tables[:first], len(self.starts)
        for m in self.pattern.finditer(text, begin):
            s = m.start()
            if s >= start + len(new) and s - shift >= stop and s - shift in place:
                at = place[s - shift]
                break
            old = place.get(s) if s < start else None
            table = self.tables[old] if old is not None else Prefixes(self.vocabulary)
            starts.append(s)
            tables.append(table.become(_utf8(m.group())))
        self.starts = starts + [s + shift for s in self.starts[at:]]
        self.text, self.tables = text, tables + self.tables[at:]
        return self

    def append(self, more: str) -> Document:
        return self.edit(len(self.text), len(self.text), more)

    def ids(self) -> list[int]:
        return [i for t in self.tables for i in t.ids()]

    def redone(self) -> int:
        return sum(t.redone for t in self.tables)


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Decoder:
    """Bytes of many ids at once."""

    def __init__(self, vocabulary: Vocabulary):
        by_id = vocabulary.bytes_of
        self.size = np.zeros(max(by_id) + 1, np.int64)
        for i, t in by_id.items():
            self.size[i] = len(t)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(len(self.size))), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or (self.size[ids] == 0).any()):
            raise ValueError("an id that the ranks lack")
        size = self.size[ids]
        stop = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - stop + size, size) + np.arange(int(size.sum()))].tobytes()


class Codec:
    """Encoder of many texts, with a memo of pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, memo_bytes: int = MEMO_BYTES, window: int = WINDOW):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern)
        self.memo_bytes, self.window, self.used = memo_bytes, window, 0
        self.code: dict[str, bytes] = {}   # ids as little-endian 32-bit numbers
        self.decoder = Decoder(vocabulary)

    def pieces(self, text: str) -> Iterator[tuple[list[str], bool]]:
        """Matches of the pattern, about a window of the text at a time, and
        whether they are the text's last.  The last three of a window may end
        elsewhere once more text is seen, so the next window starts with them."""
        at, width = 0, self.window
        while at + width < len(text):
            kept = self.split.findall(text[at:at + width])[:-3]
            if kept:
                yield kept, False
                at, width = at + sum(map(len, kept)), self.window
            else:
                width *= 2
        yield self.split.findall(text[at:] if at else text), True

    def encoded(self, texts: Iterable[str | None]) -> Iterator[tuple[bytes, bool]]:
        """(ids as bytes, whether the text ends here) of all texts in order.
        Pieces are held for about a window of characters, in one or many texts."""
        held, size = [], 0
        for text in texts:
            for found, last in self.pieces(text or ""):
                held.append((found, last))
                size += min(self.window, len(text or ""))
                if size >= self.window:
                    yield from self._codes(held)
                    held, size = [], 0
        yield from self._codes(held)

    def _codes(self, held: list[tuple[list[str], bool]]) -> Iterator[tuple[bytes, bool]]:
        every, code = set().union(*[found for found, _ in held]), self.code
        new = sorted([(_utf8(p), p) for p in every.difference(code)])
        grown = sum([ENTRY + 4 * len(data) for data, _ in new])
        if self.used + grown > self.memo_bytes:
            known = every.intersection(code)
            code = self.code = {p: code[p] for p in known}
            self.used = sum([ENTRY + 4 * len(p) for p in known])
        self.used += grown
        table, whole = Prefixes(self.vocabulary), self.vocabulary.ranks.get
        for data, p in new:
            token = whole(data)
            code[p] = array("I", [token] if token is not None else table.restart(data).ids()).tobytes()
        for found, last in held:
            yield b"".join(map(code.__getitem__, found)), last
        for data, p in new:
            if len(p) > LONG_PIECE:
                del code[p]
                self.used -= ENTRY + 4 * len(data)


#: codec of this Python worker, whose memos serve all its tasks, and what it was made from
_LOADED: list[tuple] = []


def _codec(ranks: dict[bytes, int], pattern: str) -> Codec:
    if not _LOADED or _LOADED[0][0] is not ranks or _LOADED[0][1] != pattern:
        _LOADED[:] = [(ranks, pattern, Codec(Vocabulary(ranks), pattern))]
    return _LOADED[0][2]


def _map(df: DataFrame, path: str, pattern: str, fn, schema: str) -> DataFrame:
    """``fn(codec, batch)`` on every batch.  The ranks, of fixed size, are
    read once by the driver and broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(load_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            yield fn(codec, batch)
    return df.mapInArrow(run, schema)


def _docs(docs: DataFrame, id_col: str, col: str, *more: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(col), *[F.col(c) for c in more])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and token ids.  A null text counts as empty;
    no special token is known; other columns are not read."""
    def run(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, own = [], []
        for code, last in codec.encoded(t.as_py() for t in batch.column(1)):
            own.append(code)
            if last:
                ids.append(np.frombuffer(b"".join(own), "<u4").astype(np.int32))
                own = []
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return _map(_docs(docs, id_col, text_col), path, pattern, run, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per list of ids: id and decoded bytes; a null list is empty, an
    id that the ranks lack is an error."""
    def run(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        data = [codec.decoder.decode(np.array(row.as_py() or [], np.int64)) for row in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])
    return _map(_docs(tokens, id_col, ids_col), path, "", run, "doc_id bigint, data binary")


def encode_edits(edits: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Re-encoding near edits.  Rows hold a text and one edit of it: characters
    ``start`` to ``stop`` become ``insert`` (a null insert is empty, null
    places are the end of the text: an append).  Returns the id, the ids of
    the edited text and how many prefixes the edit had computed anew."""
    def run(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, redone = [], []
        for text, a, b, new in zip(*[batch.column(i).to_pylist() for i in range(1, 5)], strict=True):
            doc = Document(codec.vocabulary, pattern, text or "")
            n, before = len(doc.text), {id(t): (t, t.redone) for t in doc.tables}
            a = n if a is None else min(max(0, a), n)
            b = n if b is None else min(max(a, b), n)
            doc.edit(a, b, new or "")
            ids.append(doc.ids())
            redone.append(sum(t.redone - before.get(id(t), (t, 0))[1] for t in doc.tables))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                                           pa.array(redone, pa.int64())], ["doc_id", "ids", "n_redone"])
    rows = edits.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                        F.col("start").cast("bigint"), F.col("stop").cast("bigint"), "insert")
    return _map(rows, path, pattern, run, "doc_id bigint, ids array<int>, n_redone bigint")


REPORT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encoding_report(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests per document: number of ids, SHA-256 of the ids as
    little-endian 32-bit numbers and of the bytes decoded from them."""
    def run(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, ids, back = [], [], []
        size, id_hash, back_hash = 0, hashlib.sha256(), hashlib.sha256()
        for code, last in codec.encoded(t.as_py() for t in batch.column(1)):
            size += len(code) // 4
            id_hash.update(code)
            back_hash.update(codec.decoder.decode(np.frombuffer(code, "<u4")))
            if last:
                n.append(size)
                ids.append(id_hash.hexdigest())
                back.append(back_hash.hexdigest())
                size, id_hash, back_hash = 0, hashlib.sha256(), hashlib.sha256()
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _map(_docs(docs, id_col, text_col), path, pattern, run, REPORT)
