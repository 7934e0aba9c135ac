"""BPE encoding and decoding by forced boundaries (operator 9).

The vocabulary file gives byte-level tokens and ranked merges.  Text is split
by the tokenizer's pattern first.  A byte pair that occurs inside no
vocabulary token can never be bridged by a merge, since the merged token
would contain the pair; between such bytes a cut is certain.  Each piece of
text is cut there, the fragments are merged independently by rank and their
ids concatenated.  Pieces repeat, so their codes are kept in a memo of bounded
size per task; the fragments of all new pieces are merged together.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import values

#: bytes that the memo of a task may take, about, in two halves: when the one in use is full, the other is forgotten and
#: what is still met in the full one moves on, which changes no result
MEMO_BYTES = 128 << 20
#: bytes of an entry besides its piece, bytes for each character of it, and characters beyond which it isn't kept
ENTRY, ENTRY_CHAR, LONG_PIECE = 300, 8, 1000
#: characters of text whose pieces are held at once
GROUP = 1_000_000
#: fragments of more bytes are merged one by one
LONG = 64
NO_MERGE = 1 << 40
#: how byte-level vocabularies split text before merging (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 for itself, the rest from U+0100 up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """Ids of token bytes, merge ranks, token bytes by id, special tokens and
    the set of byte pairs inside tokens, from a tokenizer JSON file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"], spec["model"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]:
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    alphabet = byte_alphabet()
    raw = lambda token: bytes(alphabet[c] for c in token)
    ids = {raw(k): v for k, v in model["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    by_id = {v: k for k, v in ids.items()} | {v: k.encode() for k, v in special.items()}
    inside = {t[i:i + 2] for t in ids for i in range(len(t) - 1)}
    return {"ids": ids, "merges": {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)},
            "bytes": by_id, "special": special, "inside": inside}


class Codec:
    """Encoder and decoder over a loaded vocabulary."""

    def __init__(self, vocabulary: dict, memo_bytes: int = MEMO_BYTES):
        self.merges, self.by_id = vocabulary["merges"], vocabulary["bytes"]
        self.special, self.memo_bytes, self.used = vocabulary["special"], memo_bytes, 0
        self.split = regex.compile(PATTERN).findall
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                        + ")") if self.special else None
        #: decimal ids, number of ids and decoded bytes by piece of text
        self.pieces: dict[str, tuple[str, int, bytes]] = {}
        self.old: dict[str, tuple[str, int, bytes]] = {}
        ids = vocabulary["ids"]
        self.byte_id = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.inside = np.zeros(65536, bool)
        self.inside[[p[0] * 256 + p[1] for p in vocabulary["inside"]]] = True
        left = np.array([ids[a] for a, _ in self.merges], np.int64)
        right = np.array([ids[b] for _, b in self.merges], np.int64)
        key = left << 32 | right
        self.order = np.argsort(key)
        self.keys = key[self.order]
        self.joined = np.array([ids[a + b] for a, b in self.merges], np.int64)
        self.ids = ids

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of neighbours a and b; NO_MERGE if there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NO_MERGE)

    def cut(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bytes of the pieces, where fragments start, where pieces start:
        a piece starts a fragment, and so does a byte whose pair with the one
        before occurs inside no token."""
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])[:-1]
        forced = np.ones(len(data), bool)
        forced[1:] = ~self.inside[data[:-1] * 256 + data[1:]]
        forced[starts] = True
        return data, np.flatnonzero(forced), starts

    def merge(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all fragments, and the fragment of each id.  In every
        round each unfinished fragment joins its best-ranked pair, the
        leftmost of equals; all fragments proceed together."""
        size = np.diff(np.concatenate([starts, [len(data)]]))
        frag, token = np.repeat(np.arange(len(starts)), size), self.byte_id[data]
        done = []
        for f in np.flatnonzero(size > LONG):  # rounds would be as many as bytes
            ids = self._merge_long(data[starts[f]:starts[f] + size[f]].astype(np.uint8).tobytes())
            done.append((np.array(ids, np.int64), np.full(len(ids), f)))
        short = (size <= LONG)[frag]
        frag, token = frag[short], token[short]
        rank = np.full(len(token), NO_MERGE)
        same = np.flatnonzero(frag[1:] == frag[:-1])
        rank[same] = self.ranks(token[same], token[same + 1])
        while len(token):
            first = np.flatnonzero(np.concatenate([[True], frag[1:] != frag[:-1]]))
            count = np.diff(np.concatenate([first, [len(frag)]]))
            best = np.minimum.reduceat(rank, first)
            ready = np.repeat(best == NO_MERGE, count)
            if ready.any():
                done.append((token[ready], frag[ready]))
                open_ = ~ready
                token, frag, rank = token[open_], frag[open_], rank[open_]
                live = best < NO_MERGE
                best, count = best[live], count[live]
                if not len(token):
                    break
            at = np.flatnonzero(rank == np.repeat(best, count))
            at = at[np.concatenate([[True], frag[at[1:]] != frag[at[:-1]]])]
            token[at] = self.joined[rank[at]]
            rank[at] = NO_MERGE
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            token, frag, rank = token[keep], frag[keep], rank[keep]
            at = at - np.arange(len(at))  # one id fewer in every fragment before
            for i in (at, at - 1):
                i = i[(i >= 0) & (i < len(token) - 1)]
                i = i[frag[i] == frag[i + 1]]
                rank[i] = self.ranks(token[i], token[i + 1])
            last = np.concatenate([frag[1:] != frag[:-1], [True]])
            rank[last] = NO_MERGE
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        token, frag = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(frag, kind="stable")
        return token[order], frag[order]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap and links, for one fragment of any length."""
        parts, merges = [data[i:i + 1] for i in range(len(data))], self.merges
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := merges.get(p)) is not None]
        heapq.heapify(heap)
        alive: list[bytes | None] = list(parts)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i] if alive[i] is not None else n
            if alive[i] != a or j >= n or alive[j] != b:
                continue
            alive[i], alive[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := merges.get((alive[x], alive[y]))) is not None:
                    heapq.heappush(heap, (r, x, (alive[x], alive[y])))
        return [self.ids[p] for p in alive if p is not None]

    def learn(self, pieces: set[str]) -> dict[str, tuple[str, int, bytes]]:
        """Codes of pieces that the memo lacks, all merged together."""
        new = list(pieces)
        if not new:
            return {}
        data, fragments, starts = self.cut([p.encode("utf-8", "surrogatepass") for p in new])
        token, frag = self.merge(data, fragments)
        owner = np.searchsorted(starts, fragments[frag], "right") - 1
        edge = np.searchsorted(owner, np.arange(len(new) + 1)).tolist()
        ids, by_id, out = token.tolist(), self.by_id, {}
        for k, p in enumerate(new):
            own = ids[edge[k]:edge[k + 1]]
            out[p] = (",".join(map(str, own)), len(own), b"".join([by_id[i] for i in own]))
        return out

    def parts(self, texts: Iterable[str | None]) -> Iterator[list[tuple[str, int, bytes]]]:
        """Per text the codes of its pieces in order, in groups of about
        ``GROUP`` characters, so that what is held at once stays small."""
        group: list[str] = []
        size = 0
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[list[tuple[str, int, bytes]]]:
        cut = []
        for t in texts:
            if self.special_at and any(s in t for s in self.special):
                cut.append([p for run in self.special_at.split(t)
                            for p in ([run] if run in self.special else self.split(run))])
            else:
                cut.append(self.split(t))
        every, codes = set().union(*cut), self.pieces
        lacking = every.difference(codes, self.special)
        new = {p: self.old[p] for p in lacking.intersection(self.old)}
        new.update(self.learn(lacking.difference(new)))
        grown = sum([ENTRY + ENTRY_CHAR * len(p) for p in new])
        if self.used + grown > self.memo_bytes // 2:
            self.old = codes
            codes = self.pieces = {p: codes[p] for p in every.intersection(codes).difference(self.special)}
            self.used = sum([ENTRY + ENTRY_CHAR * len(p) for p in codes])
        self.used += grown
        codes.update(new)
        codes.update((s, (str(i), 1, s.encode())) for s, i in self.special.items())
        out = [[codes[p] for p in c] for c in cut]
        for p in [p for p in new if len(p) > LONG_PIECE]:
            del codes[p]
            self.used -= ENTRY + ENTRY_CHAR * len(p)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _, _ in next(self.parts([text])) for i in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.by_id[i] for i in ids).decode("utf-8", "replace")


def _with_codec(df: DataFrame, path: str, fn, schema: str) -> DataFrame:
    """``fn(codec, batch)`` on every batch.  The vocabulary, of fixed size,
    is read once by the driver and broadcast."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value)
        for batch in batches:
            yield fn(codec, batch)
    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and token ids.  A null text counts as empty;
    special tokens in a text are encoded as such; other columns are not read."""
    def fn(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [[int(i) for p in parts for i in p[0].split(",")] for parts in codec.parts(values(batch.column(1)))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return _with_codec(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")),
                       path, fn, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per list of ids: id and decoded text, special tokens included;
    bytes that are no UTF-8 become U+FFFD; a null list decodes as empty."""
    def fn(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [codec.decode(i) if i else "" for i in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])
    return _with_codec(tokens.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids")),
                       path, fn, "doc_id bigint, text string")


REPORT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encoding_report(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests per document: number of ids, SHA-256 of the ids joined by
    commas and of the text decoded from them, both in one pass."""
    def fn(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, ids, back = [], [], []
        for parts in codec.parts(values(batch.column(1))):
            n.append(sum([p[1] for p in parts]))
            ids.append(hashlib.sha256(",".join([p[0] for p in parts]).encode()).hexdigest())
            raw = b"".join([p[2] for p in parts]).decode("utf-8", "replace").encode("utf-8")
            back.append(hashlib.sha256(raw).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _with_codec(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")),
                       path, fn, REPORT)
