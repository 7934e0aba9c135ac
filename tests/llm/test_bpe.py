import hashlib
import random

from tokenizers import Tokenizer

from wavelake.llm import bpe

from .helpers import ODD, documents, prose

PATH = "/opt/tokenizers/byte_bpe_50k.json"


def texts():
    rnd = random.Random(8)
    mixed = ["".join(rnd.choice("aábc \n<|endoftext|>'sé1²日\U0001f600\t") for _ in range(80)) for _ in range(150)]
    return [*prose(21, 20), *mixed, "a<|endoftext|>b", "<|endoftext|>", "  lead", "trail  ", "don't we'll", "x" * 300,
            "ab" * 2500, *ODD]


def test_report_equals_the_tokenizers_library(spark):
    lib, rows = Tokenizer.from_file(PATH), [*enumerate(texts()), (None, "no id"), (3, "again"), (3, "again")]
    want = []
    for doc, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append((repr(doc), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    got = bpe.encoding_report(documents(spark, rows), PATH).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_encode_and_decode_round_trip(spark):
    rows = list(enumerate(texts()))
    back = bpe.decode(bpe.encode(documents(spark, rows), PATH), PATH).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in rows}
    assert bpe.encoding_report(documents(spark, []), PATH).collect() == []


def test_no_token_holds_a_forced_boundary():
    vocabulary = bpe.load_vocabulary(PATH)
    codec = bpe.Codec(vocabulary)
    data, starts, _ = codec.cut(["héllo\x00wörld".encode()])
    cuts = [bytes(data[k - 1:k + 1].tolist()) for k in starts.tolist()[1:]]
    assert cuts and not any(c in t for c in cuts for t in vocabulary["ids"])


def test_small_memo_and_groups_change_nothing(monkeypatch):
    vocabulary, lib = bpe.load_vocabulary(PATH), Tokenizer.from_file(PATH)
    monkeypatch.setattr(bpe, "GROUP", 200)
    codec = bpe.Codec(vocabulary, memo_bytes=5000)
    for text, parts in zip(texts(), codec.parts(texts()), strict=False):
        assert ",".join(p[0] for p in parts) == ",".join(map(str, lib.encode(text or "", add_special_tokens=False).ids))


def test_memo_is_bounded_in_bytes_and_keeps_no_long_pieces():
    rnd = random.Random(3)
    codec = bpe.Codec(bpe.load_vocabulary(PATH), memo_bytes=200_000)
    texts = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (900, 900, 3000)) for _ in range(40)]
    texts += [f"word{k}" for k in range(3000)]
    lib = Tokenizer.from_file(PATH)
    for text in texts:
        assert codec.encode(text) == lib.encode(text, add_special_tokens=False).ids
        assert codec.used <= 100_000 + 10_000
        assert all(len(p) <= bpe.LONG_PIECE for p in [*codec.pieces, *codec.old])
    kept = [p for p in codec.pieces if p not in codec.special]
    assert codec.used == sum(bpe.ENTRY + bpe.ENTRY_CHAR * len(p) for p in kept)
