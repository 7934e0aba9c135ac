import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from wavelake.llm import prefix_bpe

from .helpers import ODD, documents, prose

PATH = P.path("byte_bpe_50k.tiktoken")
LETTERS = "aábc \n'séretvl1²日\U0001f600\t\x1c　\u0085ABxyz<|>"


@pytest.fixture(scope="module")
def ranks():
    return prefix_bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def lib(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return prefix_bpe.Vocabulary(ranks)


def texts():
    rnd = random.Random(13)
    mixed = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, 120))) for _ in range(200)]
    return [*prose(31, 20), *mixed, "a<|endoftext|>b", "don't we'll 'r", "  x", "x  ", "\n\n\n", "ab" * 2500,
            "".join(rnd.choice("acgt") for _ in range(6000)), *ODD]


def test_report_equals_the_tiktoken_library(spark, lib):
    rows = [*enumerate(texts()), (None, "no id"), (3, "again"), (3, "again")]
    want = []
    for doc, text in rows:
        ids = lib.encode_ordinary(text or "")
        want.append((repr(doc), len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(lib.decode_bytes(ids)).hexdigest()))
    got = prefix_bpe.encoding_report(documents(spark, rows), PATH, P.PATTERN).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_encode_and_decode_round_trip(spark, lib):
    rows = list(enumerate(texts()))
    ids = prefix_bpe.encode(documents(spark, rows), PATH, P.PATTERN)
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: lib.encode_ordinary(t or "") for i, t in rows}
    assert {r.doc_id: bytes(r.data) for r in prefix_bpe.decode(ids, PATH).collect()} == \
        {i: (t or "").encode() for i, t in rows}
    assert prefix_bpe.encoding_report(documents(spark, []), PATH, P.PATTERN).collect() == []


def test_every_prefix_ends_in_the_last_token_of_its_encoding(vocabulary, lib):
    rnd = random.Random(5)
    for data in [*prose(7, 3), "".join(rnd.choice("ab é日") for _ in range(300))]:
        data = data[:200].encode()
        table = prefix_bpe.Prefixes(vocabulary, data)
        for end in range(1, len(data) + 1):
            want = lib._encode_single_piece(data[:end])
            if len(want) > 1 or vocabulary.edges(want[0])[2]:  # a whole token need not be reached by merges
                assert table.last[end - 1] == want[-1]


def test_tokens_no_merge_reaches():
    """Rank files may hold tokens that no merges lead to, and ties."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {t: 256 + i for i, t in enumerate([b"ab", b"bc", b"abcd", b"cd", b"aa", b"aaa", b"xyz", b"bcd"])}
    lib = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    vocabulary, rnd = prefix_bpe.Vocabulary(ranks), random.Random(2)
    for _ in range(4000):
        s = "".join(rnd.choice("abcdxyz") for _ in range(rnd.randint(1, 12)))
        assert prefix_bpe.Prefixes(vocabulary, s.encode()).ids() == lib.encode_ordinary(s), s


def test_appends_and_edits_equal_a_new_encoding(vocabulary, lib):
    rnd = random.Random(9)

    def letters(most):
        return "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, most)))
    for _ in range(400):
        doc = prefix_bpe.Document(vocabulary, P.PATTERN, letters(80))
        for _ in range(4):
            a = rnd.randint(0, len(doc.text))
            doc.edit(a, min(len(doc.text), a + rnd.choice([0, 0, 1, 3])), letters(4))
            assert doc.ids() == lib.encode_ordinary(doc.text)
            doc.append(letters(4))
            assert doc.ids() == lib.encode_ordinary(doc.text)


def test_an_edit_of_a_long_piece_is_redone_locally(vocabulary, lib):
    rnd = random.Random(4)
    table = prefix_bpe.Prefixes(vocabulary, "".join(rnd.choice("acgt") for _ in range(20_000)).encode())
    before = table.redone
    table.edit(1000, 1003, b"tt")
    assert table.redone - before < 600
    assert table.ids() == lib._encode_single_piece(table.data)


def test_edits_as_a_dataframe(spark, lib):
    text = "one two three four " * 200
    rows = [(1, text, 8, 11, "2"), (2, text, None, None, " five"), (3, None, 0, 5, "new"), (4, "ab", 1, 2, None),
            (5, "", None, None, None)]
    got = prefix_bpe.encode_edits(spark.createDataFrame(
        rows, "doc_id bigint, text string, start int, stop int, insert string"), PATH, P.PATTERN).collect()
    want = {1: text[:8] + "2" + text[11:], 2: text + " five", 3: "new", 4: "a", 5: ""}
    assert {r.doc_id: r.ids for r in got} == {i: lib.encode_ordinary(t) for i, t in want.items()}
    assert max(r.n_redone for r in got if r.doc_id < 3) < 40


def test_small_memo_and_windows_change_nothing(vocabulary, lib, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "LONG_PIECE", 20)
    for window in (7, 60, 5000):
        codec, own, got = prefix_bpe.Codec(vocabulary, P.PATTERN, memo_bytes=30_000, window=window), b"", []
        for code, last in codec.encoded(texts()):
            own += code
            if last:
                got.append(list(struct.unpack(f"<{len(own) // 4}I", own)))
                own = b""
        assert got == [lib.encode_ordinary(t or "") for t in texts()]
        assert codec.used >= 0 and all(len(p) <= 20 for p in codec.code)
