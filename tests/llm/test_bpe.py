import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import bpe
from starloom.llm import queries as Q

SF = "/root/testdata/sf0.001"
RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def exact():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(codec, text):
    raw = codec.encode(text)
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


def test_all_documents(spark, exact):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = Q.op1_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = exact.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabbcde ’'sté中😀\n\t\x1c\x85᠎019%#-")), max_size=60))
def test_any_text(exact, text):
    codec = bpe.codec(RANKS, P.PATTERN)
    ids = ids_of(codec, text)
    assert ids == exact.encode_ordinary(text)
    vocabulary = bpe.vocabulary(RANKS)
    assert b"".join(vocabulary[i] for i in ids) == text.encode()


def test_long_matches(exact):
    rng = random.Random(1)
    codec = bpe.codec(RANKS, P.PATTERN)
    for text in ("a" * 30_000, "abc" * 9_000, " " * 4_000, "".join(rng.choice("etaoin") for _ in range(40_000)), "é" * 9_999):
        assert ids_of(codec, text) == exact.encode_ordinary(text)


def test_memory_of_words_is_bounded(monkeypatch, exact):
    monkeypatch.setattr(bpe, "GENERATION_BYTES", 5 * bpe.ENTRY_BYTES)
    codec = bpe.Codec(bpe.parse_ranks(RANKS), P.PATTERN)
    text = " ".join(f"frequent word{i}" for i in range(200))
    assert ids_of(codec, text) == exact.encode_ordinary(text)
    known = codec._pieces
    assert len(known) <= 5 and len(known.older) <= 5
    assert " frequent" in known or " frequent" in known.older


def test_odd_rows(spark, exact):
    rows = [(1, None, "x"), (2, "", "x"), (3, "same text", "x"), (3, "same text", "x"), (None, "z" * 200_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    out = bpe.encode(df, RANKS, P.PATTERN)
    assert out.columns == ["doc_id", "text", "ids"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r.ids)
    assert got[1] == got[2] == [[]] and got[3] == [exact.encode_ordinary("same text")] * 2
    assert got[None] == [exact.encode_ordinary("z" * 200_000)]
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0
    back = bpe.decode(spark.createDataFrame([(1, None, "c"), (2, [], "c"), (3, got[3][0], "c")], "n long, ids array<int>, Decoded string"), RANKS).collect()
    assert {r.n: bytes(r.decoded) for r in back} == {1: b"", 2: b"", 3: b"same text"}
    empty = bpe.digests(df.where("doc_id < 3"), RANKS, P.PATTERN).collect()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in empty} == {(0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())}
