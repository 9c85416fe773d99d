import binascii
import io
import random

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from starloom.llm import token_files as T
from starloom.llm.queries import op12_token_files
from starloom.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


def plain_ids(definition, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_buffer(definition)
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def expected(definition, rows):
    """(doc_id, start, n_tokens, crc) of rows (doc_id, text) in order."""
    out, at = [], 0
    for (d, _), ids in zip(rows, plain_ids(definition, [t for _, t in rows])):
        out.append((d, at, len(ids), binascii.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def written(docs, **kw):
    sink = io.BytesIO()
    w = T.FileWriter(sink, **kw)
    for d, ids in docs:
        w.add(d, np.array(ids, np.int64))
    w.close()
    return sink.getvalue()


def opened(data):
    return T.FileReader(io.BytesIO(data), len(data))


DOCS = [(None, [7]), (3, []), (4, list(range(25))), (5, [1, 2]), (5, [3]), (9, [65535, 0, 2])]


def test_round_trip_and_plain_tools():
    data = written(DOCS, frame_ids=8)
    r = opened(data)
    assert [list(np.frombuffer(r.raw(i), "<u4")) for i in range(6)] == [ids for _, ids in DOCS]
    assert [None if n else int(d) for d, n in zip(r.doc_ids, r.null)] == [d for d, _ in DOCS]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert list(np.frombuffer(plain, "<u4")) == [i for _, ids in DOCS for i in ids]


def test_reader_decompresses_only_what_is_asked_for():
    data = written([(d, [d] * 10) for d in range(1000)], frame_ids=100)
    r = opened(data)
    assert r.frames_read == 0 and len(r.frame_ends) == 100
    (place,) = r.places([512])
    assert list(np.frombuffer(r.raw(int(place)), "<u4")) == [512] * 10
    assert r.frames_read == 1


def test_frames_end_behind_documents_and_long_documents_are_cut():
    r = opened(written([(1, [1] * 60), (2, [2] * 60), (3, [3] * 250), (4, [4])], frame_ids=100))
    assert list(np.diff(np.concatenate(([0], r.frame_ends)))) == [60, 60, 100, 100, 51]


@pytest.mark.parametrize("damage", ["flip", "cut", "empty", "table", "index"])
def test_damage_is_found(damage):
    data = bytearray(written(DOCS, frame_ids=8, level=1))
    n = len(DOCS)
    if damage == "flip":
        data[12] ^= 1
    elif damage == "cut":
        del data[-5:]
    elif damage == "empty":
        data.clear()
    elif damage == "table":
        data[-12] ^= 255
    else:
        data[data.index(T.INDEX_MAGIC) + 14] ^= 1
    with pytest.raises(T.CorruptFile):
        r = opened(bytes(data))
        for i in range(n):
            r.raw(i)


def test_query_equals_plain_encoding(spark, definition):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in op12_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(definition, rows)


def test_many_files_and_asked_documents(spark, definition):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    root = scratch_path(spark, "test-token-files")
    T.write(docs, root, definition, 2, frame_ids=500, file_ids=5000)
    listed = T.files(spark, root)
    assert listed.count() > 8
    ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    some = [ids[0], ids[17], ids[-1], -5]
    got = {r["doc_id"]: r for r in T.read(spark, root, some).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.where(F.col("doc_id").isin(some)).collect()}
    assert set(got) == set(texts)
    for d, r in got.items():
        assert r["ids"] == plain_ids(definition, [texts[d]])[0] and r["n_tokens"] == len(r["ids"])


def test_defined_cases(spark, definition):
    long = "word " * 50_000
    rows = [(None, "x", 1), (2, None, 1), (1, "", 1), (7, long, 1), (5, "same", 1), (5, "same", 1), (5, "other <|endoftext|>", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, START long")
    root = scratch_path(spark, "test-token-files")
    T.write(df, root, definition, 2)
    got = sorted((tuple(r) for r in T.digests(df, root + "-2", definition, 2).collect()), key=lambda r: r[1])
    five = sorted(["same", "same", "other <|endoftext|>"], key=lambda t: spark.sql("SELECT xxhash64(:t) h", {"t": t}).first()["h"])
    assert got == expected(definition, [(None, "x"), (1, ""), (2, None), *((5, t) for t in five), (7, long)])
    assert sorted(len(r["ids"]) for r in T.read(spark, root).collect()) == sorted(r[2] for r in got)


def test_stretches_do_not_change_ids(definition, monkeypatch):
    monkeypatch.setattr(T, "MEMORY", 50)
    r = random.Random(5)
    signs = ["a", "it's", "  ", " ", "\n", "\t ", " \n", "\u00a0", "\u2003", "\u3000x", "\x1f", "\x85", "é", "ß9", "1234", "...", "'ll", "日本 語", "\u200b", "\u180e", "🙂", "<|endoftext|>", "x" * 70, "I've", "'", "''s", "a'd.", "(b)", "~", "\x7f", "\x00", "Größe", "x²½", "×÷", "\u00ad", "«à»", "\r\n", "\x0b"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(400)]
    encode = T.Encoder(definition)
    assert encode.byte_level
    assert [np.frombuffer(encode(t), "<u4").tolist() + [2] for t in texts] == plain_ids(definition, texts)
    words = T.Encoder(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
    assert not words.byte_level
    assert np.frombuffer(words("A b"), "<u4").tolist() == words.tokenizer.encode("A b", add_special_tokens=False).ids


def test_empty_table(spark, definition):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert T.digests(df, scratch_path(spark, "test-token-files"), definition, 2).collect() == []


def test_files_of_lost_attempts_do_not_count(spark, definition):
    root = scratch_path(spark, "test-token-files")
    fs, folder = T._file_system(root)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/ids-000000-00000-lost.zst") as f:
        f.write(b"half a file")
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    assert T.digests(df, root, definition, 2).count() == 2
    from pyarrow import fs as arrow_fs

    names = {i.base_name for i in fs.get_file_info(arrow_fs.FileSelector(folder))}
    assert "ids-000000-00000-lost.zst" not in names
