"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern; every match is encoded on its own:
the bytes are the leaves of a sequence, a segment tree over the positions
(nodes of ``FAN`` children) holds for every range the smallest (rank, position)
of two live neighbours, and each merge takes the root - the leftmost pair of
least rank - and updates the three positions it touches, each in logarithmic
time. A match of n bytes therefore takes O(n log n), also when it is one run of
a million letters.

A worker remembers the ids of matches in two generations of at most
``GENERATION_BYTES`` each: when the younger is full it becomes the older one,
whose matches come back when they are met again, so frequent words stay known
however many rare ones pass. Work is per row: no shuffle, and a row's whole
text is encoded.

Defined results: a null text has the ids of the empty text (none); empty
``ids`` and null ``ids`` decode to empty bytes; repeated rows give repeated
results; an empty table gives an empty table; a column of the input named
like the output column is replaced, all others pass through.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import nullable, slices, without

GENERATION_BYTES = 64 << 20
ENTRY_BYTES = 260  # of a remembered match, besides its letters and ids: objects, table slot
CACHE_PIECE_BYTES = 64  # longer matches are encoded anew each time
SHIFT = 4
FAN = 1 << SHIFT  # children of a node of the tree
_NONE = 1 << 62


def read_ranks(path: str) -> bytes:
    """The rank file as bytes (driver side; a vocabulary, a few MB at most)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank -> {token: rank}."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


class Pieces(dict):
    """match -> its ids as little-endian int32 bytes, encoded when first seen;
    the younger generation of what is remembered"""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, piece: str) -> bytes:
        got = self.older.get(piece)
        if got is None:
            raw = piece.encode("utf-8", "replace")
            ids = self.codec.encode_piece(raw)
            got = struct.pack(f"<{len(ids)}i", *ids)
            if len(raw) > CACHE_PIECE_BYTES:
                return got
        if self.held >= GENERATION_BYTES:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[piece] = got
        self.held += ENTRY_BYTES + len(piece) + len(got)
        return got


class Codec:
    """Encoder of one vocabulary and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.pairs = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self._pieces = Pieces(self)

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one match."""
        rank = self.ranks.get
        whole = rank(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        ids = [self.bytes[b] for b in raw]  # of the token that starts here
        if n < 2:
            return ids
        bits = n.bit_length()
        low = (1 << bits) - 1
        # a leaf holds the rank of merging the token that starts there with the next one, and the place
        pairs = self.pairs
        leaves = [_NONE if (r := pairs[a << 8 | b]) < 0 else r << bits | i for i, (a, b) in enumerate(zip(raw, raw[1:]))]
        top, levels = leaves, []
        while len(top) > FAN:
            above = [min(top[at : at + FAN]) for at in range(0, len(top), FAN)]
            levels.append((top, above))
            top = above
        after = list(range(1, n + 2))  # where the token that starts here ends
        before = list(range(-1, n + 1))  # where the token in front of it starts
        last = n - 2
        while (root := min(top)) != _NONE:  # the root's children
            i = root & low
            ids[i] = root >> bits  # a merged token's id is its rank
            gone = after[i]
            end = after[gone]
            after[i] = end
            before[end] = i
            if end < n:
                r = rank(raw[i : after[end]])
                leaves[i] = _NONE if r is None else r << bits | i
            else:
                leaves[i] = _NONE
            if gone <= last:
                leaves[gone] = _NONE
            p = before[i]
            if p >= 0:
                r = rank(raw[p:end])
                leaves[p] = _NONE if r is None else r << bits | p
            if not levels:
                continue
            p, gone = max(p, 0), min(gone, last)
            for below, above in levels:  # p <= i <= gone
                p, i, gone = p >> SHIFT, i >> SHIFT, gone >> SHIFT
                above[i] = min(below[i << SHIFT : (i + 1) << SHIFT])
                if p != i:
                    above[p] = min(below[p << SHIFT : (p + 1) << SHIFT])
                if gone != i:
                    above[gone] = min(below[gone << SHIFT : (gone + 1) << SHIFT])
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian int32 bytes."""
        return b"".join(map(self._pieces.__getitem__, self.split(text)))


_CODECS: dict[tuple[int, str], Codec] = {}
_VOCABULARIES: dict[int, dict[int, bytes]] = {}


def vocabulary(data: bytes) -> dict[int, bytes]:
    """The worker's {id: bytes} for a rank file's bytes (built once per process)."""
    key = hash(data)
    if key not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[key] = {r: t for t, r in parse_ranks(data).items()}
    return _VOCABULARIES[key]


def codec(data: bytes, pattern: str) -> Codec:
    """The worker's codec for a rank file's bytes (built once per process)."""
    key = (hash(data), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(parse_ranks(data), pattern)
    return _CODECS[key]


def encode(df: DataFrame, ranks: bytes, pattern: str, text_col: str = "text", ids_col: str = "ids", keep_text: bool = True, bytes_col: str | None = None) -> DataFrame:
    """``df`` with ``ids_col array<int>``: the ids of every whole text.

    ``ranks``: the rank file's bytes (sent to the executors as a broadcast; a
    vocabulary is bounded), ``pattern``: the split pattern. With ``bytes_col``
    the ids are decoded again in the same pass, as by :func:`decode`.
    """
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast(ranks)
    src = without(df, ids_col, *([bytes_col] if bytes_col else []))
    names = [c for c in src.columns if keep_text or c != text_col]
    extra = [T.StructField(bytes_col, T.BinaryType())] if bytes_col else []
    out = nullable(T.StructType([*(src.schema[c] for c in names), T.StructField(ids_col, T.ArrayType(T.IntegerType())), *extra]))
    all_names = [f.name for f in out]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc = codec(shipped.value, pattern).encode
        token = vocabulary(shipped.value).__getitem__ if bytes_col else None
        for whole in batches:
            for b in slices(whole, text_col):
                got = [enc(t) if t else b"" for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
                ends = np.zeros(len(got) + 1, np.int32)
                np.cumsum([len(g) // 4 for g in got], out=ends[1:])
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), "<i4")))
                cols = [b.column(b.schema.get_field_index(c)) for c in names]
                if token:
                    cols_back = [pa.array([b"".join(map(token, np.frombuffer(g, "<i4").tolist())) for g in got], pa.binary())]
                else:
                    cols_back = []
                yield pa.RecordBatch.from_arrays([*cols, ids, *cols_back], names=all_names)

    return src.mapInArrow(run, out)


def decode(df: DataFrame, ranks: bytes, ids_col: str = "ids", bytes_col: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """``df`` with ``bytes_col binary``: the bytes of the tokens in ``ids_col``."""
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast(ranks)
    src = without(df, bytes_col)
    names = [c for c in src.columns if keep_ids or c != ids_col]
    out = nullable(T.StructType([src.schema[c] for c in names] + [T.StructField(bytes_col, T.BinaryType())]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        token = vocabulary(shipped.value).__getitem__
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                b = whole.slice(start, 512)
                got = [b"".join(map(token, x.values.to_numpy(zero_copy_only=False).tolist())) if x.is_valid else b"" for x in b.column(b.schema.get_field_index(ids_col))]
                cols = [b.column(b.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(got, pa.binary())], names=[*names, bytes_col])

    return src.mapInArrow(run, out)


def digests(df: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256 by
    encoding every text and decoding the ids again."""
    out = encode(df.select("doc_id", "text"), ranks, pattern, keep_text=False, bytes_col="decoded")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
