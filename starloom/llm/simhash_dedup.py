"""SimHash near-duplicates by a byte-position inverted index.

Fingerprints: a text is lower-cased (A-Z), cut into words at ASCII white
space, and its word shingles - repeats included - are hashed with XXH64
(seed 42); a bit of the 64-bit fingerprint is set if it is set in more than
half of the hashes. No words: fingerprint zero.

Search: two fingerprints that differ in at most k bits differ in at most k of
their 8 positional bytes, so they share at least 8 - k of them. An index on
single positional bytes would put 1/256 of all fingerprints in every list and
tally pairs inside those lists, which grows with the square of the corpus.
The index here is therefore keyed by every choice of 8 - k positions together
with the bytes there: exactly the pairs that reach the guaranteed minimum
meet in a list, and a list holds at most 256**k different fingerprints
however large the corpus is. Inside a list the tally of shared positional
bytes and then the bit distance are verified for each candidate pair; long
lists look up the few values within k bits of each member instead of trying
all pairs. A list emits a spanning forest of its verified links, which keeps
connectivity whole and the output linear.

Equal fingerprints are one entry of the index, so groups of exact copies of
any size cost one row. Components come from :mod:`starloom.llm.components`.

Defined results: null and empty texts have fingerprint zero and link like any
other; repeated rows are members of one group; a group whose ids are all null
has a null component id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize, nullable, slices, without
from starloom.llm.components import connected_components, local_roots

SEED = 42
_ALL_PAIRS_UP_TO = 96  # list length up to which trying all pairs is the cheaper exact way


def simhash(raw: bytes, shingle: int) -> int:
    """64-bit fingerprint of a UTF-8 text."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        h, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [h(join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        some = np.array(hashes[at : at + 65536], dtype=">u8")
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", shingle: int = 3, out_col: str = "fp") -> DataFrame:
    """``df`` without its text, with ``out_col long``: the fingerprint's bits."""
    src = without(df, out_col)
    names = [c for c in src.columns if c != text_col]
    out = nullable(T.StructType([src.schema[c] for c in names] + [T.StructField(out_col, T.LongType())]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in slices(whole, text_col):
                raw = b.column(b.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                bits = np.array([simhash(t, shingle) if t else 0 for t in raw], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(bits)], names=[*names, out_col])

    return src.mapInArrow(run, out)


def verified(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different fingerprints (uint64) that share 8 - k
    positional bytes at least and differ in k bits at most."""
    n = len(values)
    if n <= _ALL_PAIRS_UP_TO:
        i, j = np.triu_indices(n, 1)
        x = values[i] ^ values[j]
    else:
        order = np.argsort(values)
        ranked = values[order]
        free = [s for s in range(64) if np.bitwise_or.reduce(values ^ values[0]) >> np.uint64(s) & np.uint64(1)]
        found_i, found_j = [], []
        for bits in range(1, k + 1):
            for flip in combinations(free, bits):
                mask = np.uint64(sum(1 << s for s in flip))
                at = np.searchsorted(ranked, ranked ^ mask)
                at[at == n] = 0
                hit = np.flatnonzero((ranked[at] == ranked ^ mask) & (ranked < ranked ^ mask))
                found_i.append(order[hit])
                found_j.append(order[at[hit]])
        i, j = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_i, found_j))
        x = values[i] ^ values[j]
    shared = 8 - (x.reshape(-1, 1).view(np.uint8) != 0).sum(axis=1)
    keep = (shared >= 8 - k) & (np.bitwise_count(x) <= k)
    return i[keep], j[keep]


def links(fps: DataFrame, max_bits: int = 2, col: str = "fp") -> DataFrame:
    """(a, b): verified links between different fingerprints that span the
    same components as all links within ``max_bits`` (1 to 3) bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")
    masks = [sum(0xFF << 8 * p for p in keep) for keep in combinations(range(8), 8 - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(n).alias("at"), F.col(col).bitwiseAND(F.lit(m).cast("long")).alias("key")) for n, m in enumerate(signed)])
    posting = fps.select(col).distinct().select(col, F.explode(keys).alias("k"))
    lists = posting.groupBy("k.at", "k.key").agg(F.collect_list(col).alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            a_out, b_out = [], []
            for one in b.column(0):
                v = one.values.to_numpy(zero_copy_only=False).astype(np.int64)
                if len(v) == 2:
                    x = int(v[0] ^ v[1]) & 0xFFFFFFFFFFFFFFFF
                    if x.bit_count() <= max_bits and sum(byte == 0 for byte in x.to_bytes(8, "big")) >= 8 - max_bits:
                        a_out.append(v[:1])
                        b_out.append(v[1:])
                    continue
                i, j = verified(v.view(np.uint64), max_bits)
                root = local_roots(len(v), i, j)
                child = np.flatnonzero(root != np.arange(len(v)))
                a_out.append(v[child])
                b_out.append(v[root[child]])
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out), pa.int64()), pa.array(np.concatenate(b_out), pa.int64())], names=["a", "b"])

    return lists.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``fp`` and ``component_id``, the
    smallest id reachable over links of ``max_bits`` bits at most."""
    fps = materialize(fingerprints(df.select(id_col, text_col), text_col, shingle), "simhash")
    return label(fps, id_col, max_bits)


def label(fps: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """``fps`` (with column ``fp``) with ``component_id`` and ``grp`` (a
    fingerprint that stands for the group) of each row."""
    groups = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = connected_components(links(fps, max_bits), "a", "b").select(F.col("node").alias("fp"), "root")
    linked = groups.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    merged = linked.join(smallest, "root").select("fp", "root", "smallest")
    ids = groups.join(merged, "fp", "left").select("fp", F.coalesce("root", "fp").alias("grp"), F.coalesce("smallest", "least").alias("component_id"))
    # written, so that the join deals both sides out anew and AQE can split a fingerprint that many rows have
    return fps.join(materialize(ids, "simhash"), "fp")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``df`` that stay: one of each group, the one with the
    smallest id (null last; then by a hash of its text)."""
    src = without(df, "_one", "_again")
    row = [F.xxhash64(F.lit(n), F.col(text_col)).alias(f"_h{n}") for n in (1, 2)]
    narrow = fingerprints(src.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *row), "_text", shingle)
    labelled = label(materialize(narrow, "simhash"), "_id", max_bits)
    first = F.min(F.struct(F.col("_id").isNull().alias("_null"), "_id", "_h1", "_h2")).alias("_one")
    keep = labelled.groupBy("grp").agg(first).select("_one")
    times = labelled.groupBy("_id", "_h1", "_h2").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("_one._id").eqNullSafe(F.col("_id")) & (F.col("_one._h1") == F.col("_h1")) & (F.col("_one._h2") == F.col("_h2"))
    kept = materialize(keep.join(times, same).select("_one", (F.col("n") > 1).alias("_again")), "simhash")
    mine = F.col("_one._id").eqNullSafe(F.col(id_col)) & (F.col("_one._h1") == row[0]) & (F.col("_one._h2") == row[1])
    stays = src.join(kept, mine)
    columns = [F.col(f"`{c}`") for c in src.columns]
    repeated = stays.where("_again").dropDuplicates(["_one"])  # a row that occurs several times stays once
    return stays.where("NOT _again").select(*columns).unionByName(repeated.select(*columns))


def digests(df: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, fingerprint (16 hex digits), component_id."""
    out = near_duplicates(df.select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
