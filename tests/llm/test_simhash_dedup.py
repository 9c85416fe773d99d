import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from starloom.llm import simhash_dedup as S
from starloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, `Component_ID` string"


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_of_random_and_long_graphs(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 200 + i) for i in range(40)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    pairs = [(a, b) for a, b in edges if a is not None and a != b]
    want = brute_components({x for p in pairs for x in p}, pairs)
    assert got == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_links_equal_brute_force(spark):
    rng = random.Random(9)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(25):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(6)}
    dense = rng.getrandbits(64)  # a long posting list: many values that differ in two bytes only
    fps |= {dense ^ rng.getrandbits(16) << 24 for _ in range(700)}
    values = sorted(fps)
    arr = np.array(values, np.uint64)
    pairs = [(i, int(j)) for i in range(len(arr)) for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 2) if j > i]
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)] + [(10_000, dense - (1 << 64) if dense >> 63 else dense)] * 3
    if dense not in fps:
        rows = rows[: len(values)]
    want = brute_components(range(len(values)), pairs)
    got = S.label(spark.createDataFrame(rows, "doc_id long, fp long"), "doc_id", 2).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (want[r.doc_id] if r.doc_id < 10_000 else want[values.index(dense)])


def test_all_pairs_and_lookup_agree():
    rng = random.Random(3)
    values = np.array(sorted({rng.getrandbits(12) << 40 for _ in range(400)}), np.uint64)
    i, j = S.verified(values, 2)
    want = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if int(values[a] ^ values[b]).bit_count() <= 2}
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want


def test_fingerprints_and_odd_rows(spark):
    texts = [None, "", " \t\n", "One", "one  TWO", "a b c d a b c", "É é ß  x y", "z " * 70_000, "a b c d a b c", "😀 \x1c q r"]
    rows = [(i, t, "old", "old") for i, t in enumerate(texts)] + [(None, "a b c d a b c", None, None), (3, "One", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = S.digests(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t in enumerate(texts):
        assert by[i].fingerprint == f"{plain_fingerprint(t):016x}"
    assert by[0].component_id == by[1].component_id == by[2].component_id == 0
    assert [r.component_id for r in got if r.doc_id is None] == [5]


def test_empty_table(spark):
    df = spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    assert S.digests(df).collect() == []


def test_bits_are_bounded(spark):
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([], "fp long"), 4)
