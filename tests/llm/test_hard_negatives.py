import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives as H

COLUMNS = "vec_id long, embedding array<double>, label int"


def expected(rows):
    """Rows (vec_id, embedding, label), by plain loops over whole numbers."""
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (i, lab, q) in enumerate(ok):
        if i is None or i % 50:
            continue
        others = [(sum(x * y for x, y in zip(q, v)), j, other == lab) for b, (j, other, v) in enumerate(ok) if b != a and len(v) == len(q)]
        for p, j, _ in sorted((r for r in others if r[2]), key=last)[:5]:
            fits = sorted((r for r in others if not r[2] and 50 * p <= 100 * r[0] <= 95 * p), key=last)[:3]
            out += [(i, j, rank, n, p, s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, schema=COLUMNS):
    got = H.mine(spark.createDataFrame(rows, schema))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def clustered(seed, n, dims=6, clusters=8):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    at = r.integers(0, clusters, n)
    v = centres[at] + 0.3 * r.normal(size=(n, dims))
    return [(int(i) * 10, row.tolist(), int(lab)) for i, row, lab in zip(range(n), v, np.where(r.random(n) < 0.4, 1, at % 4))]


def test_equals_plain_loops_in_many_leaves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "LEAF", 20)
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "QUERIES", 8)
    rows = clustered(1, 500)
    copies = [(20_000 + i, rows[3][1], i % 3) for i in range(120)]  # a hot leaf of equal vectors
    assert mined(spark, rows + copies) == expected(rows + copies)


def test_defined_cases(spark):
    bad = [(50, None, 1), (100, [], 1), (150, [1.0, None], 1), (200, [1.0, math.nan], 1), (250, [math.inf, 1.0], 1), (300, [1.0, 1.0], None), (350, [0.0, 0.0], 1)]
    good = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (None, [1.0, 0.4], 1), (3, [0.9, 0.6], 1), (None, [0.7, 0.4], 2), (4, [0.7, 0.4], 2), (4, [0.7, 0.4], 2), (5, [0.6, 0.4], 2), (-50, [-1.0, -0.5], 3), (400, [1.0], 1), (6, [0.8], 2), (7, [1.1], 1)]
    got = mined(spark, bad + good)
    assert got == expected(bad + good) and got
    assert mined(spark, bad[:6]) == [] and mined(spark, []) == []


def test_wide_whole_numbers_are_exact(spark):
    big = 2.0**22
    rows = [(0, [big, 1.0, -3.0], 1), (1, [big + 1, 1.0, 0.25], 1), (2, [big / 2, 0.0, 7.0], 2), (3, [big * 0.7, -1.0, 7.0], 2), (4, [big * 0.9499999, 5.0, 0.0], 2)]
    assert mined(spark, rows) == expected(rows)
    assert (H.scores(np.array([[2.0**40, 3.0]]), np.array([[2.0**20 + 1, 5.0]])) == 2**60 + 2**40 + 15).all()


def test_scores_beyond_64_bits_are_refused():
    with pytest.raises(OverflowError):
        H.scores(np.array([[2.0**40]]), np.array([[2.0**40]]))


def test_clashing_columns(spark):
    rows = clustered(2, 60)
    df = spark.createDataFrame(rows, COLUMNS).withColumn("ID", F.lit("x")).withColumn("rank", F.lit(0)).withColumn("leaf", F.lit(1))
    assert sorted((tuple(r) for r in H.mine(df).collect()), key=repr) == expected(rows)


def test_ranges_eliminate_siblings_and_lose_nothing():
    r = np.random.default_rng(3)
    centres = 10 * r.normal(size=(20, 8))
    x = np.repeat(centres, 50, axis=0) + 0.2 * r.normal(size=(1000, 8))
    node = H.Node.without_ranges(H.spread_points(x[::7], 16))
    d = H.distances(x, node.points)
    home = d.argmin(axis=1)
    for j in range(len(node.points)):
        node.least[:, j], node.most[:, j] = d[home == j].min(axis=0), d[home == j].max(axis=0)
    q = centres[:10] + 0.2 * r.normal(size=(10, 8))
    to = H.distances(q, x)
    inner, outer = np.full(10, 0.1), np.full(10, 2.0)
    met = H.visits(node, H.distances(q, node.points), inner, outer, 1e-6)
    needed = np.zeros_like(met)
    for i, j in zip(*np.nonzero((to >= inner[:, None]) & (to <= outer[:, None]))):
        needed[i, home[j]] = True
    assert not (needed & ~met).any()
    assert met.mean() < 0.2
    far = H.visits(node, H.distances(q, node.points), np.full(10, 2.0), np.full(10, 1e9), 1e-6)
    assert not far[np.arange(10), H.distances(q, node.points).argmin(axis=1)].all()  # wholly inside the inner circle
