import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from starloom.llm import embed_join as J
from starloom.llm import queries as Q
from tests.llm.test_simhash_dedup import brute_components

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, `Component_ID` int"


def brute(rows):
    ok = {}
    for at, (i, e, label, *_) in enumerate(rows):
        if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            ok[at] = (label, np.asarray(e, np.float32).astype(np.float64))
    pairs, n = [], dict.fromkeys(range(len(rows)), 0)
    for a in ok:
        for b in ok:
            if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]):
                x, y = ok[a][1], ok[b][1]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    pairs.append((a, b))
                    n[a] += 1
                    n[b] += 1
    root = brute_components(range(len(rows)), pairs)
    least = {}
    for at, r in root.items():
        if rows[at][0] is not None:
            least[r] = min(least.get(r, rows[at][0]), rows[at][0])
    return sorted(((rows[at][0], n[at], least.get(root[at])) for at in range(len(rows))), key=repr)


def same(spark, rows, pivots=J.PIVOTS):
    got = J.near_duplicates(spark.createDataFrame(rows, SCHEMA), pivots=pivots).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def clustered(n, seed, length=16, noise=(0.02, 0.06, 0.2)):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, length))
    out = []
    for i in range(n):
        e = centres[i % 12] + rng.normal(size=length) * noise[i % 3] * np.linalg.norm(centres[i % 12]) / 2
        out.append((i, (e * rng.uniform(0.1, 9)).astype(np.float32).tolist(), i % 2, "x", 1))
    return out


def test_clusters_equal_brute_force(spark, monkeypatch):
    rows = clustered(260, 4)
    rows += [(1000 + i, rows[3][1], 1, "x", 1) for i in range(30)] + [(2000, [2 * x for x in rows[3][1]], 1, "x", 1)]
    random.Random(1).shuffle(rows)
    same(spark, rows)
    same(spark, rows, pivots=3)
    monkeypatch.setattr(J, "BLOCK", 17)  # many blocks in each cell
    same(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [None, 1.0], [nan, 1.0], [inf, 1.0]]
    rows = [(i, e, 1, "x", 1) for i, e in enumerate(bad)] + [(10 + i, e, 1, "x", 1) for i, e in enumerate(bad)]
    rows += [(20, [1.0, 0.0], None, "x", 1), (21, [1.0, 0.0], None, "x", 1), (22, [1.0, 0.0], 1, "x", 1), (22, [1.0, 0.0], 1, "x", 1), (None, [1.0, 0.01], 1, "x", 1)]
    rows += [(30, [1.0, 0.0, 0.0], 1, "x", 1), (31, [1e-30, 0.0], 1, "x", 1), (32, [3e38, 1e30], 1, "x", 1), (33, [-0.0, 5.0], 1, "x", 1), (34, [0.0, 5.0], 1, "x", 1)]
    same(spark, rows)
    assert J.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    cols = "vec_id n_links component_id kept".split()
    got = Q.op5_embedding_near_dedup(spark, "/root/testdata/sf0.01").select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT {','.join(cols)} FROM ({J.SQL})").fetchall())


def test_replicas_stay_few_on_clusters(spark):
    rows = spark.createDataFrame(clustered(300, 8, noise=(0.01, 0.01, 0.01)), SCHEMA)
    entries = rows.select(F.col("vec_id").alias("rid"), F.lit(1).cast("long").alias("n"), "label", F.col("embedding").alias("v"))
    pivots = [r["embedding"] for r in rows.where("vec_id < 12").collect()]
    cells = J._cells(entries, pivots, 0.98)
    assert cells.where("NOT replica").count() == 300 and cells.where("replica").count() < 600
