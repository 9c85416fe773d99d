import hashlib
import random

from pyspark.sql import functions as F

from starloom.llm import fingerprint as S

SF = "/root/testdata/sf0.001"


def check(rows, got):
    key = lambda r: (r[0] is None, -(r[0] or 0))
    order = sorted(rows, key=key)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t) // 3
        new = t[: len(t) - n] + nxt[:n]
        r = by[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert int(r.fingerprint, 16) == S.fingerprint(t) and int(r.edited_fingerprint, 16) == S.fingerprint(new)
        assert r.near_edited == S.likeness(S.fingerprint(t), S.fingerprint(new))
        assert r.near_next == S.likeness(S.fingerprint(t), S.fingerprint(nxt))
        want = sum((int(o.fingerprint, 16) ^ int(r.fingerprint, 16)).bit_count() <= 3 for o in got)
        assert r.n_near == want


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = S.digests(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    long = [r for r in got if r.n_chars > 600]
    assert sum(r.near_edited for r in long) / len(long) > 0.55
    assert sum(r.near_next for r in long) / len(long) < 0.3


def test_odd_rows(spark):
    rows = [(None, "no id at all here"), (1, None), (2, ""), (3, "one"), (4, "two words"), (5, "Ünï cödé 😀 x y z " * 9), (6, "w " * 90_000), (7, "same text of five words"), (9, "same text of five words")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    check(rows, S.digests(df).collect())
    alone = S.digests(df.where("doc_id = 5")).collect()
    check([rows[5]], alone)
    assert S.digests(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 40 + [(2, "x y z")], "doc_id long, text string")
    got = S.digests(df).collect()
    assert len(got) == 41 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert sorted({r.n_near for r in got}) == [1, 40]


def test_near_counts_equal_brute_force(spark):
    rng = random.Random(2)
    values = []
    for _ in range(12):
        c = rng.getrandbits(128)
        values += [c ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 4))) for _ in range(12)]
    c = rng.getrandbits(128)
    values += [c ^ (i << 20) for i in range(2500)]  # one run of several squares
    df = spark.createDataFrame([(f"{v:032x}",) for v in values], "fingerprint string")
    got = {r.fingerprint: r.n_near for r in S.near_counts(df).collect()}
    for v in rng.sample(values, 300):
        assert got[f"{v:032x}"] == sum((v ^ o).bit_count() <= 3 for o in values)
    assert S.near_counts(df.where(F.lit(False))).count() == 0
