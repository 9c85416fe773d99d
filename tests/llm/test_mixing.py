import re

from pyspark.sql import functions as F

from starloom.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, `Target` double, epochs int"


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def water_fill(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_w = sum(w[s] for s in order if s not in full)
        want = {s: most * sizes[s] if s in full else left * w[s] / open_w for s in order} if open_w else {s: most * sizes[s] for s in order}
        over = {s for s in order if s not in full and want[s] > most * sizes[s]}
        if not over:
            return want
        full |= over


def brute(spark, rows):
    """taken of each (doc_id, text, source): groups in key order, cut at the budget"""
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    keyed = df.select("doc_id", "text", "source", *M._keyed(df, "doc_id", "text")).collect()
    sizes = {}
    for r in keyed:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    want = water_fill(sizes)
    out = {}
    for s, total in sizes.items():
        epochs = min(3, int(want[s] // total)) if total else 0
        rest = round(want[s] - epochs * total)
        groups = {}
        for r in keyed:
            if r.source == s:
                groups.setdefault((r["_key"], r["_tie"], words(r.text)), []).append(r)
        for (_, _, z), same in sorted(groups.items()):
            take = min(max(rest, 0), z * len(same))
            rest -= z * len(same)
            least, more = divmod(take, len(same))
            out[(same[0].doc_id, same[0].text, s)] = [epochs * z + least + (i < more) for i in range(len(same))]
    return sizes, want, out


def check(spark, rows):
    got = M.digests(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes, want, taken = brute(spark, rows)
    assert len(got) == len(rows)
    left = {}
    for d, t, s, *_ in rows:
        left.setdefault(d, []).append((words(t), sizes[s], taken[(d, t, s)].pop()))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.size, r.source_size, r.taken))
        assert 0 <= r.taken <= 3 * r.size
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in left.items()}
    for r in got:
        assert any(abs(r.target - want[s]) < 1e-6 and sizes[s] == r.source_size for s in sizes)
    return got


def test_mix_equals_brute_force(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 7}" if i % 7 else None, "x", 0.1, 1) for i in range(400)]
    rows += [(1000 + i, "big " * 400, "hot", "x", 0.1, 1) for i in range(60)] + [(5000, "one lone\tword\nhere", "tiny", "x", 0.1, 1)]
    got = check(spark, rows)
    for size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - sum({r.target for r in own})) <= 1 or len({r.target for r in own}) > 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, M.digests(spark.createDataFrame(rows, SCHEMA).repartition(13)).collect()))


def test_repeated_and_blank_rows(spark):
    rows = [(7, "a b c", "s", "x", 0.1, 1)] * 9 + [(8, None, "s", "x", 0.1, 1), (None, "", "b", "x", 0.1, 1), (None, "q r", None, "x", 0.1, 1)]
    check(spark, rows)


def test_nothing_to_take(spark):
    assert M.digests(spark.createDataFrame([], SCHEMA)).count() == 0
    got = M.digests(spark.createDataFrame([(1, " \n", "s", "x", 0.1, 1)], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)]


def test_emitted_words_are_the_taken_words(spark):
    rows = [(i, " lead  and\ttail " + "w " * (i % 11), "ab"[i % 5 == 0], "x", 0.1, 1) for i in range(80)] + [(99, None, "a", "x", 0.1, 1)]
    mixed = M.mix(spark.createDataFrame(rows, SCHEMA))
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    out = M.emit(mixed).groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(M.WORD))).alias("n")).collect()
    assert {r.doc_id: r.n for r in out} == {d: n for d, n in taken.items() if n}
    originals = {d: t for d, t, *_ in rows}
    assert all(originals[r.doc_id].startswith(r.text) for r in M.emit(mixed).collect())


def test_budget_is_whole_where_the_cut_falls_into_repeated_rows(spark):
    rows = [(7, "word", "a", "x", 0.1, 1)] * 999 + [(i, "w " * (i % 9 + 1), "b", "x", 0.1, 1) for i in range(100, 300)] + [(9, "v v", None, "x", 0.1, 1)] * 500
    for parts in (1, 17):
        got = M.digests(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
        assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
        by = {}
        for r in got:
            by.setdefault((r.source_size, r.target), []).append(r.taken)
        assert len(by) == 3
        for (_, target), taken in by.items():
            assert abs(sum(taken) - target) <= 0.5
    mixed = M.mix(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert M.emit(mixed).agg(F.sum(F.regexp_count("text", F.lit(M.WORD)))).first()[0] == mixed.agg(F.sum("taken")).first()[0]
