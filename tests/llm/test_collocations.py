import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.llm import collocations as C

LOW = {c: c + 32 for c in range(65, 91)}


def counted(rows):
    """Counter of (lang, words) of one to four words, by plain loops."""
    out = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    out[(lang or "und", tuple(w[i : i + k]))] += 1
    return out


def expected(rows, min_count, top):
    f = counted(rows)
    heavy = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}

    def covered(lang, ws, a):
        return any(x == lang and len(v) > len(ws) and 100 * b >= 80 * a and any(v[i : i + len(ws)] == ws for i in range(len(v))) for (x, v), b in heavy.items())

    by_lang = {}
    for (lang, ws), a in heavy.items():
        if covered(lang, ws, a):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws)))
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), l, r))
    out = []
    for lang, found in by_lang.items():
        n = sum(c for (x, ws), c in f.items() if x == lang and len(ws) == 1)
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def mined(spark, rows, **kw):
    return C.mine(spark.createDataFrame(rows, "lang string, text string"), **kw)


def texts(seed, n):
    r = random.Random(seed)
    passage = "One two THREE four five, six seven eight nine ten eleven twelve thirteen; the end"
    words = ["a", "b", "c", "d", "É", "ß", "x\x00y", "the", "THE", " "]
    out = []
    for i in range(n):
        text = " ".join(r.choice(words) + r.choice(["", "", "", ".", ",", "\n", "\t", "!"]) for _ in range(r.randrange(40)))
        out.append((r.choice(["en", "de", None, "und"]), text + (passage if i % 3 == 0 else "") + " a a a a a"))
    return out


@pytest.mark.parametrize("seed,min_count,top", [(1, 3, 2000), (2, 8, 5)])
def test_equals_plain_counting(spark, seed, min_count, top):
    rows = texts(seed, 60) + [(None, None), ("en", ""), ("en", " . \t,"), ("de", "w" * 3000)]
    got = mined(spark, rows, min_count=min_count, top=top)
    assert sorted(tuple(r) for r in got.collocations.collect()) == expected(rows, min_count, top)


def test_counts_follow_from_windows_and_piece_ends(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_WORDS", 50)  # many partial counts of one phrase
    rows = texts(3, 40)
    df = spark.createDataFrame(rows, "lang string, text string")
    for vocabulary in (C.VOCABULARY, 3):  # numbered words, and windows of text
        got = {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in C.count_phrases(df, min_count=2, vocabulary=vocabulary).collect()}
        assert got == {g: c for g, c in counted(rows).items() if len(g[1]) == 1 or c >= 2}


def test_paths_are_the_maximal_unary_ones(spark):
    rows = [("en", "s one two three four five six"), ("en", "one two three four five six t")] * 4 + [("en", "three four five nine")] * 5
    got = sorted(tuple(r) for r in mined(spark, rows, min_count=3).paths.collect())
    assert got == [
        ("en", "five six t", 3, 4),
        ("en", "four five nine", 3, 5),
        ("en", "four five six", 3, 8),
        ("en", "one two three four", 4, 8),
        ("en", "s one two", 3, 4),
        ("en", "three four five", 3, 13),
    ]


def test_a_long_passage_is_one_path(spark):
    passage = " ".join(f"w{i}" for i in range(300))
    got = mined(spark, [("en", passage)] * 5 + [("fr", "a a a a a a a")] * 2, min_count=5)
    assert [(r["phrase"], r["f"]) for r in got.paths.where("lang = 'en'").collect()] == [(passage, 5)]
    assert got.collocations.where("lang = 'en'").count() == 297


def test_empty_and_clashing_columns(spark):
    got = C.mine(spark.createDataFrame([], "lang string, text string, rank int"))
    assert got.collocations.collect() == [] and got.counts.collect() == [] and got.paths.collect() == []
    df = spark.createDataFrame([("en", "a b")] * 3, "lang string, text string").withColumn("score", F.lit(1)).withColumn("GRAM", F.lit("x"))
    got = C.mine(df, min_count=3).collocations.collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", 3, 3, 3, 6, 1_000_000)]


def test_scores_pass_64_bits(spark):
    big = 5 * 10**12
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big)], "lang string, phrase string, k int, f long")
    got = C._scored(counts.where("k = 2").select("lang", "phrase", "k", F.col("f").alias("a")), counts, 30).collect()
    assert [tuple(r) for r in got] == [("en", "a b", big, big, big, 1_000_000)]
