import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import toxicity as X

WORDS = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "men", "ro", "sta", "ve") for b in ("n", "r", "ssa", "tion", "l", "mo")]
BAD = ["grumblik", "vilezor", "grumblosh"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(3, 60))
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "xx" if i % 3 else "yy", 0.7, "clash"))
        labels.append((i, toxic))
    return rows, labels


DOCS = "doc_id long, text string, lang string, score double, held_out string"


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus(500)
    odd = [(900, None, None, 0.1, None), (901, "", "xx", 0.1, None), (None, "grumblik vilezor", "xx", 0.1, None)] + rows[:2]
    docs = spark.createDataFrame(rows + odd, DOCS)
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), labels[5]], "doc_id long, toxic int")
    return rows, dict(labels), X.digests(docs, lab).collect()


def test_held_out_rows_are_classified(scored):
    rows, labels, got = scored
    assert len(got) == len(rows) + 5
    by = {r.doc_id: r for r in got}
    for i, _ in labels.items():
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= by[i].score <= 1 and by[i].predicted == int(by[i].score >= 0.5)
    out = [i for i in labels if by[i].held_out]
    assert sum(by[i].predicted == labels[i] for i in out) >= 0.97 * len(out)


def test_odd_rows_and_equal_texts(scored):
    rows, _, got = scored
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[900] == by[901] and by[900][0] < 0.5
    assert len(by[0]) == 2 and len(set(by[0])) == 1
    assert by[None][0] > 0.5


def test_no_labels_and_one_class(spark):
    docs = spark.createDataFrame([(1, "a b", "xx", 0.0, ""), (2, None, None, 0.0, "")], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert max(r.score for r in X.digests(docs, none).collect()) < 1e-9
    assert X.digests(docs.limit(0), none).count() == 0
    only = X.train([np.array([0])], [[1, 2]], np.array([1]))
    assert X.Scorer(only).score("anything") > 0.99


def test_blocks_of_a_long_text_pool_like_the_whole():
    rows, labels = corpus(120)
    v = X.Vocabulary()
    ids = [v.ids(r[1]) for r in rows]
    model = X.train(ids, v.rows, np.array([y for _, y in labels]))
    rng = random.Random(4)
    words = rng.choices(WORDS, k=40_000)
    words[16_383:16_385] = ["grumblik", "vilezor"]
    whole = model.pooled(model.projections(model.word_vectors([X.parts(w) for w in words])))[0]
    assert np.allclose(X.Scorer(model)._pooled(words), whole, atol=1e-5)


def test_texts_scored_together_score_like_one(monkeypatch):
    rows, labels = corpus(120)
    v = X.Vocabulary()
    model = X.train([v.ids(r[1]) for r in rows], v.rows, np.array([y for _, y in labels]))
    odd = ["", " .,", "a", "grumblik", "", "\U0001d49c\U0001d49c\U0001d49c\U0001d49c\U0001d7d8 b\xe9t\xe9 \u65e5\u672c\u8a9e\u306e", "x" * 70]
    texts = odd + [r[1] for r in rows] + [" ".join(random.Random(5).choices(WORDS, k=20_000))] + odd
    one = X.Scorer(model)
    want = [one.score(t) for t in texts]
    assert X.Scorer(model).scores(texts) == want and X.Scorer(model).scores([]) == []
    monkeypatch.setattr(X, "BLOCK_WORDS", 200)  # other groups, and blocks of the long text
    assert X.Scorer(model).scores(texts) == pytest.approx(want, abs=1e-6)
    monkeypatch.setattr(X, "CACHE_WORDS", 20)
    assert X.Scorer(model).scores(texts[:-8]) == want[:-8]


def test_rows_of_many_words_are_those_of_each():
    words = [w for t in ("a b\xe9 \u65e5\u672c\u8a9e\u306e\u30c6 \U0001d49c\U0001d49c\U0001d49c\U0001d49c\U0001d7d8 \U0001d49cx\u65e5\xe9y _1", " ".join(WORDS), "y" * 32) for w in X.WORD.findall(t)]
    rows, sizes = X.parts_of(words)
    assert [r.tolist() for r in np.split(rows, np.cumsum(sizes)[:-1])] == [X.parts(w) for w in words]
    assert [len(a) for a in X.parts_of([])] == [0, 0]
    known = X.KnownRows()
    known.learn([words[:3], words])
    assert [known[w].tolist() for w in words] == [X.parts(w) for w in words]


def test_documents_are_read_once_to_learn(spark):
    rows, labels = corpus(200)
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = spark.createDataFrame(rows, DOCS).withColumn("text", F.udf(seen, "string")("text"))
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert 0 < read.value <= len(rows) and X.Scorer(model).score("grumblik vilezor") > 0.5


def test_thresholds():
    assert X.best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0])) == pytest.approx(0.55)
    assert X.best_threshold(np.array([0.4, 0.4, 0.2]), np.array([1, 0, 0])) == pytest.approx(0.3)


def test_labels_of_other_documents_change_nothing(spark):
    rows, labels = corpus(200)
    docs, own = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    foreign = spark.range(10_000, 60_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    plain = {r.doc_id: r.score for r in X.digests(docs, own).collect()}
    assert {r.doc_id: r.score for r in X.digests(docs, own.union(foreign)).collect()} == plain


def test_long_documents_are_learnt_from(spark, monkeypatch):
    rows, labels = corpus(300)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    plain = {r.doc_id: r.predicted for r in X.digests(docs, known).collect()}
    monkeypatch.setattr(X, "MAX_TRAIN_CHARS", 15)  # nearly all are longer: as many of the shortest as the bound holds
    drawn = X._drawn(spark.createDataFrame([(i, 1, n) for i, n in enumerate([9, 99, 12, 16, 17, 400])], "doc_id long, toxic int, n int"), 4).collect()
    assert sorted(r.n for r in drawn) == [9, 12, 16, 17]
    assert [r.n for r in X._drawn(spark.createDataFrame([(1, 1, 900), (2, 1, 901)], "doc_id long, toxic int, n int"), 5).collect()] == [900]
    got = {r.doc_id: r.score for r in X.digests(docs, known).collect()}
    bad = [got[i] for i, y in labels if y]
    fine = [got[i] for i, y in labels if not y]
    assert sum(b > f for b in bad for f in fine) >= 0.95 * len(bad) * len(fine) and sum(plain.values()) > 0


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """Bounds on rows, as a sample had, change nothing; shards and input partitions don't either."""
    rows, labels = corpus(400, seed=3)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(X, "SHARD_TEXTS", 60)
    plain = {r.doc_id: (r.score, r.rejected) for r in X.digests(docs, known).collect()}
    for bound in ("MAX_POSITIVES", "MAX_NEGATIVES"):
        monkeypatch.setattr(X, bound, 10, raising=False)
    twice = docs.union(docs).repartition(7, "text")
    assert {r.doc_id: (r.score, r.rejected) for r in X.digests(twice, known.repartition(3)).collect()} == plain
    out = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((plain[i][0] >= 0.5) == dict(labels)[i] for i in out) >= 0.95 * len(out)
    texts, back = X._labelled(docs, known)
    learnt, kept = [r.doc_id for r in texts.collect()], [r.doc_id for r in back.collect()]
    assert sorted(learnt + kept) == sorted(i for i, _ in labels if i not in out) and kept
    seen, n = X._counts(texts)
    at = X.parts("vilezor")[0]
    held = [y for i, y in labels if i in set(learnt) and "vilezor" in rows[i][1].split()]
    assert n.sum() == len(learnt) and seen[1, at] == sum(held) and seen[0, at] == len(held) - sum(held)


def test_thresholds_come_from_all_calibrating_rows(spark):
    rng = random.Random(2)
    rows = [(lang, rng.random() ** (1 + y), 1 - y) for lang in ("xx", "yy") for y in (0, 1, 1) for _ in range(200)]
    rows += [("few", 0.9, 1)] * 4 + [("few", 0.1, 0), *[("one", 0.5, 1)] * 9]
    got = X._thresholds(spark.createDataFrame(rows, "lang string, score double, toxic int"))
    assert got.keys() == {"xx", "yy"}
    for lang, at in got.items():
        own = [(s, y) for g, s, y in rows if g == lang]
        assert at == pytest.approx(X.best_threshold(np.array([s for s, _ in own]), np.array([y for _, y in own])), abs=1e-4)
