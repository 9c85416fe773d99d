import base64
import hashlib

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from starloom.llm import pii, simhash_dedup, toxicity
from starloom.llm.common import materialize
from tests.llm.test_mixing import brute, words
from tests.llm.test_simhash_dedup import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).unionByName(docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars"))
    docs = materialize(docs.unionByName(extra), "test-pipeline")
    out = [("documents", docs)]
    for name, f in C.STAGES:
        out.append((name, materialize(f(spark, out[-1][1], SF), "test-pipeline")))
    return dict(out)


def test_columns(stages):
    for name in ("toxicity", "simhash_dedup", "pii", "mixing"):
        assert stages[name].columns == stages["documents"].columns


def test_toxicity(spark, stages):
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    score = toxicity.Scorer(model).score
    want = [tuple(r) for r in stages["documents"].collect() if score(r.text or "") < model.thresholds.get(r.lang, 0.5)]
    key = lambda r: repr(r)
    assert sorted(want, key=key) == sorted((tuple(r) for r in stages["toxicity"].collect()), key=key)


def test_one_of_each_group_stays(stages):
    rows = stages["toxicity"].collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    group = brute_components(range(len(rows)), links)
    best = {}
    for i, r in enumerate(rows):
        k = (r.doc_id is None, r.doc_id or 0)
        best[group[i]] = min(best.get(group[i], k), k)
    got = stages["simhash_dedup"].collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(best.values())
    texts = {(r.doc_id, r.text) for r in rows}
    assert all((r.doc_id, r.text) in texts for r in got)


def test_personal_data_is_replaced(stages):
    before = {r.doc_id: r for r in stages["simhash_dedup"].collect()}
    for r in stages["pii"].collect():
        old = pii.spans(before[r.doc_id].text or "")
        assert (r.text == before[r.doc_id].text) == (not old)
        assert not {s[2:] for s in pii.spans(r.text or "")} & {s[2:] for s in old}
        assert r.n_chars == (len(r.text) if r.text is not None else before[r.doc_id].n_chars)


def test_mix(spark, stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages["pii"].collect()]
    taken = brute(spark, rows)[2]
    got = {}
    for r in stages["mixing"].collect():
        got[(r.doc_id, r.source)] = got.get((r.doc_id, r.source), 0) + words(r.text)
        assert r.n_chars == len(r.text)
    assert got == {(d, s): n for (d, t, s), n in taken.items() if n}


def test_tokens(stages):
    import public_tokenizers as P

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, enc.encode_ordinary(r.text), hashlib.sha256(r.text.encode()).hexdigest()) for r in stages["mixing"].collect())
    assert want == sorted((r.doc_id, r.ids, r.decoded_sha256) for r in stages["bpe"].collect())
    assert all(r.n_tokens == len(r.ids) for r in stages["bpe"].collect())


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d")] * 50 + [(2, "a b c d"), (None, None), (None, "")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.text or "") for r in simhash_dedup.deduplicate(df).collect()) == [(False, "a b c d"), (True, "")]
    assert simhash_dedup.deduplicate(df.limit(0)).count() == 0
    assert C.run.__doc__ and C.ORACLE_SQL is None
