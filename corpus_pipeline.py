"""Training-data pipeline over ``documents``: five stages, each one operator
of ``starloom.llm`` applied to all that the stage before it kept.

Every stage is written as Parquet to the shared folder and read again as the
next one's input, so a lost executor costs part of one stage. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, mixing, pii, simhash_dedup, toxicity
from starloom.llm.common import materialize, table
from starloom.llm.queries import tokenizer


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows a text that a stage has changed."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold; the model
    is trained on the labelled documents of ``sf_dir``."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out_col="_toxicity")
    return scored.where(~toxicity.rejected(model, "_toxicity")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, two bits)."""
    return simhash_dedup.deduplicate(docs).select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    return _recounted(pii.pseudonymise(docs, entities_col="_entities")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return _recounted(mixing.emit(mixing.mix(docs))).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and the digest of the bytes that
    the ids decode to."""
    ranks, pattern = tokenizer()
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern, keep_text=False, bytes_col="decoded")
    return out.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# Convolutions, fingerprints and token ids have no SQL form; tests/llm holds
# the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
