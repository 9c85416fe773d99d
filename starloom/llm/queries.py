"""Registered queries of this subpackage: thin, each derives its contract's
columns from the operator's own output. Paths and thresholds are parameters
of the operators; the values used here are the production ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bpe, collocations, embed_join, fingerprint, hard_negatives, html_blocks, mixing, pii, simhash_dedup, token_files, toxicity, url_reputation, warc
from starloom.llm.common import table
from starloom.session import scratch_path


def tokenizer() -> tuple[bytes, str]:
    """Rank file and split pattern of the public tokenizer used throughout."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole document, and the bytes they decode to, as digests."""
    ranks, pattern = tokenizer()
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, pattern)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page."""
    return html_blocks.digests(table(spark, sf_dir, "pages"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every whole document and of its edited text, and how like they and the next one are."""
    return fingerprint.digests(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document: sources weigh 1, 2, 3, repeating, three epochs at most."""
    return mixing.digests(table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links (cosine of 0.98 and more, equal labels) and component of every vector."""
    return embed_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document, learnt from the labelled rows that are not held out."""
    return toxicity.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url; hosts by their labelled pages' outcomes."""
    return url_reputation.digests(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document with personal data replaced by consistent surrogates."""
    return pii.digests(table(spark, sf_dir, "documents"))


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion record of every page's response."""
    return warc.digests(table(spark, sf_dir, "pages"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of every whole document (three-word shingles) and
    the group it belongs to: links are two differing bits or fewer."""
    return simhash_dedup.digests(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 collocations of every language, of two to four words."""
    return collocations.mine(table(spark, sf_dir, "documents")).collocations


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document written to seekable files, and read back."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        definition = f.read()
    return token_files.digests(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"), definition, end_id=2)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (id divisible by 50) and each of its five positives."""
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_html_text": op2_html_text,
    "op3_fingerprints": op3_fingerprints,
    "op4_mix_sources": op4_mix_sources,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_url_reputation": op7_url_reputation,
    "op8_surrogates": op8_surrogates,
    "op9_warc_derivatives": op9_warc_derivatives,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_collocations": op11_collocations,
    "op12_token_files": op12_token_files,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op5_embedding_near_dedup": embed_join.SQL,
    "op7_url_reputation": url_reputation.SQL,
    "op11_collocations": collocations.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
