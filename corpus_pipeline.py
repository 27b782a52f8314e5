"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir) and returns documents with the columns it got, the last one token
ids. What a stage drops is gone for all later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm import bagmin, decontaminate, pieces, quality, secrets
from vitalgrid.llm.common import free_name, table
from vitalgrid.llm.queries import PIECE_MODEL
from vitalgrid.session import stored


def _put_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Own columns of ``docs`` with names that an operator uses, under free names, and how to name them again."""
    own = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c in names}
    return docs.withColumnsRenamed(own), {free: c for c, free in own.items()}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are unlike the trusted texts."""
    aside, names = _put_aside(docs, quality.ADDED)
    judged = quality.assess(aside, table(spark, sf_dir, "labels")).filter("kept").drop(*quality.ADDED)
    return judged.withColumnsRenamed(names).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every class of near-duplicates."""
    return bagmin.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a copy of a test item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets in its text become a mark."""
    aside, names = _put_aside(docs, ["spans"])
    return secrets.redacted(secrets.scan(aside)).withColumnsRenamed(names).select(*docs.columns)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token ids and their number, and whether decoding gives the text again."""
    encoded = pieces.encode(docs, pieces.Vocabulary.load(PIECE_MODEL))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "round_trip", "token_ids")


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("pieces", encode_text),
]

#: Likelihood ratios, signatures, alignments and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
