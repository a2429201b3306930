"""Cleaning of a training corpus in stages; each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotcast.llm import language, minhash, pieces, secrets, templates
from slotcast.llm.common import prepared, read, stored
from slotcast.llm.queries import tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the classifier tells with enough probability; it learns from ``lang``."""
    kept = language.predict(docs, language.fit(docs)).where(~F.col("rejected")).select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id."""
    kept = minhash.near_duplicates(docs, n=5, percent=80).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)


def unleaked(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    bad = templates.contaminated(docs, read(spark, folder, "benchmark")).where("contaminated").select("doc_id")
    return docs.join(bad, "doc_id", "left_anti").select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets in their texts blotted out."""
    import public_tokenizers

    clean = secrets.secrets(docs, tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, redacted=True, carried=("lang", "source"))
    return clean.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.length("redacted").cast("long").alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each text, with begin and end, and the text they decode to."""
    encoded = pieces.encode(docs, tokenizer("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.expr("length(ids) div 4").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", known_language), ("near_copies", near_copies), ("unleaked", unleaked),
    ("without_secrets", without_secrets), ("tokens", tokens),
]

# Language scores, register sketches and tokens have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages one after another over ``documents``, each written and reread."""
    prepared(spark)
    docs = read(spark, folder, "documents")
    for _, stage in STAGES:
        docs = stored(stage(prepared(spark), docs, folder))
    return docs
