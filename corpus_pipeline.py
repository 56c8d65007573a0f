"""The corpus pipeline: five stages, each over all that the one before kept.

Toxic documents go; one document of each group of near copies stays (five-word
shingles, similarity 0.8); documents that hold a benchmark window go; secrets
in the texts are replaced by a mark; what is left is encoded as SentencePiece
ids.  Each stage's result is written as Parquet in the shared folder and read
back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import decontaminate, minhash, pieces, secrets, toxicity
from larkspur.llm.common import drop, small_batches, temporaries, written
from larkspur.llm.queries import PIECE_MODEL, table

#: A learned score and pieces of a tokenizer: SQL cannot state them.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the labels
    outside fold 0.  Null and empty texts score as texts without a toxic word
    and stay; repeated rows are judged alike; an empty table stays empty."""
    return toxicity.without_toxic(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id.
    Texts without words and rows without an id stay; rows that repeat an id and
    its shingles stay once."""
    return minhash.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of the benchmark occurs.  Null and
    empty texts stay; repeated rows are judged alike."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets marked out of their texts and ``n_chars``
    counted again where a text changes.  Null and empty texts stay as they are;
    so do repeated rows."""
    return secrets.redacted(docs, repo_col="doc_id")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document; null and empty texts have no
    ids; repeated rows stay."""
    small_batches(spark)
    return pieces.encode(docs, PIECE_MODEL).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  A stage's own tables, and the result of
    the stage before, are dropped once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporaries() as keep:
            made = keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        drop(docs)
        docs = made
    return docs
