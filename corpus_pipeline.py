"""From raw documents to token ids: the operators of ``roadpulse.llm`` in a row.

Each stage takes the documents that the stage before kept, written as Parquet and read
again, and returns documents with the same columns; the last returns their pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import language, mixing, near_dup, pieces, pii
from roadpulse.storage import fresh_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, labelled with it; learned from the labels of the training folds."""
    held_out = language.fold(docs["doc_id"]) == language.HELD_OUT_FOLD
    return language.labelled(docs, docs.filter(docs["doc_id"].isNotNull() & ~held_out))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.deduplicated(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources take it."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_chars, n_pieces, ids, decoded_sha256, exact`` of each document."""
    return pieces.round_trip(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixture", mix_sources),
    ("pieces", encode_pieces),
]

# A trained language model cannot be expressed in SQL; the stages are tested against
# brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` after all stages, one row per copy that the mixture takes."""
    docs = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
