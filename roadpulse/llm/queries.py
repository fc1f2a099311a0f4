"""The registered queries of the operators, and the SQL where SQL can express one.

Each applies an operator with production settings to a whole table and derives the
columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import (
    imatch,
    knn,
    language,
    mixing,
    near_dup,
    page_text,
    pieces,
    pii,
    quality,
    resampling,
    substring_dedup,
    token_files,
    trie,
)
from roadpulse.storage import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(plan: Query) -> Query:
    QUERIES[plan.__name__] = plan
    return plan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op2_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"))


@query
def op3_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold(documents["doc_id"]) == language.HELD_OUT_FOLD, F.lit(False))
    learn = documents.filter(documents["doc_id"].isNotNull() & ~held_out)
    found = language.identified(documents, learn)
    held_out = F.coalesce(language.fold(F.col("doc_id")) == language.HELD_OUT_FOLD, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.read_token_files(spark, path)


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edit_test(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op11_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_ngram_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))
