"""The named queries of the operators here, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, html_text, language_id, line_dedup, lm_scoring, minhash, mixing, periodic_runs, quality, sentence_pieces,
    token_files, toxicity, vector_dedup,
)
from .common import new_dir, on_workers
from .oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("kept_text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


@query
def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_documents(table(spark, sf_dir, "documents"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(table(spark, sf_dir, "documents"))


@query
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.cross_entropy(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "token-files")
    token_files.write_token_files(token_files.tokenize(table(spark, sf_dir, "documents")), path)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.made_periodic(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))
