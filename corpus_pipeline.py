"""From raw documents to mixed, encoded training text, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm.common import on_workers, written
from eventloom.llm.line_dedup import dedup_filter
from eventloom.llm.minhash import near_filter
from eventloom.llm.mixing import mixed_documents
from eventloom.llm.quality import quality_filter
from eventloom.llm.sentence_pieces import encode_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents repeat; ``n_chars`` follows."""
    return dedup_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_filter(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and pass of the mix over its source."""
    return mixed_documents(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and the scores of its best segmentations."""
    return encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("source_mixing", source_mixing), ("sentence_pieces", sentence_pieces),
]

#: Compression, hash permutations and a piece lattice are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    on_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
