"""A corpus run in five stages: language ID, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns documents with
the columns they came with; the last returns tokens. Between stages the documents are written as
Parquet in the cluster's shared folder, so a lost executor repeats part of one stage only.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rillwork.llm import language, lines, mixing, sentencepieces, simhash  # noqa: E402
from rillwork.llm.common import prepared, quoted, read, written  # noqa: E402
from rillwork.llm.queries import model_path, token_digests  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no learned language explains go."""
    prepared(spark)
    found = language.identify(docs, to="__language")
    return found.where("not __language.rejected").select(*map(quoted, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go from all documents but the one with the largest id."""
    prepared(spark)
    cleaned = lines.dedup_lines(docs).withColumn("text", F.col("kept"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("bigint"))
    return cleaned.select(*map(quoted, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    prepared(spark)
    return simhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two rows each."""
    prepared(spark)
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document of the mix, and digests of ids and decoded text."""
    prepared(spark)
    ids = sentencepieces.encode_documents(docs, model_path()).select("doc_id", "lang", "source", "ids")
    both = sentencepieces.decode_documents(ids, model_path())
    return both.select("doc_id", "lang", "source", "ids", *token_digests(both))


STAGES = [("language ID", language_id), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing", mix_sources), ("SentencePiece", tokenize)]

#: Language models and balanced sampling have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i + 1}")
    return docs
