"""A corpus pipeline of five stages; each reads the Parquet that the stage before wrote and works on all of it.

Every stage but the last returns the columns of ``documents``. Documents leave in the language stage (no known
language), in the near-copy stage (all but one of a group), in the passage stage (nothing left but later copies) and
in the benchmark stage (mostly benchmark text); texts lose repeated and benchmark passages. The last stage adds the
pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, order_minhash, repeats, sentence_pieces
from tidemark.llm.common import documents, fresh_path, ship


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that may have changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the field learns from the labelled documents given."""
    ship(spark)
    return language_id.keep_known(docs, language_id.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id."""
    ship(spark)
    return order_minhash.keep_first(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of passages of 200 bytes or more."""
    ship(spark)
    return _counted(repeats.strip(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages."""
    ship(spark)
    return _counted(decontamination.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, the source bytes of each piece, and the decoded text."""
    ship(spark)
    return sentence_pieces.encode(docs, sentence_pieces.model_path())


STAGES = [("languages", languages), ("near_copies", near_copies), ("passages", passages), ("benchmark", benchmark), ("pieces", pieces)]

#: A conditional random field can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
