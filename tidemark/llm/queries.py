"""The numbered queries: each applies its operator to the whole tables and returns what is compared of its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import context_tree, decontamination, language_id, merkle, order_minhash, periodic, product_quantisation, quality, repeats, sentence_pieces, sharding, statements, token_files, toxicity
from tidemark.llm.common import documents, ship


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.digests(decontamination.decontaminate(documents(spark, sf_dir).select("doc_id", "text"), benchmark, cleaned=False))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_files.digests(spark, token_files.write(docs, token_files.tokenizer_path()))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(sharding.deal(documents(spark, sf_dir).select("doc_id", "text")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digests(documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(sentence_pieces.encode(documents(spark, sf_dir).select("doc_id", "text"), sentence_pieces.model_path()))


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.digests(documents(spark, sf_dir).select("doc_id", "text"))


def op7_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return product_quantisation.near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digests(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(documents(spark, sf_dir).select("doc_id", "text"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.digests(documents(spark, sf_dir).select("doc_id", "text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(documents(spark, sf_dir).select("doc_id", "text"))


def op13_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digests(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_token_files, op3_sharding, op4_language_id, op5_sentence_pieces, op6_context_tree, op7_product_quantisation, op8_toxicity, op9_repeats, op10_order_minhash, op11_merkle, op12_periodic_runs, op13_robust_outliers)
}

ORACLES: dict[str, str] = {"op1_decontamination": statements.DECONTAMINATION, "op7_product_quantisation": statements.NEAR_VECTORS, "op11_merkle": statements.MERKLE}
