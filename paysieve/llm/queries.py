"""Registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paysieve.llm import (
    codes,
    imatch,
    langid,
    lm,
    mixing,
    packing,
    repeats,
    runs,
    secrets,
    simhash,
    tokencount,
    topk,
    toxicity,
)
from paysieve.llm.common import id_remainder, stored


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removals(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = id_remainder("doc_id", 3) == 1
    references = langid.learn(docs, where=~held_out)
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), references).drop("text")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count("text").alias("words"))
    mixed = mixing.mix(stored(docs, "sizes"), size_column="words", least_blocks=64)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir), pieces=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), where=~held_out)
    return toxicity.score(docs.select("text", "doc_id", held_out.alias("held_out")), model)


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir), training=id_remainder("doc_id", 10) != 0)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(documents(spark, sf_dir), edit=True)


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return codes.encode(vectors, codes.learn(vectors))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_mixing": op5_mixing,
    "op6_imatch": op6_imatch,
    "op7_topk": op7_topk,
    "op8_secrets": op8_secrets,
    "op9_toxicity": op9_toxicity,
    "op10_lm": op10_lm,
    "op11_runs": op11_runs,
    "op12_codes": op12_codes,
    "op13_tokens": op13_tokens,
}

ORACLES: dict[str, str] = {
    "op1_repeats": repeats.REMOVALS_SQL,
    "op5_mixing": mixing.MIX_SQL,
    "op6_imatch": imatch.IMATCH_SQL,
    "op7_topk": topk.TOP_K_SQL,
    "op8_secrets": secrets.SECRETS_SQL,
    "op12_codes": codes.CODES_SQL,
}
