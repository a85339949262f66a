"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirframe.llm import (
    cotrain,
    hamming_dedup,
    html_render,
    one_bit_search,
    packing,
    piece_codec,
    quality_trees,
    sketch_search,
    spelling,
    surrogates,
    url_rules,
    weak_toxicity,
    weighted_fingerprint,
)
from weirframe.session import Scratch


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine and on the executors'."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surrogate_key(spark: SparkSession) -> str:
    """The secret in ``spark.weirframe.surrogate.key``; without one, a fresh one for this run alone."""
    return spark.conf.get("spark.weirframe.surrogate.key", None) or secrets.token_hex(32)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract(table(spark, sf_dir, "pages"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprint.fingerprint_pairs(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_trees.judge(docs, quality_trees.train(docs, table(spark, sf_dir, "labels")))


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.train(docs, table(spark, sf_dir, "labels")))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = surrogates.pseudonymise(docs, Scratch(spark, "op7"), surrogate_key(spark), count_col="n_replaced")
    return found.select("doc_id", "text", "n_replaced")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hamming_dedup.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op8"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_toxicity.score(docs, weak_toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return sketch_search.search(docs, items, Scratch(spark, "op11"))


def op12_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit_search.neighbours(table(spark, sf_dir, "embeddings"), Scratch(spark, "op12"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), Scratch(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_html_text": op2_html_text,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality_rules": op4_quality_rules,
    "op5_cotraining": op5_cotraining,
    "op6_pieces": op6_pieces,
    "op7_surrogates": op7_surrogates,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_sketch_search": op11_sketch_search,
    "op12_one_bit_search": op12_one_bit_search,
    "op13_spelling": op13_spelling,
}
SQL: dict[str, str] = {"op9_url_filter": url_rules.judge_sql(), "op11_sketch_search": sketch_search.search_sql()}
