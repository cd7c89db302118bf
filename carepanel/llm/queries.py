"""The registered queries of this package: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepanel.llm import (
    bpe,
    contamination,
    html_text,
    language,
    line_templates,
    prefix_trie,
    secret_scan,
    shards,
    simhash,
    suffixes,
    token_alignment,
    token_files,
    topk,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), end_id=2)
    read = token_files.read_token_files(spark, folder, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
    return read.withColumnRenamed("value", "ids_crc32")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(_table(spark, sf_dir, "documents"), length=200)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    n_spans = F.size("removed").cast("long")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), n_spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    encoded = bpe.with_ids(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.digests(bpe.with_decoded(encoded.drop("text"), path))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.balanced_shards(_table(spark, sf_dir, "documents"), n_shards=8)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_report(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), base_every=100, shared_turns=6)


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.with_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), into="text")
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        ranks_a=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern_a=public_tokenizers.PATTERN,
    )


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_lines": op3_lines,
    "op4_token_files": op4_token_files,
    "op5_topk": op5_topk,
    "op6_suffixes": op6_suffixes,
    "op7_contamination": op7_contamination,
    "op8_bpe": op8_bpe,
    "op9_shards": op9_shards,
    "op10_secrets": op10_secrets,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_html": op12_html,
    "op13_alignment": op13_alignment,
}
