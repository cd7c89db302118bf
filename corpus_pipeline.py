"""From raw documents to encoded rows: language, repeated lines, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and is written as Parquet and reread before the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepanel.llm import bpe, contamination, language, line_templates, simhash
from carepanel.llm.shared import stored

LEAST_LANGUAGE_SCORE = 0.4
TOKENIZER = "word_bpe_49k.json"
#: No SQL for language, fingerprints and encoding; tests compare the stages with brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has letters and a language that the model is not in doubt about; what is learned comes from docs."""
    model = language.train(docs.where(~language.is_held_out()))
    scored = language.with_language(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, into="found")
    kept = (F.col("found.lang") != language.UNKNOWN) & (F.col("found.score") >= LEAST_LANGUAGE_SCORE)
    return scored.where(kept).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts freed of recurring lines; n_chars follows the text."""
    cleaned = line_templates.without_repeated_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: that with the smallest doc_id (null ids last), among those the first by hash.

    Rows are told apart by fingerprint and content, so null ids and ids that several documents share lose nothing.
    """
    prints = simhash.fingerprints(docs.select(F.struct(*docs.columns).alias("row"), "text"), 3, "row", "text")
    rows = stored(prints.withColumnRenamed("id", "row"), "prints")
    order = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), F.xxhash64("row").alias("h"))
    best = stored(rows.groupBy("fp").agg(F.min(order).alias("best")), "classes")
    roots = simhash.fingerprint_roots(best.select("fp"), max_bits=3)
    leaders = best.join(roots, "fp").groupBy("root").agg(F.min_by("fp", "best").alias("fp"), F.min("best").alias("best"))
    leaders = leaders.select("fp", F.col("best.id").alias("id"), F.col("best.h").alias("h"))
    keyed = rows.select("fp", "row", F.col("row.doc_id").alias("id"), F.xxhash64("row").alias("h")).alias("r")
    same = (F.col("r.fp") == F.col("l.fp")) & (F.col("r.h") == F.col("l.h")) & F.col("r.id").eqNullSafe(F.col("l.id"))
    kept = stored(keyed.join(leaders.alias("l"), same, "left_semi").select("fp", "row"), "kept")
    # rows that are equal in all columns: one stays
    repeated = stored(kept.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    once = kept.join(repeated, "fp", "left_semi").groupBy("fp").agg(F.first("row").alias("row"))
    return kept.join(repeated, "fp", "left_anti").unionByName(once).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item."""
    return contamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text that they decode to (encoded, decoded and digested in
    one pass, so a worker holds one token table and no text's ids)."""
    return bpe.encoded_digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", known_language),
    ("line dedup", without_repeated_lines),
    ("near duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
