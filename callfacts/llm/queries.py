"""The registered queries of the operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callfacts.llm import (
    embedding_dedup, filter_audit, line_dedup, mixing, packing, quality_classifier, quality_rules, simhash, spelling, sql,
    suffix_dedup, token_files, toxicity, url_filters,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds that the held-out rows are taken from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def _scored(scores: DataFrame, n: int, held: int) -> DataFrame:
    return scores.select(
        "doc_id",
        F.coalesce(_bucket(F.col("doc_id"), n) == held, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, lambda i: _bucket(i, 4) != 2)
    return _scored(toxicity.score(docs, model), 4, 2)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels, lambda i: _bucket(i, 5) != 0)
    return _scored(quality_classifier.score(docs, model), 5, 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col("quality")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[q[n].alias(n) for n in names])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "mix.topic", "mix.tokens", "mix.probability", "mix.kept")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "removed_lines", "text")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return filter_audit.audit(filter_audit.masks(docs), labels)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.dedup(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filters": op6_url_filters,
    "op3_token_files": op3_token_files,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_simhash": op8_simhash,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_packing": op10_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL = {
    "op2_quality_rules": sql.OP2,
    "op6_url_filters": sql.OP6,
    "op11_filter_audit": sql.OP11,
}
