"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, packing.

Each stage takes the documents that its predecessor kept; all but the last return
the columns of documents.  Null ids and texts, repeated rows, empty tables and extra
columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callfacts.llm import line_dedup, mixing, packing, quality_rules, simhash
from callfacts.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of runs of lines; documents left without a word go."""
    done = line_dedup.dedup_lines(docs)
    removed = F.col(done.columns[-1])
    done = done.where((removed == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    kept = {c: F.col(f"`{c}`") for c in docs.columns}
    if "n_chars" in kept:
        n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept["n_chars"] = F.when(removed > 0, n).otherwise(F.col("n_chars")).alias("n_chars")
    return done.select(*kept.values())


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_first(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return mixing.sampled(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all documents; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizers and hashed words are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None
