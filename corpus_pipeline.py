"""A corpus pipeline: toxicity, SimHash near-dedup, substring dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it back as the next
stage's ``docs``. Null columns, empty tables and extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm import decontamination, packing, simhash, substring, toxicity
from cellar.llm.queries import piece_digests, tokenizer_path
from cellar.runtime import delete_path, write_stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 that occur elsewhere are cut out; n_chars follows the text."""
    out = substring.remove_repeats(docs, total="words_before", gone="words_cut")
    cut = [c for c in out.columns if c not in docs.columns]
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(cut[1]) > 0, size).otherwise(F.col("n_chars")))
    return out.drop(*cut)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's template go."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with checksums of their ids."""
    return piece_digests(packing.pack(docs, tokenizer_path(), encode_special_tokens=False))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substring", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL cannot express the classifier and the tokenizer; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs, path = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            delete_path(spark, before)
        before = path
    return docs
