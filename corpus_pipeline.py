"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the next stage's documents, which are written to the shared
folder and read again.  The last stage returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import jaccard, linededup, packing, postings, quality, storage

#: The stage's own rule, five words and 80 %; the 3 words and 90 % of ``Join`` are op6's.
#: At 80 %, bitmaps of half as many bits as n-grams let unrelated sets pass.
NEAR = jaccard.Join(n=5, percent=80, load=1, most_bits=32768, pairs_later=True)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; documents of which nothing is left go."""
    into = storage.free_name(docs, "_lines")
    done = linededup.deduplicate(docs, into=into)
    text = F.col(f"{into}.text")
    left = done.filter((F.col(f"{into}.n_deleted") == 0) | text.rlike(r"[^\x20\x09-\x0D]"))
    return left.select(
        *[text.alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (that of the smallest id)."""
    return jaccard.keep_one(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return postings.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL can't express the suffix-array verdict; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
