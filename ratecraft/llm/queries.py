"""Registered queries of the operators and of the corpus pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hardneg, jaccard, linededup, matrices, mixing, packing, periodic, postings, quality, separators, sharding, trie_lm, warc
from .storage import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the counts, the base rules and the suffix-array verdict."""
    judged = quality.judge(table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "covered_words", "longest_repeat", "n_maximal_repeats"]
    return judged.select("doc_id", *[F.col(f"_quality.{c}").alias(c) for c in names])


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page, from the archives written and read back."""
    return warc.deduplicate(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: words hit by benchmark windows, the items found, and the verdict."""
    report = postings.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=None)
    return report.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its log10 probability under the trie model and under the word counts."""
    return trie_lm.fit_and_score(table(spark, sf_dir, "documents"))[0]


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its tokens (separator included), counted in the flat files."""
    return separators.token_counts(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: size of its shingle set and its component."""
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: shard of 40, slot in it, and its shard of 41."""
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


def op8_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: lines before, lines deleted, the deleted runs, and the checksum of what is left."""
    done = linededup.deduplicate(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", F.col("_lines.n_lines").alias("n_lines"), F.col("_lines.n_deleted").alias("n_deleted"),
        F.coalesce("_lines.begins", F.expr("cast(array() as array<int>)")).alias("begins"),
        F.coalesce("_lines.ends", F.expr("cast(array() as array<int>)")).alias("ends"),
        F.crc32(F.coalesce("_lines.text", F.lit("")).cast("binary")).alias("text_crc32"),
    )


def op10_id_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per segment of the id matrices, as read back from the written table."""
    return matrices.segments(matrices.write_matrices(table(spark, sf_dir, "documents")))


def op11_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its source's size and target, and the words that the mix takes of it."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, some made periodic: the number of runs, the best one, and digests of all runs and of the collapsed text."""
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = docs.select("doc_id", periodic.find_runs(F.col("text")).alias("found"))
    best, runs = F.col("best"), F.col("found.runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", periodic.best_run(runs)).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        F.col("found.n_words").alias("n_words"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per anchor, positive and rank: a hard negative; every seventh row is relabelled first."""
    relabelled = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return hardneg.mine(vectors, F.pmod("vec_id", F.lit(50)) == 0)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_positional_index": op3_positional_index,
    "op4_trie_scores": op4_trie_scores,
    "op5_separator_scan": op5_separator_scan,
    "op6_ngram_join": op6_ngram_join,
    "op7_jump_shards": op7_jump_shards,
    "op8_nnls_packing": op8_nnls_packing,
    "op9_line_runs": op9_line_runs,
    "op10_id_matrices": op10_id_matrices,
    "op11_pareto_mix": op11_pareto_mix,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}
