"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import (
    alignment, binary_output, decontamination, embeddings, packing, periodic, pii, quality,
    secret_scan, sharding, simhash, substrings, toxicity,
)
from rowsmith.llm.common import table


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data: base spans and what the span classifier adds."""
    return pii.digests(pii.find(table(spark, folder, "documents"), least=0.9))


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=4, radius=4)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors linked at cosine 0.95 or more."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), cosine=0.95)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in one line of tokens, cut every 4096."""
    pieces = packing.concatenate_and_cut(
        table(spark, folder, "documents"), packing.vocabulary(), length=4096, end=2, digest=True
    )
    return pieces.withColumnRenamed("ids", "ids_crc32").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of documents inside any ten consecutive words of a benchmark item."""
    found = decontamination.overlaps(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10
    )
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_proximity(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of documents with ten words of a benchmark item, each at most two places off."""
    found = decontamination.overlaps(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10, slop=2
    )
    items = F.array_sort(F.array_distinct(F.filter("near.item", lambda i: i.isNotNull())))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size(F.array_distinct("near")).cast("long").alias("n_near"),
        F.size(items).cast("long").alias("n_near_items"),
        F.array_join(items, ",").alias("near_items"),
    )


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of earlier passages of 20 words or more are removed."""
    kept = substrings.remove_repeats(table(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op7_token_matrices(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences of 4096 ids packed best-fit-decreasing: bounds, resets and digests of the matrices."""
    rows = binary_output.matrices(
        table(spark, folder, "documents"), packing.vocabulary(), length=4096, end=2
    )
    return rows.select(
        "sequence_id", "n_ids", "doc_ids", "starts", "bounds",
        F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
    )


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets: base spans and random strings by token efficiency."""
    return secret_scan.find(table(spark, folder, "documents"), secret_scan.vocabulary(), most=2.0)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen shards of near equal size; equal texts stay together."""
    return sharding.shard(table(spark, folder, "documents"))


def op11_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every text; those far from their language and source are not kept."""
    return quality.judge(table(spark, folder, "documents"), quantile=0.9999, least=50).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the ids that two tokenizers give each text."""
    found = alignment.align(
        table(spark, folder, "documents"), alignment.vocabularies(), digest=True
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of at least four periods and six words, and the texts without their repeats."""
    found = periodic.find_runs(table(spark, folder, "documents"), order=periodic.planted)
    exponent = F.transform("runs", lambda r: F.struct(
        (r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"),
        r["length"].alias("n"),
    ))
    lines = F.transform("runs", lambda r: F.concat(
        *[r[c].cast("string") if c != "," else F.lit(c) for c in ("start", ",", "length", ",", "period")],
        F.lit("\n"),
    ))
    best = F.array_max(exponent)
    period = -best["p"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["s"]).alias("start"),
        best["n"].alias("length"), period.alias("period"),
        F.floor(1000 * best["n"] / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_pii": op1_pii,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_matrices": op7_token_matrices,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_quality_outliers": op11_quality_outliers,
    "op12_token_alignment": op12_token_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Further results of an operator that has its query above.
FURTHER = {"op5_proximity": op5_proximity}
