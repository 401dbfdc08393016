"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows the one before it kept, and
returns a DataFrame that :func:`run` writes as Parquet to the shared folder and reads again.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.llm import decontamination, packing, secret_scan, simhash, toxicity
from rowsmith.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.keep_one(docs, words=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go, each by its own text."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), width=10, by_row=True)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask; no document goes."""
    return secret_scan.redact(docs, secret_scan.vocabulary(), most=2.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, concatenated and cut every 4096 ids."""
    found = packing.concatenate_and_cut(docs, packing.vocabulary(), length=4096, end=2, digest=True)
    return found.withColumnRenamed("ids", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: A learnt classifier and a tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
