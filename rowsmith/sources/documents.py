"""Run documents: manifests, history indexes, step logs and file inventories."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numbers import to_int
from ..functions.text import norm_or_blank
from .records import read_records

COUNT_FIELDS = ("report_files", "output_files", "steps_total", "steps_failed", "steps_retried")

RUN_ENTRY = (
    "run_id string, status string, generated_utc string, manifest_file string, "
    "log_file string, steps_file string, counts struct<"
    + ", ".join(f"{c}: bigint" for c in COUNT_FIELDS)
    + ">"
)
FILE_ENTRY = "relative_path string, size_bytes bigint, modified_utc string"
STEP_ENTRY = (
    "step string, attempt bigint, max_attempts bigint, status string, exit_code bigint, "
    "start_utc string, end_utc string, duration_seconds bigint"
)


def parse_history(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per run entry in columns of JSON text.

    A document is an object with ``runs`` or a bare array; anything malformed
    contributes nothing, and array items that are not objects are dropped.
    """
    body = F.col(text)
    items = F.coalesce(
        F.when(F.trim(body).startswith("["), F.from_json(body, "array<string>")),
        F.from_json(F.get_json_object(body, "$.runs"), "array<string>"),
    )
    entry = F.from_json(F.col("item"), RUN_ENTRY)
    return (
        documents.select(F.posexplode(items).alias("ordinal", "item"))
        .where(F.trim("item").startswith("{"))
        .select("ordinal", entry.alias("e"))
        .select("ordinal", "e.*")
        .transform(flatten_entries)
    )


def flatten_entries(entries: DataFrame) -> DataFrame:
    """Fill absent texts with ``''`` and absent counts with 0."""
    keep = [c for c in entries.columns if c == "ordinal"]
    texts = [c for c in entries.columns if c not in ("ordinal", "counts")]
    return entries.select(
        *keep,
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in texts],
        *[
            F.coalesce(F.col(f"counts.{c}"), F.lit(0)).cast("bigint").alias(c)
            for c in COUNT_FIELDS
        ],
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Run entries of a history document; a missing file gives no entries."""
    try:
        documents = spark.read.option("wholetext", True).text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], "value string")
    return parse_history(documents)


def parse_manifest(documents: DataFrame, text: str = "value", file: str | None = None) -> DataFrame:
    """History entries from manifests; entries without a run id are rejected rows
    and come back with an empty ``run_id`` for the caller to check."""
    body = F.col(text)

    def field(path: str):
        return F.coalesce(F.get_json_object(body, path), F.lit(""))

    return documents.select(
        F.trim(field("$.run_id")).alias("run_id"),
        field("$.status").alias("status"),
        field("$.generated_utc").alias("generated_utc"),
        (F.col(file) if file else F.lit("")).alias("manifest_file"),
        field("$.paths.log_file").alias("log_file"),
        field("$.paths.steps_file").alias("steps_file"),
        *[
            F.coalesce(field(f"$.counts.{c}").try_cast("bigint"), F.lit(0)).alias(c)
            for c in COUNT_FIELDS
        ],
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    documents = (
        spark.read.option("wholetext", True)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    return parse_manifest(documents, file="file")


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` with its size and time; no root, no rows.

    Only file status columns are selected, so file contents are never read.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_ENTRY)
    below = "/" + re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", root).strip("/") + "/"
    return files.select(
        F.substr("path", F.locate(below, F.col("path")) + F.lit(len(below))).alias("relative_path"),
        F.col("length").alias("size_bytes"),
        utc_text(F.col("modificationTime")).alias("modified_utc"),
    )


def utc_text(ts):
    """ISO-8601 UTC text of a timestamp (under any session time zone)."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def typed_steps(records: DataFrame) -> DataFrame:
    """Step-log records with whole-number fields; other text becomes null."""

    def whole(name: str, signed: bool = False):
        return to_int(norm_or_blank(records, name), signed=signed).alias(name)

    def words(name: str):
        return norm_or_blank(records, name).alias(name)

    return records.select(
        words("step"),
        whole("attempt"),
        whole("max_attempts"),
        words("status"),
        whole("exit_code", signed=True),
        words("start_utc"),
        words("end_utc"),
        whole("duration_seconds"),
    )


def read_steps(spark: SparkSession, path: str) -> DataFrame:
    """The step log of a run; a missing file gives no steps."""
    try:
        return typed_steps(read_records(spark, path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STEP_ENTRY)
