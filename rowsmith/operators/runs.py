"""Run observability: step counters, manifests, run history and retention."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.documents import COUNT_FIELDS
from ..sources.sinks import publish, write_document, write_summary


def run_counts(steps: DataFrame, reports: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row of file and step counters."""
    step_counts = steps.agg(
        F.count(F.lit(1)).alias("steps_total"),
        F.count_if(F.col("status") == "failed").alias("steps_failed"),
        F.count_if(F.col("attempt") > 1).alias("steps_retried"),
    )
    # Three one-row tables.
    return (
        reports.agg(F.count(F.lit(1)).alias("report_files"))
        .crossJoin(outputs.agg(F.count(F.lit(1)).alias("output_files")))
        .crossJoin(step_counts)
        .select(
            "report_files",
            "output_files",
            (F.col("report_files") + F.col("output_files")).alias("total_files"),
            "steps_total",
            "steps_failed",
            "steps_retried",
        )
    )


@dataclass(frozen=True)
class Manifest:
    """A run's header row and its entry tables.

    The entries stay tables of any length.
    """

    header: DataFrame
    steps: DataFrame
    reports: DataFrame
    outputs: DataFrame


def run_manifest(
    run_id: str,
    status: str,
    generated_utc: str,
    steps: DataFrame,
    reports: DataFrame,
    outputs: DataFrame,
    paths: Mapping[str, str] | None = None,
    log_size: int | None = None,
) -> Manifest:
    """Describe a run; ``log_size`` is None where there is no log file."""
    paths = paths or {}
    names = ("report_dir", "output_dir", "log_file", "steps_file")
    counts = run_counts(steps, reports, outputs)
    header = counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(status).alias("status"),
        F.lit(generated_utc).alias("generated_utc"),
        F.struct(*[F.lit(paths.get(p, "")).alias(p) for p in names]).alias("paths"),
        F.struct(*counts.columns).alias("counts"),
        F.struct(
            F.lit(log_size is not None).alias("exists"),
            F.lit(log_size or 0).cast("bigint").alias("size_bytes"),
        ).alias("log"),
    )
    return Manifest(header, steps, reports, outputs)


def write_manifest(manifest: Manifest, folder: str) -> None:
    """Header and entry tables below one folder, whatever their length."""
    write_summary(manifest.header, f"{folder}/header")
    write_summary(manifest.steps, f"{folder}/steps")
    write_summary(manifest.reports, f"{folder}/reports")
    write_summary(manifest.outputs, f"{folder}/outputs")


def write_manifest_document(manifest: Manifest, folder: str) -> None:
    """The manifest as one JSON document in ordered part files, entries in key order."""
    files = ["relative_path"]
    write_document(
        manifest.header,
        {
            "steps": (manifest.steps, manifest.steps.columns[:1]),
            "reports": (manifest.reports, files),
            "outputs": (manifest.outputs, files),
        },
        folder,
    )


def upsert_history(
    history: DataFrame, entry: DataFrame, max_entries: int = 200, ordinal: str = "ordinal"
) -> DataFrame:
    """Replace or add ``entry`` by run id and keep the newest ``max_entries``.

    ``ordinal`` is the position in the old history: ties in time keep the old
    order and new entries come last.  Old entries without a run id stay.
    """
    if max_entries < 1:
        raise ValueError(f"max_entries must be a positive integer (received: {max_entries})")
    named = entry.withColumn(
        "run_id",
        F.when(F.trim("run_id") != "", F.trim("run_id")).otherwise(
            F.raise_error(F.lit("Manifest is missing run_id")).cast("string")
        ),
    )
    kept = history.join(
        named.select("run_id"), history["run_id"].eqNullSafe(named["run_id"]), "left_anti"
    )
    last = F.lit((1 << 63) - 1)
    merged = kept.unionByName(named.withColumn(ordinal, last))
    newest = F.coalesce("generated_utc", F.lit(""))
    return merged.orderBy(newest.desc(), ordinal).limit(max_entries)


def history_header(history: DataFrame, updated_utc: str, max_entries: int = 200) -> DataFrame:
    """One row that describes a written history; its runs are the rows of ``history``."""
    return history.agg(F.count(F.lit(1)).alias("total_runs")).select(
        F.lit(updated_utc).alias("updated_utc"),
        F.lit(max_entries).cast("bigint").alias("max_entries"),
        "total_runs",
    )


def write_history(history: DataFrame, folder: str, updated_utc: str, max_entries: int = 200) -> None:
    """Header and runs below one folder, newest first."""
    write_summary(history_header(history, updated_utc, max_entries), f"{folder}/header")
    write_summary(history.orderBy(F.desc("generated_utc"), "ordinal").drop("ordinal"), f"{folder}/runs")


def publish_history(history: DataFrame, root: str, updated_utc: str, max_entries: int = 200) -> str:
    """Header and runs as a new version below ``root``, which replaces the current one at once.

    ``history`` may be computed from the current version.
    """
    runs = history.orderBy(F.desc("generated_utc"), "ordinal").drop("ordinal")
    return publish({"header": history_header(history, updated_utc, max_entries), "runs": runs}, root)


def history_columns() -> list[str]:
    return [
        "run_id", "status", "generated_utc", "manifest_file", "log_file", "steps_file",
        *COUNT_FIELDS,
    ]


def expired_artifacts(inventory: DataFrame, patterns: Mapping[str, str], keep: int) -> DataFrame:
    """Files beyond the newest ``keep`` of each named pattern (a regex on the path).

    They are reported, never deleted.  The newest files are found by a top-k rank
    that is filtered before the shuffle, and taken away from the rest by a join,
    so no task holds all the files of a pattern.
    """
    if keep < 1:
        raise ValueError(f"keep must be a positive integer (received: {keep})")
    label = F.lit(None).cast("string")
    for name, pattern in reversed(list(patterns.items())):
        label = F.when(F.col("relative_path").rlike(pattern), F.lit(name)).otherwise(label)
    files = inventory.withColumn("pattern", label).where("pattern is not null")
    order = Window.partitionBy("pattern").orderBy(F.desc("modified_utc"), "relative_path")
    newest = (
        files.select("pattern", "relative_path", F.row_number().over(order).alias("rn"))
        .where(F.col("rn") <= keep)
        .drop("rn")
    )
    return files.join(newest, ["pattern", "relative_path"], "left_anti")
