"""Config-driven extract, transform, validate, load."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import quoted
from ..operators.clean import strip_cells
from ..operators.dedupe import dedupe_first, require_columns
from ..sources.records import ROW_IDX, read_records, with_row_idx
from ..sources.sinks import write_csv, write_summary


@dataclass(frozen=True)
class EtlResult:
    records: DataFrame
    summary: DataFrame


def transform(
    df: DataFrame,
    required_columns: list[str] = (),
    date_columns: list[str] = (),
    drop_duplicates_by: list[str] = (),
    order_by: str = ROW_IDX,
    dry_run: bool = True,
) -> EtlResult:
    """Strip, normalize dates, flag missing required values, keep first records.

    Missing values are counted before the dedupe and never drop a row; an absent
    required column counts as missing in every row.  Unknown dedupe columns raise.
    """
    require_columns(df, drop_duplicates_by, "drop_duplicates_by")
    cleaned = strip_cells(df, set(date_columns), keep={order_by})
    absent = [c for c in required_columns if c not in df.columns]
    incomplete = F.lit(bool(absent))
    for c in required_columns:
        if c in df.columns:
            incomplete = incomplete | (F.col(quoted(c)) == "")
    records = dedupe_first(cleaned, drop_duplicates_by, order_by) if drop_duplicates_by else cleaned

    if drop_duplicates_by:
        # One pass: rows per key first, then the totals over keys.
        keys = [F.col(quoted(c)) for c in drop_duplicates_by]
        groups = cleaned.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(incomplete).alias("m")
        )
        totals = groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("input_rows"),
            F.count(F.lit(1)).alias("output_rows"),
            F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("rows_missing_required_values"),
        )
    else:
        totals = cleaned.agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count(F.lit(1)).alias("output_rows"),
            F.count_if(incomplete).alias("rows_missing_required_values"),
        )
    summary = totals.select(
        F.lit(dry_run).alias("dry_run"),
        "input_rows",
        "output_rows",
        (F.col("input_rows") - F.col("output_rows")).alias("duplicate_rows_removed"),
        F.lit("|".join(absent)).alias("missing_required_columns"),
        "rows_missing_required_values",
        F.lit("|".join(required_columns)).alias("required_columns"),
    )
    return EtlResult(records, summary)


def run_etl(spark: SparkSession, config: Mapping[str, Any], apply: bool = False) -> EtlResult:
    """Run a configuration; without ``apply`` only the summary is written."""
    source = with_row_idx(
        read_records(spark, config["source_csv"], multiline=config.get("multiline", True))
    )
    result = transform(
        source,
        required_columns=config.get("required_columns", []),
        date_columns=config.get("date_columns", []),
        drop_duplicates_by=config.get("drop_duplicates_by", []),
        dry_run=not apply,
    )
    if apply:
        write_csv(result.records.drop(ROW_IDX), config["output_csv"])
    write_summary(result.summary, config.get("summary_json", "reports/etl_summary"))
    return result
