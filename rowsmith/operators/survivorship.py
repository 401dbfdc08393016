"""Merge two versions of a record set under an explicit priority."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import quoted
from .reconcile import paired, side_counts

SIDES = ("target", "source")


@dataclass(frozen=True)
class Merge:
    merged: DataFrame
    conflicts: DataFrame
    summary: DataFrame


def clean_priority(priority: Sequence[str]) -> list[str]:
    """Lower case, no repeats, both sides listed; an unknown side raises."""
    named = [p.strip().lower() for p in priority if p and p.strip()]
    unknown = [p for p in named if p not in SIDES]
    if unknown:
        raise ValueError(f"Invalid priority option(s): {', '.join(unknown)}")
    return list(dict.fromkeys([*named, *SIDES]))


def merge_columns(source: DataFrame, target: DataFrame, key: str, without: Sequence[str] = ()):
    """Source columns, then new target columns, without the key."""
    names = dict.fromkeys([*source.columns, *target.columns])
    return [c for c in names if c != key and c not in without]


def choose(source: Column, target: Column, prefer: str) -> tuple[Column, Column, Column]:
    """The surviving value, its origin and whether the sides conflict."""
    (first, second), other = (
        ((source, target), "target") if prefer == "source" else ((target, source), "source")
    )
    value = F.when(first != "", first).otherwise(second)
    origin = (
        F.when(source == target, F.when(source == "", "none").otherwise("both"))
        .when(first != "", prefer)
        .otherwise(other)
    )
    return value, origin, (source != "") & (target != "") & (source != target)


def survivorship(
    source: DataFrame,
    target: DataFrame,
    key: str = "student_id",
    columns: Sequence[str] | None = None,
    priority: Sequence[str] = ("target", "source"),
    order_by: str = "row_idx",
) -> Merge:
    """Merged records, the conflict register and a one-row summary.

    Only the first side of ``priority`` decides a conflict.  Without ``columns``
    the union of both schemas is merged (the ordinal excepted), also where one
    table is empty.
    """
    order = clean_priority(priority)
    names = [c for c in columns if c != key] if columns else merge_columns(
        source, target, key, without=[order_by]
    )
    both = _filled(paired(source, target, key, names, order_by), names)
    here, there = F.col("in_source").isNotNull(), F.col("in_target").isNotNull()
    cells = {c: (F.col(quoted(f"source_{c}")), F.col(quoted(f"target_{c}"))) for c in names}
    picked = {c: choose(ours, theirs, order[0]) for c, (ours, theirs) in cells.items()}
    merged = both.select(
        F.col("record_key").alias(key),
        F.when(here & there, "both")
        .when(here, "source_only")
        .otherwise("target_only")
        .alias("record_origin"),
        *[picked[c][0].alias(c) for c in names],
        *[picked[c][1].alias(f"source_of_{c}") for c in names],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            ours.alias("source_value"),
            theirs.alias("target_value"),
            F.when(picked[c][2], picked[c][0]).alias("chosen_value"),
        )
        for c, (ours, theirs) in cells.items()
    ]
    conflicts = (
        # A conflict needs both sides, and lone records have none to list.
        both.where(here & there)
        .select("record_key", F.inline(F.array(*entries)))
        .where("chosen_value is not null")
        .withColumns(
            {"chosen_from": F.lit(order[0]), "priority": F.lit(">".join(order))}
        )
    )
    fields = F.lit(0)
    for c in names:
        fields = fields + F.when(picked[c][2], 1).otherwise(0)
    # The counted pairing reads each side once; records without a key are only counted.
    counted = _filled(paired(source, target, key, names, order_by, counted=True), names)
    named = F.col("record_key") != ""
    summary = counted.agg(
        *side_counts(),
        F.count_if(named).alias("merged_records"),
        F.count_if(named & here & there).alias("both_sources"),
        F.count_if(named & here & ~there).alias("source_only"),
        F.count_if(named & there & ~here).alias("target_only"),
        F.coalesce(F.sum(F.when(named, fields)), F.lit(0)).cast("bigint").alias("field_conflicts"),
    )
    return Merge(merged, conflicts, summary)


def _filled(both: DataFrame, names: Sequence[str]) -> DataFrame:
    """Absent sides have blank cells."""
    cells = {f"{side}_{c}" for c in names for side in ("source", "target")}
    return both.select(
        *[
            F.coalesce(F.col(quoted(c)), F.lit("")).alias(c) if c in cells else F.col(quoted(c))
            for c in both.columns
        ]
    )
