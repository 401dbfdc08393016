"""Deadline classification of work items."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import days_to_due, parse_date
from ..functions.text import norm, quoted

# The statuses of an item that is still being worked on.
ACTIVE_STATUSES = ("open", "in_progress")
REPORTED_STATES = ("at_risk", "overdue")
STATES = (
    "no_due_date", "late_completed", "completed_on_time", "not_active", *reversed(REPORTED_STATES),
    "on_track",
)


def classify_sla(
    df: DataFrame,
    as_of: dt.date,
    threshold_days: int = 2,
    status: str = "status",
    due: str = "due_date",
    completed: str = "completed_at",
    active: Sequence[str] = ACTIVE_STATUSES,
) -> DataFrame:
    """Add ``risk_state`` and ``days_to_due``.

    A missing due date overrides everything and a completion date overrides the
    status.  ``as_of`` is required, so that a rerun gives the same report.
    """
    due_on, done_on = parse_date(F.col(quoted(due))), parse_date(F.col(quoted(completed)))
    left = F.col("days_to_due")
    state = (
        F.when(F.col("__due").isNull(), "no_due_date")
        .when(F.col("__done") > F.col("__due"), "late_completed")
        .when(F.col("__done").isNotNull(), "completed_on_time")
        .when(~F.lower(norm(F.col(quoted(status)))).isin(*active), "not_active")
        .when(left < 0, "overdue")
        .when(left <= threshold_days, "at_risk")
        .otherwise("on_track")
    )
    # Parsed dates come out of a one-element generator, so that a filter on the
    # state is not pushed below them and parses each date once.
    parsed = F.struct(due_on.alias("__due"), done_on.alias("__done"))
    return (
        df.select("*", F.inline(F.array(parsed)))
        .withColumn("days_to_due", days_to_due(F.col("__due"), as_of))
        .withColumn("risk_state", state)
        .select(*[F.col(quoted(c)) for c in df.columns], "risk_state", "days_to_due")
    )


def sla_at_risk(df: DataFrame, as_of: dt.date, threshold_days: int = 2, **columns) -> DataFrame:
    """Items that are at risk or overdue."""
    states = classify_sla(df, as_of, threshold_days, **columns)
    return states.where(F.col("risk_state").isin(*REPORTED_STATES))


def sla_summary(classified: DataFrame, as_of: dt.date, threshold_days: int = 2) -> DataFrame:
    return classified.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("risk_state").isin(*REPORTED_STATES)).alias("at_risk_rows"),
        F.struct(*[F.count_if(F.col("risk_state") == s).alias(s) for s in STATES]).alias("state_counts"),
    ).select(
        F.lit(as_of.isoformat()).alias("as_of"),
        F.lit(threshold_days).cast("bigint").alias("threshold_days"),
        "total_rows",
        "at_risk_rows",
        "state_counts",
    )
