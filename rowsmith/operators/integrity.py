"""Integrity scorecard: named checks with issue counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import quoted, sql_trim
from .checks import RECORD_STATUSES


@dataclass(frozen=True)
class IntegritySpec:
    """Columns and limits of the standard checks over a typed table."""

    key: str = "student_id"
    score: str = "score"
    status: str = "status"
    due: str = "due_date"
    completed: str = "completed_at"
    required: Sequence[str] = ("student_id", "email", "department")
    statuses: Sequence[str] = field(default=RECORD_STATUSES)
    low: float = 0
    high: float = 100

    def checks(self) -> dict[str, Column]:
        """Conditions of the checks that look at one record."""
        def col(name: str) -> Column:
            return F.col(quoted(name))

        score, status, due, done = map(col, (self.score, self.status, self.due, self.completed))
        blank = F.lit(False)
        for name in self.required:
            blank = blank | col(name).isNull() | (sql_trim(col(name)) == "")
        return {
            f"missing_or_invalid_{self.score}": score.isNull()
            | (score < self.low)
            | (score > self.high),
            "missing_required_fields": blank,
            f"invalid_{self.status}_values": status.isNull()
            | ~F.lower(sql_trim(status)).isin(*self.statuses),
            "completed_after_due_date": done.isNotNull() & due.isNotNull() & (done > due),
        }


def integrity_scorecard(df: DataFrame, spec: IntegritySpec = IntegritySpec()) -> DataFrame:
    """``check_name, issue_count`` for every check, in one scan.

    Rows are counted per key first, together with the record checks; the second
    level adds the counters up and counts the keys that repeat (null is a key).
    """
    checks = spec.checks()
    names = list(checks)
    per_key = df.groupBy(F.col(quoted(spec.key)).alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(checks.values())],
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    totals = per_key.agg(
        total(F.when(F.col("n") > 1, 1)).alias("repeated"),
        *[total(F.col(f"c{i}")).alias(f"c{i}") for i in range(len(names))],
    )
    rows = [(names[0], "c0"), (f"duplicate_{spec.key}", "repeated")]
    rows += [(name, f"c{i}") for i, name in enumerate(names) if i]
    scored = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(c).alias("issue_count"))
            for name, c in rows
        ]
    )
    return totals.select(F.inline(scored))
