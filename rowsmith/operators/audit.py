"""Audit packet: the records, their anomaly register and a summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import to_number
from ..functions.text import norm, quoted
from ..sources.sinks import write_csv, write_summary


@dataclass(frozen=True)
class AuditPacket:
    cleaned: DataFrame
    anomalies: DataFrame
    summary: DataFrame


def _issues(key: str, score: str, low: float) -> list[Column]:
    text = norm(F.col(quoted(score)))
    number = to_number(text)
    return [
        F.when(norm(F.col(quoted(key))) == "", F.lit(f"missing_{key}")),
        F.when(text == "", F.lit(f"missing_{score}"))
        .when(number.isNull(), F.lit(f"invalid_{score}"))
        .when(number < low, F.lit("low_score")),
    ]


def anomalies(
    df: DataFrame, key: str = "student_id", score: str = "score", low: float = 50.0
) -> DataFrame:
    """One row per (record, issue): a record has up to two issues."""
    issues = F.array(*_issues(key, score, low))
    return df.select("*", F.explode(issues).alias("issue")).where("issue is not null")


def audit_packet(
    df: DataFrame, key: str = "student_id", score: str = "score", low: float = 50.0
) -> AuditPacket:
    summary = df.agg(
        F.count(F.lit(1)).alias("rows"),
        sum(F.count(issue) for issue in _issues(key, score, low)).alias("anomaly_rows"),
    ).select(
        "rows",
        "anomaly_rows",
        F.lit(key).alias("key_column"),
        F.lit(score).alias("score_column"),
        F.lit(float(low)).alias("low_score_threshold"),
    )
    return AuditPacket(df, anomalies(df, key, score, low), summary)


def write_packet(packet: AuditPacket, folder: str) -> None:
    """``cleaned``, ``anomalies`` and ``summary`` below one folder."""
    write_csv(packet.cleaned, f"{folder}/cleaned")
    write_csv(packet.anomalies, f"{folder}/anomalies")
    write_summary(packet.summary, f"{folder}/summary")
