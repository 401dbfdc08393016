"""Record jobs on streams of arriving files.

The row-local operators are pure column expressions, so they take a streaming
DataFrame as it is: ``validate``, ``flag_first_issue``, ``sanitize``,
``check_constraints``, ``classify_sla``, ``anomalies`` and ``strip_cells``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery


def record_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, max_files: int = 1000
) -> DataFrame:
    """Text records from files that arrive in ``folder``."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
    )


def start_job(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the result of a row-local job to parquet files, exactly once.

    ``checkpoint`` and ``output`` must be on storage all executors share.
    """
    writer = job(stream).writeStream.format("parquet").outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.option("path", output).option("checkpointLocation", checkpoint).start()
