"""Column profile: null share, distinct count, samples and numeric range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbers import rate, to_number
from ..functions.text import NULL_TOKENS, norm, quoted

HEAD = 128  # letters of a value by which it is ordered; longer values are known by a digest


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    samples: int = 5,
    approximate: bool = False,
) -> DataFrame:
    """One row per column.

    The table is unpivoted to (column, value) and counted per value, with map-side
    combine, so repeated values are merged before the shuffle.  Of a value of more than
    ``HEAD`` letters only the beginning and a digest are shuffled.  Counts, range and
    samples are read from that one aggregate.  ``sample_values`` holds the smallest distinct
    values in text order; the top-k filter is pushed below the shuffle, so no task holds a
    column's whole value list.  Where a long value may be among the smallest, the whole values
    with its beginning are fetched by a second scan.

    ``approximate=True`` replaces the exact distinct count (and gives no samples):
    then no value is shuffled at all, only one sketch per task and column.
    """
    names = list(columns or df.columns)
    value = F.col("value")
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    # Typed cells need no trimming.  Null tokens become null before the shuffle.
    cells = df.select(
        *[
            (norm if n in texts else _typed)(F.col(quoted(n))).alias(f"v{i}")
            for i, n in enumerate(names)
        ]
    )
    long = cells.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        (
                            F.when(~F.lower(f"v{i}").isin(*NULL_TOKENS), F.col(f"v{i}"))
                            if n in texts
                            else F.col(f"v{i}")
                        ).alias("value"),
                    )
                    for i, n in enumerate(names)
                ]
            )
        )
    )
    head, digest = F.col("head"), F.col("digest")
    if approximate:
        counted = long.withColumn("n", F.lit(1))
        distinct, number, absent = F.approx_count_distinct(value), to_number(value), value.isNull()
    else:
        # A long value is counted by its beginning and a digest of 256 bits.
        is_long = F.length(value) > HEAD
        keyed = long.select(
            "ordinal",
            "value",
            F.substring(value, 1, HEAD).alias("head"),
            F.when(is_long, F.unhex(F.sha2(value, 256))).alias("digest"),
        )
        counted = keyed.groupBy("ordinal", "head", "digest").agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(is_long, to_number(value))).alias("long_number"),
        )
        distinct = F.count(head)
        number = F.when(digest.isNull(), to_number(head)).otherwise(F.col("long_number"))
        absent = head.isNull()
    stats = counted.withColumn("number", number).groupBy("ordinal").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(absent, F.col("n"))), F.lit(0)).alias("null_count"),
        distinct.alias("distinct_count"),
        (F.count("number") == F.count(F.when(~absent, F.lit(1)))).alias("numeric"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
    )
    numeric = F.col("numeric") & (F.col("distinct_count") > 0)
    header = df.sparkSession.createDataFrame(
        list(enumerate(names)), "ordinal int, column_name string"
    )
    zero = F.lit(0).cast("bigint")
    out = header.join(stats, "ordinal", "left").select(
        "ordinal",
        "column_name",
        F.coalesce("null_count", zero).cast("bigint").alias("null_count"),
        rate(F.coalesce("null_count", zero), F.coalesce("rows", zero)).alias("null_rate"),
        F.coalesce("distinct_count", zero).cast("bigint").alias("distinct_count"),
        F.when(numeric, F.col("low")).alias("numeric_min"),
        F.when(numeric, F.col("high")).alias("numeric_max"),
    )
    if approximate:
        return out
    # All sums are used, and nulls are dropped only after the rank, so that this
    # branch asks for the same aggregate and reuses its shuffle.
    smallest = Window.partitionBy("ordinal").orderBy(head.asc_nulls_last(), digest.asc_nulls_first())
    first = (
        counted.where("n > 0 or long_number is not null")
        .select("ordinal", "head", "digest", F.row_number().over(smallest).alias("rn"))
        .where(F.col("rn") <= samples)
        .where(head.isNotNull())
    )
    # Which of the long values with one beginning come first only the values can tell.  A few
    # beginnings for each column, of at most HEAD letters, are sent to all tasks.
    wanted = first.where(digest.isNotNull()).select(
        F.col("ordinal").alias("o"), F.col("head").alias("h")
    ).distinct()
    fetched = (
        keyed.where(digest.isNotNull())
        .join(F.broadcast(wanted), (F.col("ordinal") == F.col("o")) & (head == F.col("h")), "left_semi")
        .groupBy("ordinal", "digest")
        .agg(F.min(value).alias("value"))
        .select("ordinal", "value")
    )
    shown = first.where(digest.isNull()).select("ordinal", head.alias("value")).unionByName(fetched)
    by_value = Window.partitionBy("ordinal").orderBy("value")
    picked = (
        shown.withColumn("rn", F.row_number().over(by_value))
        .where(F.col("rn") <= samples)
        .groupBy("ordinal")
        .agg(F.array_sort(F.collect_list("value")).alias("sample_values"))
    )
    return out.join(picked, "ordinal", "left").withColumn(
        "sample_values",
        F.coalesce("sample_values", F.array().cast("array<string>")),
    )


def _typed(c: Column) -> Column:
    return c.cast("string")


def table_size(df: DataFrame) -> DataFrame:
    """``row_count, column_count`` of a table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint")
    )
