"""First-wins deduplication, key indexes and duplicate finding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import norm, quoted


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(
            f"Invalid {what} column(s): {', '.join(missing)}. "
            f"Available columns: {', '.join(df.columns)}"
        )


def first_per_key(
    df: DataFrame, keys: dict[str, Column], order_by: str, count: str | None = None
) -> DataFrame:
    """The record with the lowest order value per key tuple, plus the key columns.

    ``count`` names a column for the number of records of the key, from the same aggregate.

    ``min_by`` combines on the map side: one row per key and task is shuffled, so
    a key that holds a large share of the table costs no more than a rare one.
    """
    first = F.min_by(F.struct(*[F.col(quoted(c)) for c in df.columns]), F.col(quoted(order_by)))
    return (
        df.groupBy(*[expr.alias(name) for name, expr in keys.items()])
        .agg(first.alias("__first"), F.count(F.lit(1)).alias("__records"))
        .select(*keys, "__first.*", *([F.col("__records").alias(count)] if count else []))
    )


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Keep the first record per normalized key tuple; blank is a key value too."""
    require_columns(df, keys, "dedupe key")
    by = {f"__key_{i}": norm(F.col(quoted(k))) for i, k in enumerate(keys)}
    return first_per_key(df, by, order_by).drop(*by)


def index_by(df: DataFrame, key: str, order_by: str, name: str = "record_key") -> DataFrame:
    """First record per non-blank key, with the normalized key in column ``name``."""
    require_columns(df, [key], "key")
    keyed = df.where(norm(F.col(quoted(key))) != "")
    return first_per_key(keyed, {name: norm(F.col(quoted(key)))}, order_by)


def index_counts(df: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """One row: records, repeated keys that an index ignores, rows without a key.

    Rows are first counted per key, so the distinct count needs no second pass.
    """
    per_key = df.groupBy(norm(F.col(quoted(key))).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    present = F.col("k") != ""

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return per_key.agg(
        total(F.col("n")).alias(f"{prefix}records"),
        total(F.when(present, F.col("n") - 1)).alias(f"{prefix}duplicates_ignored"),
        total(F.when(~present, F.col("n"))).alias(f"{prefix}missing_key_rows"),
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once; null is a key value here."""
    require_columns(df, keys, "key")
    return (
        df.groupBy(*[F.col(quoted(k)) for k in keys])
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where("duplicate_count > 1")
    )


def ordered_duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`duplicate_groups`, largest first; sort only where the order is read."""
    return duplicate_groups(df, keys).orderBy(
        F.desc("duplicate_count"), *[F.col(quoted(k)) for k in keys]
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key tuple occurs more than once; null keys drop out.

    The semi join keeps the rows on its left side, where adaptive execution can
    split a hot key over many tasks.
    """
    filled = df.dropna(subset=list(keys))
    repeated = duplicate_groups(filled, keys).drop("duplicate_count")
    return filled.join(repeated, list(keys), "left_semi")
