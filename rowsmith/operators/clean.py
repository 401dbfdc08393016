"""Clean and normalize records."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import norm_date
from ..functions.text import norm, normalize_header, normalize_headers, quoted
from .dedupe import dedupe_first, require_columns


def strip_cells(
    df: DataFrame, date_columns: Collection[str] = (), keep: Collection[str] = ()
) -> DataFrame:
    """Every cell as stripped text, date columns as ``yyyy-MM-dd``; ``keep`` as is."""
    return df.select(
        *[
            F.col(quoted(c))
            if c in keep
            else (norm_date if c in date_columns else norm)(F.col(quoted(c))).alias(c)
            for c in df.columns
        ]
    )


def clean(
    df: DataFrame,
    date_columns: Sequence[str] = (),
    dedupe_keys: Sequence[str] | None = None,
    order_by: str = "row_idx",
) -> DataFrame:
    """Normalized headers, stripped cells, ISO dates and, on request, first-wins dedupe.

    Unknown dedupe keys raise.  ``order_by`` is the record ordinal; where the table
    has it, it passes through unchanged.
    """
    order = normalize_header(order_by)
    renamed = normalize_headers(df)
    dates = {normalize_header(c) for c in date_columns}
    cleaned = strip_cells(renamed, dates, keep={order})
    if dedupe_keys is None:
        return cleaned
    keys = [normalize_header(k) for k in dedupe_keys]
    require_columns(cleaned, keys, "dedupe key")
    return dedupe_first(cleaned, keys, order)
