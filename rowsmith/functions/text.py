"""Text normalization expressions.

``norm`` is the null model of every record job: null, blank and white space are
all the empty string.  It trims the full Unicode white-space set, unlike SQL
``TRIM``, which removes spaces only (``sql_trim``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The white-space characters removed from the ends of a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts a profile counts as null, compared in lower case.
NULL_TOKENS = ("", "null", "none", "na", "n/a")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode white space from both ends; null stays null."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def norm(c: Column | str) -> Column:
    """Null to ``''``, then strip."""
    return F.coalesce(strip(c), F.lit(""))


def norm_or_blank(df: DataFrame, name: str) -> Column:
    """``norm`` of a column, or ``''`` where the table has no such column."""
    return norm(F.col(quoted(name))) if name in df.columns else F.lit("")


def sql_trim(c: Column | str) -> Column:
    """Remove spaces only, as SQL ``TRIM`` does; null stays null."""
    return F.trim(_col(c))


def is_blank(c: Column | str) -> Column:
    return norm(c) == ""


def is_null_token(c: Column | str) -> Column:
    return F.lower(norm(c)).isin(*NULL_TOKENS)


def fold(c: Column, case_sensitive: bool = False) -> Column:
    return c if case_sensitive else F.lower(c)


def join_name(columns: Sequence[Column]) -> Column:
    """Join the non-blank name parts with one space."""
    return F.concat_ws(" ", *[F.nullif(norm(c), F.lit("")) for c in columns])


def name_key(c: Column) -> Column:
    """Lower case with every run of white space collapsed to one space."""
    return F.trim(F.regexp_replace(F.lower(c), f"[{WHITESPACE}]+", " "))


def at_pos(c: Column | str) -> Column:
    """True where ``@`` occurs after the first character."""
    return F.instr(_col(c), "@") > 1


def quoted(name: str) -> str:
    """A column name as a literal reference, so dots and spaces are not parsed."""
    return "`" + name.replace("`", "``") + "`"


def normalize_header(name: str) -> str:
    """Lower-case words joined by single underscores."""
    return re.sub(r"[\W_]+", "_", name.strip()).strip("_").lower()


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`normalize_header`.

    Two headers that normalize to one name raise, so that no column is lost.
    """
    names = [normalize_header(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"Headers collide after normalization: {', '.join(clashes)}")
    return df.toDF(*names)
