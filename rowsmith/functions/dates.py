"""Date expressions.

The accepted layouts have distinct shapes, so each value is rearranged to ISO
order by its shape and cast once.  That keeps bad values on the cheap path: no
formatter runs, and no parse exception is raised and swallowed per layout.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from .text import norm

# The accepted layouts.
_YEAR = r"(?!0000)([0-9]{4})"
_DM = r"([0-9]{1,2})"
ISO_DASH = f"^{_YEAR}-{_DM}-{_DM}$"
ISO_SLASH = f"^{_YEAR}/{_DM}/{_DM}$"
DAY_FIRST = f"^{_DM}-{_DM}-{_YEAR}$"
MONTH_FIRST = f"^{_DM}/{_DM}/{_YEAR}$"
ISO_WITH_TIME = (
    rf"^{_YEAR}-{_DM}-{_DM}\s+"
    r"(?:2[0-3]|[01]?[0-9]):(?:[0-5]?[0-9]):(?:[0-5]?[0-9])$"
)


def _iso_date(text: Column, with_time: bool) -> Column:
    """ISO dates take the short way.  In the other each step leaves other layouts
    alone, so the expression stays small when ``text`` is a long one."""
    iso = F.regexp_replace(text, DAY_FIRST, "$3-$2-$1")
    iso = F.regexp_replace(iso, MONTH_FIRST, "$3-$1-$2")
    iso = F.regexp_replace(iso, ISO_SLASH, "$1-$2-$3")
    if with_time:
        iso = F.regexp_replace(iso, ISO_WITH_TIME, "$1-$2-$3")
    other = F.regexp_extract(iso, ISO_DASH, 0)
    return F.when(text.rlike(ISO_DASH), text).otherwise(other).try_cast("date")


def parse_date(c: Column | str) -> Column:
    """A date from any layout without a time part, else null."""
    return _iso_date(norm(c), with_time=False)


def norm_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text; blank stays blank and unparseable text is kept."""
    text = norm(c)
    return F.coalesce(_iso_date(text, with_time=True).cast("string"), text)


def days_to_due(due: Column, as_of: Column | dt.date) -> Column:
    return F.datediff(due, as_of if isinstance(as_of, Column) else F.lit(as_of))
