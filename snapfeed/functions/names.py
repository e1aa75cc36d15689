"""File-name and column-name rules: dated feed names, routing, header clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.functions.common import as_col, ColumnOrName

# Header clean-up steps, applied in this order.
HEADER_REPLACEMENTS = (("_ ", "_"), (" ", "_"), ("/", "_"), ("-", "_"), (" _", "_"))
UNRECOGNISED = "unrecognised"


def normalize_header(name: str) -> str:
    for old, new in HEADER_REPLACEMENTS:
        name = name.replace(old, new)
    return name


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column by :data:`HEADER_REPLACEMENTS` (metadata only)."""
    return df.toDF(*[normalize_header(c) for c in df.columns])


def normalize_header_col(name: Column) -> Column:
    """:func:`normalize_header` of a header cell read as data."""
    for old, new in HEADER_REPLACEMENTS:
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def feed_name_date(name: ColumnOrName, prefix: str) -> Column:
    """Date in ``<PREFIX>_yyyy-mm-dd`` found anywhere in the name (case-folded).

    NULL when the pattern is absent or the date is not a real calendar day; only
    the first occurrence counts.
    """
    pattern = re.escape(prefix.upper()) + "_([0-9]{4}-[0-9]{2}-[0-9]{2})"
    found = F.regexp_extract(F.upper(as_col(name)), pattern, 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "yyyy-MM-dd")


def summary_name_date(name: ColumnOrName, label: str) -> Column:
    """Date of a name that starts with ``yyyymmdd- <LABEL>`` (case-folded)."""
    pattern = "^([0-9]{8})- " + re.escape(label.upper())
    found = F.regexp_extract(F.upper(as_col(name)), pattern, 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "yyyyMMdd")


def has_feed_pattern(name: ColumnOrName, prefix: str) -> Column:
    pattern = re.escape(prefix.upper()) + "_[0-9]{4}-[0-9]{2}-[0-9]{2}"
    return F.upper(as_col(name)).rlike(pattern)


def accept_file(name: ColumnOrName, prefix: str, label: str) -> Column:
    """Whether a landed file is a valid dated feed or summary file.

    A name with the feed pattern is judged by its feed date alone; otherwise a
    name containing the label must start with a valid ``yyyymmdd- <LABEL>``.
    """
    n = as_col(name)
    return (F.when(has_feed_pattern(n, prefix), feed_name_date(n, prefix).isNotNull())
            .when(F.upper(n).contains(label.upper()), summary_name_date(n, label).isNotNull())
            .otherwise(F.lit(False)))


def route_by_name(name: ColumnOrName, routes: list[tuple[str, str]],
                  default: str = UNRECOGNISED) -> Column:
    """First route whose marker occurs in the upper-cased name, else ``default``."""
    upper = F.upper(as_col(name))
    expr = None
    for marker, target in routes:
        cond = upper.contains(marker.upper())
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def scan_file_name(encoded: ColumnOrName) -> Column:
    """Plain file name from ``_metadata.file_name``, which is percent-encoded
    (a space reads ``%20``). A literal ``+`` is kept as ``+``."""
    return F.url_decode(F.replace(as_col(encoded), F.lit("+"), F.lit("%2B")))


def base_name(path: ColumnOrName) -> Column:
    """Last path segment."""
    return F.substring_index(as_col(path), "/", -1)


def dated_name(prefix: str, day: ColumnOrName, suffix: str = ".csv") -> Column:
    """``prefix + yyyyMMdd + suffix`` for an export file."""
    return F.concat(F.lit(prefix), F.date_format(as_col(day), "yyyyMMdd"), F.lit(suffix))
