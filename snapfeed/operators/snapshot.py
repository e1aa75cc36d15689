"""Snapshot history: stamping, latest-snapshot selection and the row filters of
the SQL stage (derived columns, composite-key exclusion, IN-list)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.sources.counts import Counts, counted

SNAPSHOT_COL = "_snapshot_date"


def stamp_snapshot(df: DataFrame, day: _dt.date | str | Column, col: str = SNAPSHOT_COL) -> DataFrame:
    """Add the load date; the date is a parameter (or a column, e.g. the date in
    the source file name), never the wall clock."""
    value = day if isinstance(day, Column) else F.lit(str(day))
    return df.withColumn(col, value.cast("date"))


def latest_snapshot(df: DataFrame, col: str = SNAPSHOT_COL) -> DataFrame:
    """Rows of the newest snapshot.

    The bound is a scalar subquery, so on a table partitioned by ``col`` the
    filter prunes partitions at scan time.
    """
    latest = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == latest)


def with_defaults(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """``new = coalesce(src, default)`` for each entry ``new: (src, default)``.

    Date defaults keep the DATE type.
    """
    cols = {}
    for new, (src, default) in defaults.items():
        cols[new] = F.coalesce(F.col(src), F.lit(default))
    return df.withColumns(cols)


def all_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def exclude_keys(df: DataFrame, cols: list[str], keys: list[tuple], drop_null_keys: bool = True) -> DataFrame:
    """Remove rows whose composite key equals one of ``keys``.

    Keys are compared column by column (no string concatenation, so distinct
    keys cannot collide), as a null-safe anti join with the list as a table of
    the columns' types; Spark chooses the join by the list's size. Key parts may
    be given as values or as text. With ``drop_null_keys`` rows with a NULL key
    part are dropped too, which is what a ``concat(...) != literal`` filter does.
    :func:`exclude_keys_counted` also counts what is dropped.
    """
    rows = df.where(all_not_null(cols)) if drop_null_keys else df
    if not keys:
        return rows
    names = [f"__x{i}" for i in range(len(cols))]
    text = [tuple(None if v is None else str(v) for v in key) for key in keys]
    listed = df.sparkSession.createDataFrame(text, ", ".join(f"{n} string" for n in names))
    listed = listed.select(*[F.col(n).cast(df.schema[c].dataType).alias(n) for n, c in zip(names, cols)])
    return rows.join(listed, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(cols, names)], "left_anti")


def exclude_keys_counted(df: DataFrame, cols: list[str], keys: list[tuple], drop_null_keys: bool = True) -> tuple[DataFrame, Counts, Counts]:
    """:func:`exclude_keys` with the counts of the rows that came in (``rows``, and
    ``null_keys`` among them) and went out (``rows``), taken while they pass."""
    incoming, before = counted(df, null_keys=~all_not_null(cols))
    kept, after = counted(exclude_keys(incoming, cols, keys, drop_null_keys))
    return kept, before, after


def in_list(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def distinct_rows(df: DataFrame, position: list[str] = ()) -> DataFrame:
    """Exact-duplicate removal (partial aggregation map-side). ``position`` columns
    (source file, row number ...) say where a row stood and don't make rows
    different; of equal rows the first position is kept."""
    if not position:
        return df.dropDuplicates()
    same = [c for c in df.columns if c not in position]
    first = df.groupBy(*same).agg(F.min(F.struct(*position)).alias("__first"))
    return first.select(*[F.col(f"__first.{c}").alias(c) if c in position else F.col(c) for c in df.columns])
