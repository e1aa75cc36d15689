"""One date format a column: elected from all its values, per file, in one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dates(c: str, formats: tuple[str, ...], kind: str = "date") -> list[Column]:
    text = F.col(c).cast("string")
    if kind == "date":
        return [F.try_to_date(text, f) for f in formats]
    return [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]


def elect_formats(df: DataFrame, cols: list[str], formats: tuple[str, ...], by: list[str] = (), kind: str = "date") -> DataFrame:
    """For each group of ``by`` (e.g. the source file) and column: the position in
    ``formats`` of the one format that fits every value.

    No format that fits all (mixed formats, or bad text) fails the job, and so do
    several that fit all but give different dates, such as day first and month first
    where no day is above 12. Formats that agree on every value are one choice. One
    partially aggregated grouping, whatever the number of columns; a row a group."""
    counts = []
    for n, c in enumerate(cols):
        text, dates = F.col(c).isNotNull(), _dates(c, formats, kind)
        counts += [F.count(F.when(text & d.isNull(), 1)).alias(f"__unfit_{n}_{i}") for i, d in enumerate(dates)]
        counts += [F.count(F.when(dates[i] != dates[j], 1)).alias(f"__differ_{n}_{i}_{j}") for j in range(len(formats)) for i in range(j)]
        counts.append(F.min(F.when(text, F.col(c).cast("string"))).alias(f"__one_{n}"))
    seen = df.groupBy(*by).agg(*counts)
    out = []
    for n, c in enumerate(cols):
        fits = [F.col(f"__unfit_{n}_{i}") == 0 for i in range(len(formats))]
        clash = reduce(lambda a, b: a | b, [fits[i] & fits[j] & (F.col(f"__differ_{n}_{i}_{j}") > 0) for j in range(len(formats)) for i in range(j)], F.lit(False))
        message = lambda text: F.raise_error(F.concat(F.lit(f"column {c}: {text}, e.g. "), F.coalesce(f"__one_{n}", F.lit("NULL")))).cast("int")  # noqa: E731, B023
        first = F.coalesce(*[F.when(f, F.lit(i)) for i, f in enumerate(fits)])
        out.append(F.when(clash, message("several date formats fit and give different dates")).when(first.isNull(), message("no one date format fits all values"))
                   .otherwise(first).alias(f"__format_{n}"))
    return seen.select(*by, *out)


def parse_dates(df: DataFrame, cols: list[str], formats: tuple[str, ...], by: list[str] = (), kind: str = "date") -> DataFrame:
    """Text columns as DATE (``kind="timestamp"``: TIMESTAMP_NTZ) by the elected format
    of each group; NULL stays NULL."""
    by = list(by)
    elected = elect_formats(df, cols, formats, by, kind)
    if by:
        names = {b: f"__by_{i}" for i, b in enumerate(by)}
        elected = elected.withColumnsRenamed(names)
        joined = df.join(elected, [F.col(b).eqNullSafe(F.col(n)) for b, n in names.items()], "left")
        chosen = {c: F.coalesce(*[F.when(F.col(f"__format_{n}") == i, d) for i, d in enumerate(_dates(c, formats, kind))]) for n, c in enumerate(cols)}
    else:
        row = elected.first()  # one row
        joined, chosen = df, {c: _dates(c, formats, kind)[row[n]] for n, c in enumerate(cols)}
    return joined.select(*[chosen[c].alias(c) if c in chosen else F.col(c) for c in df.columns])
