"""CSV ingest: all-text read, missing-value literals, all-empty rows, bad-record
accounting on load."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.functions.names import scan_file_name
from snapfeed.session import materialise

# Cell texts a pandas CSV read treats as missing (besides empty).
NA_LITERALS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
OVER_COL = "_over"
CORRUPT_COL = "_corrupt"
BAD_COL = "_bad"
TEXT_COL = "_text"


#: Cells as RFC 4180 and pandas have them: a quote inside a quoted cell is doubled, and a
#: backslash is a character like any other.
CELLS = {"quote": '"', "escape": '"'}


def with_cells(reader_or_writer, sep: str = ","):
    """The options that all CSV reads and writes of this library share."""
    return reader_or_writer.options(**CELLS).option("sep", sep)


def csv_writer(df: DataFrame, sep: str = ","):
    """A writer of header CSV that any RFC 4180 reader reads back: quotes doubled,
    white space at the ends of cells kept."""
    return (with_cells(df.write, sep).option("header", True).option("encoding", "UTF-8")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all (``a.1``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def distinct_names(cells: list[str | None]) -> list[str]:
    """Header cells as distinct names: a repeated ``a`` becomes ``a.1``, ``a.2`` and so
    on, an empty one ``Unnamed: <position>``."""
    names, taken = [], set()
    said = [c if c else f"Unnamed: {i}" for i, c in enumerate(cells)]
    for cell in said:
        name, n = cell, 0
        while name in taken or (n and name in said):
            n += 1
            name = f"{cell}.{n}"
        names.append(name)
        taken.add(name)
    return names


def header_columns(spark: SparkSession, path: str, sep: str = ",", quoted_newlines: bool = True) -> list[str]:
    """Column names from the header line (reads one line, no inference)."""
    first = with_cells(spark.read, sep).option("header", False).option("multiLine", quoted_newlines).csv(path).limit(1).collect()
    return distinct_names(list(first[0])) if first else []


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def na_to_null(df: DataFrame, literals: tuple[str, ...] = NA_LITERALS, cols: list[str] | None = None) -> DataFrame:
    """Turn missing-value literals in text columns into NULL."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lits = list(literals)
    return df.withColumns({c: F.when(~quoted(c).isin(lits), quoted(c)) for c in cols})


def drop_all_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    present = [quoted(c).isNotNull() for c in (cols or df.columns)]
    return df.where(reduce(lambda a, b: a | b, present))


def _raw_reader(spark: SparkSession, columns: list[str], header: bool, quoted_newlines: bool, sep: str):
    schema = text_schema(columns + [OVER_COL, CORRUPT_COL])
    return record_options(with_cells(spark.read.schema(schema), sep), header, quoted_newlines)


def record_options(reader, header: bool, quoted_newlines: bool):
    """The options under which ``cell_count`` can count a record's cells: the schema
    ends with ``_over`` and ``_corrupt``, and a record that doesn't fill it exactly
    comes with its text."""
    return (reader.option("header", header).option("enforceSchema", True).option("multiLine", quoted_newlines)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL))


def cell_count(record: Column, sep: str = ",") -> Column:
    """Cells of a record's text: separators outside of quoted cells, plus one. A quoted
    cell starts with a quote; a quote elsewhere is a character."""
    mark = re.escape(sep)
    cell = rf'(^|{mark})"[^"]*+(?:""[^"]*+)*+"'
    bare = F.when(record.contains('"'), F.regexp_replace(record, cell, "$1")).otherwise(record)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def too_long(columns: int, sep: str = ",") -> Column:
    """The record has more than ``columns`` cells. With one more it fills the schema
    and ``_corrupt`` stays empty; any other number is counted from its text, so cells
    that are empty count too."""
    return F.col(CORRUPT_COL).isNull() | (cell_count(F.col(CORRUPT_COL), sep) > columns)


def fail_long_rows(raw: DataFrame, columns: int, sep: str = ",") -> DataFrame:
    """Refuse rows with more cells than the header. A filter predicate is always
    evaluated (a projected check column would be pruned)."""
    return raw.where(F.when(too_long(columns, sep), F.raise_error(
        F.concat(F.lit("CSV row longer than header: "), F.coalesce(F.col(CORRUPT_COL), F.col(OVER_COL), F.lit("one more cell, empty")))))
        .otherwise(F.lit(True)))


def keep_filled_rows(raw: DataFrame, columns: list[str], na_literals=NA_LITERALS) -> DataFrame:
    """Drop rows whose cells are all missing. Written on the raw cells (before the
    literal mapping), so the optimizer does not carry it through 34 aliased CASE
    expressions when the result is later joined with itself."""
    lits = list(na_literals)
    missing = [quoted(c).isNull() | quoted(c).isin(lits) for c in columns]
    return raw.where(~reduce(lambda a, b: a & b, missing))


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             quoted_newlines: bool = True, sep: str = ",", na_literals=NA_LITERALS,
             fail_on_long_rows: bool = True, file_order: bool = False) -> DataFrame:
    """Header CSV as all-text columns: missing literals -> NULL, short rows
    padded, all-empty rows dropped; a row longer than the header fails the job,
    or loses its further cells with ``fail_on_long_rows=False``. Cells are quoted as
    in ``CELLS``; repeated headers become ``a``, ``a.1``.

    ``quoted_newlines`` allows newlines inside quoted cells (one split per file).
    ``file_order`` adds the source file, split start and in-split counter
    (see :func:`with_file_order`), taken at the scan.
    """
    columns = columns or header_columns(spark, path, sep, quoted_newlines)
    raw = _raw_reader(spark, columns, True, quoted_newlines, sep).csv(path)
    if file_order:
        raw = with_file_order(raw)
    if fail_on_long_rows:
        raw = fail_long_rows(raw, len(columns), sep)
    order_cols = [SOURCE_FILE, SPLIT_START, ROW_IN_SPLIT] if file_order else []
    kept = keep_filled_rows(raw, columns, na_literals)
    return na_to_null(kept.select(*map(quoted, columns), *order_cols), tuple(na_literals), cols=columns)


def type_text(df: DataFrame, schema: T.StructType) -> tuple[list[Column], Column]:
    """Typed columns (``try_cast``) and a flag for a cell that did not convert."""
    typed, failed = [], []
    for f in schema.fields:
        c = quoted(f.name)
        t = c.try_cast(f.dataType)
        typed.append(t.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            failed.append(c.isNotNull() & t.isNull())
    any_failed = reduce(lambda a, b: a | b, failed) if failed else F.lit(False)
    return typed, any_failed


def flag_bad_records(df: DataFrame, schema: T.StructType, extra_bad: Column | None = None, text: Column | None = None) -> DataFrame:
    """Typed columns plus ``_bad``: a cell failed to convert (or ``extra_bad``)."""
    typed, failed = type_text(df, schema)
    bad = failed if extra_bad is None else (failed | extra_bad)
    return df.select(*typed, bad.alias(BAD_COL), *([] if text is None else [text]))


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, skip_leading_rows: int = 1,
                   quoted_newlines: bool = True, sep: str = ",", with_text: bool = False) -> DataFrame:
    """Typed CSV read with the ``_bad`` flag; jagged (short) rows are accepted.
    ``with_text`` adds the cells as read."""
    if skip_leading_rows not in (0, 1):
        raise ValueError("skip_leading_rows must be 0 or 1")
    raw = _raw_reader(spark, schema.fieldNames(), skip_leading_rows == 1, quoted_newlines, sep).csv(path)
    flagged = flag_bad_records(raw, schema, too_long(len(schema.fields), sep), F.struct(*map(quoted, raw.columns)).alias(TEXT_COL) if with_text else None)
    return flagged


def infer_csv_schema(spark: SparkSession, path: str, header: bool = True, quoted_newlines: bool = True,
                     sep: str = ",") -> T.StructType:
    """Column types detected from the data (one extra pass over the files)."""
    found = with_cells(spark.read, sep).option("header", header).option("inferSchema", True).option("multiLine", quoted_newlines).csv(path).schema
    if not header:
        return found
    return T.StructType([T.StructField(n, f.dataType) for n, f in zip(header_columns(spark, path, sep, quoted_newlines), found.fields, strict=True)])


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None, target: str, mode: str = "append",
             max_bad_records: int = 0, fmt: str = "parquet", reject_path: str | None = None, **read_opts) -> dict[str, int]:
    """Load a CSV into a table path; returns {"rows": loaded, "bad": refused}.

    More than ``max_bad_records`` bad rows fail the load and nothing is written.
    Up to that many are written to ``reject_path`` as text (required for a limit
    above 0), so no row is lost. ``schema=None`` detects the column types first.
    """
    if max_bad_records and not reject_path:
        raise ValueError("a limit of bad records needs a reject_path to keep them")
    if schema is None:
        schema = infer_csv_schema(spark, path, header=read_opts.get("skip_leading_rows", 1) == 1,
                                  quoted_newlines=read_opts.get("quoted_newlines", True),
                                  sep=read_opts.get("sep", ","))
    # Parse once into the shared scratch folder: the count and the writes read
    # the same rows, and a lost executor costs no re-parse.
    flagged = materialise(read_csv_typed(spark, path, schema, with_text=True, **read_opts), "typed")
    counts = {r[BAD_COL]: r["count"] for r in flagged.groupBy(BAD_COL).count().collect()}
    n_bad = counts.get(True, 0)
    if n_bad > max_bad_records:
        raise ValueError(f"{n_bad} bad records in {path} (limit {max_bad_records})")
    flagged.where(~F.col(BAD_COL)).drop(BAD_COL, TEXT_COL).write.mode(mode).format(fmt).save(target)
    if n_bad:
        flagged.where(F.col(BAD_COL)).select(F.to_json(TEXT_COL).alias("cells")).write.mode(mode).format("text").save(reject_path)
    return {"rows": counts.get(False, 0), "bad": n_bad}


SOURCE_FILE = "_source_file"
SPLIT_START = "_split_start"
ROW_IN_SPLIT = "_row_in_split"


def with_file_order(df: DataFrame) -> DataFrame:
    """Tag rows of a file scan with their position: file name, split start and
    a counter increasing within the split. Call directly on the scan, before
    any shuffle; (file, split start, counter) sorts rows in file order."""
    return df.select("*", scan_file_name("_metadata.file_name").alias(SOURCE_FILE),
                     F.col("_metadata.file_block_start").alias(SPLIT_START),
                     F.monotonically_increasing_id().alias(ROW_IN_SPLIT))
