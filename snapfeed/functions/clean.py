"""Tolerant and strict cleaning expressions (Column -> Column).

Every function here is a built-in Spark expression tree: no Python UDF, so it
stays inside whole-stage codegen. Inputs are assumed to be text as read from a
feed (all-string ingest); numeric inputs are cast to string first where the rule
is textual.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapfeed.functions.common import as_col, ColumnOrName

# Characters Python's str.strip() removes (str.isspace()).
PY_WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                       + "".join(chr(c) for c in range(0x2000, 0x200B))
                       + "\u2028\u2029\u202f\u205f\u3000")
# The same set as one regex character class usable by Java and by RE2.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C\\x1D\\x1E\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# Python's \w for str patterns: letters, numbers, underscore.
PY_WORD_CLASS = "\\p{L}\\p{N}_"
# Default serial pattern: a lot prefix followed by word characters or dashes.
SERIAL_PREFIXES = ("NM", "NI")
# Currency marks removed before a money value is parsed.
MONEY_STRIP = "[$(),]"


def _text(c: ColumnOrName) -> Column:
    return as_col(c).cast("string")


def _fail(message: str, c: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.coalesce(c.cast("string"), F.lit("NULL"))))


def py_strip(c: ColumnOrName) -> Column:
    """str.strip(): remove leading and trailing whitespace (Unicode set).
    Only the two ends of the text are examined."""
    return F.btrim(_text(c), F.lit(PY_WHITESPACE_CHARS))


# What counts as a number's text: blanks around it, a sign, digits with or without a point,
# an exponent. Spark's own cast also takes type suffixes (``5d``, ``7f``) and words.
_BLANKS = "[ \\t\\n\\x0B\\f\\r]*"
_INTEGER = f"^{_BLANKS}[+-]?[0-9]+{_BLANKS}$"
_NUMBER = f"^{_BLANKS}[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?{_BLANKS}$"


def number_text(c: ColumnOrName) -> Column:
    """The text where it is a number's, else NULL."""
    t = _text(c)
    return F.when(t.rlike(_NUMBER), t)


def _truncated(c: ColumnOrName) -> Column:
    """A number's text as an integer, the fraction dropped; exact for integers of any
    length that fit 64 bits. NULL for other text and beyond 64 bits."""
    t = _text(c)
    whole = F.when(t.rlike(_INTEGER), t).try_cast("bigint")
    return F.when(t.rlike(_INTEGER), whole).otherwise(number_text(t).try_cast("double").try_cast("bigint"))


def int_or_default(c: ColumnOrName, default: int = 0, decimal_text: str = "truncate") -> Column:
    """Lenient integer: parse, else ``default``.

    ``decimal_text='truncate'`` treats ``'3.7'`` like the float 3.7 (-> 3), the
    result a numeric column gives; ``'default'`` rejects it like int('3.7').
    Surrounding blanks are accepted, as int(' 4 ') does.
    """
    if decimal_text == "truncate":
        parsed = _truncated(c)
    elif decimal_text == "default":
        parsed = _text(c).try_cast("bigint")
    else:
        raise ValueError("decimal_text must be 'truncate' or 'default'")
    return F.coalesce(parsed, F.lit(default).cast("bigint"))


def strict_int_null0(c: ColumnOrName) -> Column:
    """NULL -> 0; a number's text -> its integer, a fraction dropped as a numeric
    column's cast does; anything else, and a number beyond 64 bits, fails the job."""
    t = _text(c)
    parsed = _truncated(t)
    return (F.when(t.isNull(), F.lit(0).cast("bigint"))
            .when(parsed.isNull(), _fail("not an integer: ", t).cast("bigint"))
            .otherwise(parsed))


def _coerce_double(c: ColumnOrName) -> Column:
    """to_numeric(errors='coerce'): a number's text as double, all else NULL."""
    return number_text(c).try_cast("double")


def numeric_or_zero_int(c: ColumnOrName) -> Column:
    """Coerce to number, missing -> 0, truncate to integer. A number outside the
    64-bit range fails the job, as it has no integer here."""
    t = number_text(c)
    n = _truncated(c)
    return (F.when(t.isNull(), F.lit(0).cast("bigint"))
            .when(n.isNull(), _fail("number outside 64 bits: ", t).cast("bigint"))
            .otherwise(n))


def numeric_or_null_int(c: ColumnOrName) -> Column:
    """Coerce to number keeping NULL; a fractional value, or one outside the 64-bit
    range, fails the job."""
    d, n = _coerce_double(c), _truncated(c)
    return (F.when(d.isNull(), F.lit(None).cast("bigint"))
            .when(n.isNull(), _fail("number outside 64 bits: ", _text(c)).cast("bigint"))
            .when(d != F.floor(d), _fail("fraction in integer column: ", _text(c)).cast("bigint"))
            .otherwise(n))


def first_digits(c: ColumnOrName, default: int = 0) -> Column:
    """First run of ASCII digits as an integer, else ``default``. A run that doesn't
    fit 64 bits fails the job."""
    digits = F.regexp_extract(_text(c), "([0-9]+)", 1)
    value = digits.try_cast("bigint")
    return (F.when(F.coalesce(digits, F.lit("")) == "", F.lit(default).cast("bigint"))
            .when(value.isNull(), _fail("digits outside 64 bits: ", digits).cast("bigint")).otherwise(value))


def money(c: ColumnOrName, accounting_negatives: bool = False) -> Column:
    """Strip ``$ ( ) ,`` and parse as double; NULL -> 0.0; other text fails.

    By default ``(5.00)`` reads as +5.0, as the plain strip does. With
    ``accounting_negatives=True`` a parenthesised amount is negative.
    """
    t = _text(c)
    bare = F.regexp_replace(t, MONEY_STRIP, "")
    v = F.when(F.lower(py_strip(bare)) == "nan", F.lit(0.0)).otherwise(_coerce_double(bare))
    if accounting_negatives:
        v = F.when(F.trim(t).rlike("^\\(.*\\)$"), -v).otherwise(v)
    return (F.when(t.isNull(), F.lit(0.0))
            .when(v.isNull(), _fail("not a money amount: ", t).cast("double"))
            .otherwise(v))


def fill_label(c: ColumnOrName, label: str) -> Column:
    """Missing -> ``label``, then text."""
    return F.coalesce(_text(c), F.lit(label))


def stringify(c: ColumnOrName, null_literal: str | None = "nan") -> Column:
    """Text form of a value; missing becomes ``null_literal`` (None keeps NULL)."""
    t = _text(c)
    return t if null_literal is None else F.coalesce(t, F.lit(null_literal))


def _formats(fmt: str | tuple[str, ...]) -> tuple[str, ...]:
    return (fmt,) if isinstance(fmt, str) else tuple(fmt)


def strict_date(c: ColumnOrName, fmt: str | tuple[str, ...] = "yyyy-M-d") -> Column:
    """Parse a date with the first format that fits; NULL kept, other text fails.
    The default accepts months and days with or without a leading zero."""
    t = _text(c)
    d = F.coalesce(*[F.try_to_date(t, f) for f in _formats(fmt)])
    return F.when(t.isNotNull() & d.isNull(), _fail("bad date: ", t).cast("date")).otherwise(d)


def strict_timestamp(c: ColumnOrName, fmt: str | tuple[str, ...] = "yyyy-M-d H:m:s") -> Column:
    """Like :func:`strict_date`, to TIMESTAMP_NTZ."""
    t = _text(c)
    d = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in _formats(fmt)])
    return (F.when(t.isNotNull() & d.isNull(), _fail("bad timestamp: ", t).cast("timestamp_ntz"))
            .otherwise(d))


def timestamp_or_column(c: ColumnOrName, fallback: ColumnOrName,
                        fmts: tuple[str, ...] = ("yyyy-M-d H:m:s", "yyyy-M-d")) -> Column:
    """Parse with the first format that fits, else take ``fallback``."""
    t = _text(c)
    tries = [F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in fmts]
    return F.coalesce(*tries, as_col(fallback).cast("timestamp_ntz"))


def serial_pattern(prefixes: tuple[str, ...] = SERIAL_PREFIXES) -> str:
    alternatives = "|".join(prefixes)
    return f"({alternatives})[{PY_WORD_CLASS}-]+"


def clean_serial(c: ColumnOrName, prefixes: tuple[str, ...] = SERIAL_PREFIXES) -> Column:
    """Strip; the first ``<prefix>[word or -]+`` run if any, else the stripped text.

    NULL stays NULL. The match is searched in the whole text.
    """
    s = py_strip(c)
    found = F.regexp_extract(s, serial_pattern(prefixes), 0)
    return F.coalesce(F.nullif(found, F.lit("")), s)
