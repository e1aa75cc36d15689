"""Questionnaire answers stored as bit masks in decimal text.

An answer packs two 16-bit words: the low word holds the chosen options, the
high word flags options answered a second way (shown with an ``h`` suffix).
All decoding is column arithmetic plus ``concat_ws`` over one term per bit, so
there is no Python in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.functions.common import as_col, ColumnOrName

# Which questions carry bit masks and how many option bits each uses.
BASELINE_QUESTIONS = (12, 13)
BASELINE_BITS = 5
DAILY_PLAIN_QUESTIONS = (57, 58, 62)
DAILY_PLAIN_BITS = 13
DAILY_FLAGGED_QUESTIONS = (60,)
DAILY_FLAGGED_BITS = 14
FLAG_SUFFIX = "h"
SEPARATOR = ", "

# n mod 2**32 only depends on the last 32 decimal digits (10**32 is a multiple of
# 2**32), so any length of digit string splits exactly.
_TAIL_DIGITS = 32


def is_digits(answer: ColumnOrName) -> Column:
    return as_col(answer).rlike(r"\A[0-9]+\z")


def _low32(answer: ColumnOrName) -> Column:
    tail = F.substring(as_col(answer), -_TAIL_DIGITS, _TAIL_DIGITS)
    return (tail.cast(f"decimal({_TAIL_DIGITS},0)") % F.lit(2 ** 32)).cast("bigint")


def split_words(answer: ColumnOrName) -> tuple[Column, Column]:
    """(low16, high16) of a digit answer; both NULL when the text is not digits."""
    n = F.when(is_digits(answer), _low32(answer))
    return (n.bitwiseAND(0xFFFF), F.shiftright(n, 16).bitwiseAND(0xFFFF))


def _bit_list(low: Column, bits: int, high: Column | None = None) -> Column:
    terms = []
    for i in range(bits):
        n = 1 << i
        label = F.lit(str(n))
        if high is not None:
            label = F.when(high.bitwiseAND(n) != 0, F.lit(f"{n}{FLAG_SUFFIX}")).otherwise(label)
        terms.append(F.when(low.bitwiseAND(n) != 0, label))
    return F.concat_ws(SEPARATOR, *terms)


def _decodable(answer: Column, question: Column, questions: tuple[int, ...]) -> Column:
    return is_digits(answer) & (answer != F.lit("0")) & question.isin(*questions)


def with_words(df: DataFrame, answer: str, low: str = "_low", high: str = "_high") -> DataFrame:
    """Add the two 16-bit words as columns, computed once per row; pass them to
    the decoders as ``words=(low, high)`` instead of re-deriving them per bit."""
    lo, hi = split_words(answer)
    return df.withColumns({low: lo, high: hi})


def decode_baseline(answer: ColumnOrName, question: ColumnOrName,
                    words: tuple[ColumnOrName, ColumnOrName] | None = None) -> Column:
    """Options chosen in a baseline multi-select answer, e.g. ``'1, 4'``.

    Other questions, ``'0'`` and non-digit text pass through; NULL stays NULL.
    """
    a, q = as_col(answer), as_col(question)
    low = as_col(words[0]) if words else split_words(a)[0]
    return F.when(_decodable(a, q, BASELINE_QUESTIONS), _bit_list(low, BASELINE_BITS)).otherwise(a)


def decode_daily(answer: ColumnOrName, question: ColumnOrName,
                 words: tuple[ColumnOrName, ColumnOrName] | None = None) -> Column:
    """Daily multi-select answers; the flagged question marks high-word options ``h``."""
    a, q = as_col(answer), as_col(question)
    low, high = (as_col(words[0]), as_col(words[1])) if words else split_words(a)
    return (F.when(_decodable(a, q, DAILY_PLAIN_QUESTIONS), _bit_list(low, DAILY_PLAIN_BITS))
            .when(_decodable(a, q, DAILY_FLAGGED_QUESTIONS), _bit_list(low, DAILY_FLAGGED_BITS, high))
            .otherwise(a))
