"""Cleaning expressions against plain Python / pandas behaviour on random text."""

import re

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
import os

EXAMPLES = int(os.environ.get("SNAPFEED_PROPERTY_EXAMPLES", "25"))
from pyspark.sql import functions as F

from snapfeed.functions import clean as C

SERIAL_ALPHABET = "NMIab1_-é٣ \t  x"
serial_text = st.one_of(st.none(), st.text(alphabet=SERIAL_ALPHABET, max_size=12))
NUM_ALPHABET = "0123456789 +-.edfDL"
num_text = st.one_of(st.none(), st.text(alphabet=NUM_ALPHABET, max_size=8), st.sampled_from(["0700D", "5d", "7f", "3.9999999", "1e20", "9223372036854775807", "-1e-3", "nan"]))


def py_clean_serial(s):
    if s is None:
        return None
    s = s.strip()
    m = re.search(r"(NM|NI)[\w-]+", s)
    return m.group(0) if m else s


def py_int_text(v, default):
    try:
        return int(v)
    except (TypeError, ValueError):
        return default


def pd_num_or_zero(v):
    """None: the number has no 64-bit integer, so the job must fail."""
    x = pd.to_numeric(pd.Series([v], dtype=object), errors="coerce").fillna(0).iloc[0]
    return int(x) if abs(x) < 2 ** 63 else None


def evaluate(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(serial_text, min_size=1, max_size=25))
def test_clean_serial_matches_python(spark, values):
    assert evaluate(spark, values, C.clean_serial) == [py_clean_serial(v) for v in values]


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(num_text, min_size=1, max_size=25))
def test_int_text_mode_matches_python_int(spark, values):
    got = evaluate(spark, values, lambda c: C.int_or_default(c, -7, decimal_text="default"))
    assert got == [py_int_text(v, -7) for v in values]


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(num_text, min_size=1, max_size=25))
def test_numeric_or_zero_matches_pandas(spark, values):
    want = [pd_num_or_zero(v) for v in values]
    fits = [v for v, w in zip(values, want) if w is not None]
    if fits:
        assert evaluate(spark, fits, C.numeric_or_zero_int) == [w for w in want if w is not None]
    for v in [v for v, w in zip(values, want) if w is None][:1]:
        with pytest.raises(Exception, match="outside 64 bits"):
            evaluate(spark, [v], C.numeric_or_zero_int)


def test_number_grammar(spark):
    """Type suffixes are no numbers, fractions are dropped and not rounded, and what has
    no 64-bit integer fails."""
    texts = ["0700D", "5d", "7F", "3.9999999", "-3.9999999", "1e3", ".5", "5.", " 42 ", "9223372036854775807", "inf", "NaN", "0x10", "1_0", None]
    assert evaluate(spark, texts, C.numeric_or_zero_int) == [0, 0, 0, 3, -3, 1000, 0, 5, 42, 9223372036854775807, 0, 0, 0, 0, 0]
    assert evaluate(spark, texts, C.int_or_default) == [0, 0, 0, 3, -3, 1000, 0, 5, 42, 9223372036854775807, 0, 0, 0, 0, 0]
    assert evaluate(spark, ["7.0", None, "0700D", " 8"], C.numeric_or_null_int) == [7, None, None, 8]
    assert evaluate(spark, ["3.0", "3.7", None, "3.9999999"], C.strict_int_null0) == [3, 3, 0, 3]
    assert evaluate(spark, ["a12b3", "x", None, ""], C.first_digits) == [12, 0, 0, 0]
    assert evaluate(spark, ["$1,234.50", " nan", "(5)", None], C.money) == [1234.5, 0.0, 5.0, 0.0]
    for text, fn, message in (("1e30", C.numeric_or_null_int, "outside 64 bits"), ("2.5", C.numeric_or_null_int, "fraction"), ("7f", C.strict_int_null0, "not an integer"),
                              ("1" * 20, C.first_digits, "outside 64 bits"), ("5d", C.money, "not a money"), ("1e20", C.strict_int_null0, "not an integer")):
        with pytest.raises(Exception, match=message):
            evaluate(spark, [text], fn)


MONEY_ALPHABET = "$(),.0123456789 -"
money_text = st.one_of(st.none(), st.text(alphabet=MONEY_ALPHABET, max_size=9))


def py_money(v):
    """None -> 0.0; strip the marks, float(); NaN -> 0.0; raises on other text."""
    if v is None:
        return 0.0
    x = float(re.sub(r"[$(),]", "", v))
    return 0.0 if x != x else x


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(money_text, min_size=1, max_size=25))
def test_money_matches_python(spark, values):
    ok, bad = [], []
    for v in values:
        try:
            ok.append((v, py_money(v)))
        except ValueError:
            bad.append(v)
    if ok:
        assert evaluate(spark, [v for v, _ in ok], C.money) == [w for _, w in ok]
    for v in bad[:1]:
        try:
            evaluate(spark, [v], C.money)
        except Exception:  # noqa: BLE001 - the job must fail on unparsable text
            continue
        raise AssertionError(f"money({v!r}) should fail")
