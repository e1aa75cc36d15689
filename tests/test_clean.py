import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapfeed.functions import clean as C


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def run(spark, values, expr):
    df = one_col(spark, values)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_int_or_default_truncates_decimal_text(spark):
    got = run(spark, ["3", "3.0", " 4 ", "x", None, "3.9", "-2.5"], lambda c: C.int_or_default(c, 0))
    assert got == [3, 3, 4, 0, 0, 3, -2]


def test_int_or_default_text_mode_rejects_decimals(spark):
    got = run(spark, ["3", "3.0", " 4 ", "x", None], lambda c: C.int_or_default(c, -1, decimal_text="default"))
    assert got == [3, -1, 4, -1, -1]


def test_strict_int_null_is_zero_and_bad_fails(spark):
    assert run(spark, ["3", "3.0", None], C.strict_int_null0) == [3, 3, 0]
    with pytest.raises(Exception):
        run(spark, ["x"], C.strict_int_null0)


def test_numeric_or_zero(spark):
    got = run(spark, ["07001", "12345-6789", "12.9", None, "NaN", "x"], C.numeric_or_zero_int)
    assert got == [7001, 0, 12, 0, 0, 0]


def test_numeric_or_null_and_fraction_fails(spark):
    assert run(spark, ["07001", "12345-6789", None, "5.0"], C.numeric_or_null_int) == [7001, None, None, 5]
    with pytest.raises(Exception):
        run(spark, ["12.5"], C.numeric_or_null_int)


def test_first_digits(spark):
    assert run(spark, ["NPI 1234x7", "none", None, "007"], C.first_digits) == [1234, 0, 0, 7]


def test_money(spark):
    got = run(spark, ["$1,234.50", "(5.00)", None, "nan", "12"], C.money)
    assert got == [1234.5, 5.0, 0.0, 0.0, 12.0]
    signed = run(spark, ["(5.00)", "$3"], lambda c: C.money(c, accounting_negatives=True))
    assert signed == [-5.0, 3.0]
    with pytest.raises(Exception):
        run(spark, ["abc"], C.money)


def test_labels(spark):
    assert run(spark, ["a", None], lambda c: C.fill_label(c, "N/A")) == ["a", "N/A"]
    assert run(spark, ["a", None], C.stringify) == ["a", "nan"]
    assert run(spark, ["a", None], lambda c: C.stringify(c, None)) == ["a", None]


def test_strict_date(spark):
    assert run(spark, ["20250228", None], lambda c: C.strict_date(c, "yyyyMMdd")) == [dt.date(2025, 2, 28), None]
    with pytest.raises(Exception):
        run(spark, ["20250230"], lambda c: C.strict_date(c, "yyyyMMdd"))


def test_timestamp_or_column(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-05-05 10:00:00"), ("junk", "2024-05-05 10:00:00"),
                                (None, "2024-05-05 10:00:00")], "v string, f string")
    got = [r[0] for r in df.select(C.timestamp_or_column("v", F.to_timestamp_ntz("f"))).collect()]
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(2024, 5, 5, 10), dt.datetime(2024, 5, 5, 10)]


def test_clean_serial(spark):
    values = [None, "", "   ", "\tNI-77 \n", "lot NM-12a", "NI", "plain", "x NI-ab_1 NM-2", "NIé-1"]
    got = run(spark, values, C.clean_serial)
    assert got == [None, "", "", "NI-77", "NM-12a", "NI", "plain", "NI-ab_1", "NIé-1"]


def test_py_strip_unicode_space(spark):
    assert run(spark, ["  a b　"], C.py_strip) == ["a b"]


def test_default_date_formats_accept_unpadded(spark):
    assert run(spark, ["2024-1-5", "2024-01-05"], C.strict_date) == [dt.date(2024, 1, 5)] * 2
    got = run(spark, ["2024-1-5 7:05:00", "2024-01-05"],
              lambda c: C.timestamp_or_column(c, F.lit(None).cast("timestamp_ntz")))
    assert got == [dt.datetime(2024, 1, 5, 7, 5), dt.datetime(2024, 1, 5)]
