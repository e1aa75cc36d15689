import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapfeed.operators.windows import add_dup_count, dedup_latest, number_within_group, refill_numbering


def rows_of(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dedup_aggregate_equals_window(spark):
    random.seed(1)
    data = [(random.randint(0, 20), random.choice([None, 1, 2, 3]), random.random(), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, d int, x double, i long")
    order = ["d desc", "i"]
    a = dedup_latest(df, ["k"], order, count_col="n", method="aggregate")
    w = dedup_latest(df, ["k"], order, count_col="n", method="window")
    assert rows_of(a, ["k", "d", "x", "i", "n"]) == rows_of(w, ["k", "d", "x", "i", "n"])
    assert a.agg(F.sum("n")).first()[0] == 2000
    assert a.count() == df.select("k").distinct().count()


def test_dedup_ascending_nulls_first(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (2, 3, 3), (2, 1, 4)], "k int, d int, i int")
    a = dedup_latest(df, ["k"], ["d"], method="aggregate")
    assert rows_of(a, ["k", "i"]) == [(1, 1), (2, 4)]


def test_dedup_text_orders(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, None, 3), (2, "c", 4), (2, "c", 5)],
                               "k int, s string, i int")
    for method in ("aggregate", "window"):
        # ASC text (min form), NULLS FIRST
        assert rows_of(dedup_latest(df, ["k"], ["s", "i desc"], method=method), ["k", "i"]) == [(1, 3), (2, 5)]
        # DESC text (max form), NULLS LAST
        assert rows_of(dedup_latest(df, ["k"], ["s desc", "i"], method=method), ["k", "i"]) == [(1, 1), (2, 4)]
        # text both ways
        assert rows_of(dedup_latest(df, ["k"], ["s", "s desc", "i"], method=method), ["k", "i"]) == [(1, 3), (2, 4)]
    with pytest.raises(ValueError, match="method='window'"):  # no opposite order: never a silent window
        dedup_latest(df.withColumn("a", F.array("i")), ["k"], ["a", "s desc", "a desc"])


def test_dup_count_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows_of(add_dup_count(df, ["k"]), ["v", "dup_count"]) == [(1, 2), (2, 2), (3, 1)]


def test_number_within_group_matches_row_number(spark):
    random.seed(2)
    hot = [(0, i) for i in range(0, 5000, 3)]
    other = [(random.randint(1, 5), i) for i in range(1, 5000, 3)]
    df = spark.createDataFrame(hot + other, "g int, o long")
    got = number_within_group(df, ["g"], "o", "seq", bucket_bits=6)
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert rows_of(got, ["g", "o", "seq"]) == rows_of(want, ["g", "o", "seq"])


def test_refill_numbering_cases(spark):
    ndc, ph = 111, "PH"
    rows = [
        # patient 1: one original serial -> blank / placeholder dispensed rows numbered in order
        (1, "NI-1", "2024-01-01", ndc, 1), (1, "", "2024-01-02", ndc, 2), (1, None, "2024-01-03", ndc, 3),
        (1, "x PH y", "2024-01-04", ndc, 4), (1, "", None, ndc, 5), (1, "", "2024-01-05", 222, 6),
        (1, "NI-1", "2024-01-06", ndc, 7),
        # patient 2: two distinct originals -> untouched
        (2, "NI-1", "2024-01-01", ndc, 8), (2, "NI-2", "2024-01-01", ndc, 9), (2, "", "2024-01-02", ndc, 10),
        # patient 3: no original
        (3, "", "2024-01-02", ndc, 11),
        # NULL patient: untouched
        (None, "NI-9", "2024-01-01", ndc, 12), (None, "", "2024-01-02", ndc, 13),
    ]
    df = spark.createDataFrame(rows, "p long, s string, d string, ndc long, o long")
    out = refill_numbering(df, "p", "s", "d", "ndc", "o", ndc_value=ndc, placeholder=ph, prefix="NI")
    got = dict((r["o"], r["modified_serial_id"]) for r in out.collect())
    assert got[2] == "NI-1refill1" and got[3] == "NI-1refill2" and got[4] == "NI-1refill3"
    assert got[5] == "" and got[6] == "" and got[7] == "NI-1" and got[1] == "NI-1"
    assert got[10] == "" and got[11] == "" and got[13] == ""
    assert out.count() == len(rows)
