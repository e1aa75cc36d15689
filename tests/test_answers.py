import os

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from snapfeed.functions import answers as AN

EXAMPLES = int(os.environ.get("SNAPFEED_PROPERTY_EXAMPLES", "25"))


def py_words(answer):
    if answer is None or not answer.isascii() or not answer.isdigit():
        return None, None
    n = int(answer)
    return n & 0xFFFF, (n >> 16) & 0xFFFF


def py_decode(answer, q, groups):
    if answer is None:
        return None
    if not (answer.isascii() and answer.isdigit()) or answer == "0":
        return answer
    low, high = py_words(answer)
    for qs, bits, flagged in groups:
        if q in qs:
            out = []
            for i in range(bits):
                n = 1 << i
                if n & low:
                    out.append(f"{n}h" if flagged and (n & high) else str(n))
            return ", ".join(out)
    return answer


BASE = [(AN.BASELINE_QUESTIONS, AN.BASELINE_BITS, False)]
DAILY = [(AN.DAILY_PLAIN_QUESTIONS, AN.DAILY_PLAIN_BITS, False), (AN.DAILY_FLAGGED_QUESTIONS, AN.DAILY_FLAGGED_BITS, True)]
EDGE = ["0", "00", "21", "12345678901234567890", "98765432109876543210987654321098765432", "x", "", None, "65537"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "answer string, q int")


def test_split_words_edges(spark):
    df = frame(spark, [(a, 1) for a in EDGE])
    low, high = AN.split_words("answer")
    got = [(r[0], r[1]) for r in df.select(low, high).collect()]
    assert got == [py_words(a) for a in EDGE]


def test_decoders_match_python(spark):
    rows = [(a, q) for a in EDGE for q in (12, 13, 14, 57, 60, 62, None)]
    df = frame(spark, rows)
    got = df.select(AN.decode_baseline("answer", "q"), AN.decode_daily("answer", "q")).collect()
    for (a, q), r in zip(rows, got):
        assert r[0] == py_decode(a, q, BASE), (a, q)
        assert r[1] == py_decode(a, q, DAILY), (a, q)


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10 ** 40), min_size=1, max_size=20))
def test_words_property(spark, numbers):
    answers = [str(n) for n in numbers]
    df = frame(spark, [(a, 60) for a in answers])
    low, high = AN.split_words("answer")
    got = [(r[0], r[1]) for r in df.select(low, high).collect()]
    assert got == [py_words(a) for a in answers]
    dec = [r[0] for r in df.select(AN.decode_daily("answer", F.lit(60))).collect()]
    assert dec == [py_decode(a, 60, DAILY) for a in answers]


def test_final_newline_is_no_digit(spark):
    from snapfeed.functions import answers as AN
    df = spark.createDataFrame([("5\n", 12), ("5", 12), ("\n5", 12)], "answer string, question_id int")
    assert [r[0] for r in df.select(AN.decode_baseline("answer", "question_id")).collect()] == ["5\n", "1, 4", "\n5"]
