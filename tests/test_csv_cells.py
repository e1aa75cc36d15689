"""CSV cells in and out, with pandas as the model."""

import csv
import datetime as dt
import glob
import io
import os

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.sources import csv as C
from snapfeed.sources.tables import export_csv

EXAMPLES = int(os.environ.get("SNAPFEED_PROPERTY_EXAMPLES", "25"))


def put(folder, text, name="in.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def rows(df):
    return [tuple(r) for r in df.collect()]


def by_pandas(path):
    frame = pd.read_csv(path, dtype=str).dropna(how="all")
    return list(frame.columns), [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False, name=None)]


cell = st.text(alphabet='",\\\n x1é', max_size=6)


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=8), st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
def test_cells_as_pandas_reads_them(spark, tmp_path_factory, table, quoting):
    out = io.StringIO()
    csv.writer(out, quoting=quoting, lineterminator="\n").writerows([("a", "b", "c"), *table])
    path = put(str(tmp_path_factory.mktemp("csv")), out.getvalue())
    names, want = by_pandas(path)
    got = C.read_csv(spark, path)
    assert got.columns == names and rows(got) == want


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=6))
def test_export_is_read_back_by_pandas(spark, tmp_path_factory, table):
    folder = str(tmp_path_factory.mktemp("out"))
    path = export_csv(spark.createDataFrame(table, "a string, b string").coalesce(1), folder, "p_", dt.date(2024, 1, 2))
    (part,) = glob.glob(path + "/part-*.csv")
    want = [tuple(v if v not in C.NA_LITERALS else None for v in r) for r in table]
    frame = pd.read_csv(part, dtype=str, skip_blank_lines=False)
    assert [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False, name=None)] == want
    assert sorted(rows(C.read_csv(spark, path)), key=str) == sorted((r for r in want if r != (None, None)), key=str)


def test_quotes_and_backslashes_lose_no_row(spark, tmp_dir):
    path = put(tmp_dir, 'a,b,c\n1,"C:\\dir\\",y\n2,"say ""hi"", now",z\n3,5" pipe,"6"""\n')
    assert rows(C.read_csv(spark, path)) == [("1", "C:\\dir\\", "y"), ("2", 'say "hi", now', "z"), ("3", '5" pipe', '6"')]


@pytest.mark.parametrize("line", ["1,2,3,", "1,2,3,,", "1,2,3,,lost", "1,2,3,4", '1,2,3,"",""', '1,"2,2",3,,', '1,"a\nb",3,,x', "1,2,3" + "," * 40])
def test_wide_rows_fail(spark, tmp_dir, line):
    path = put(tmp_dir, f"a,b,c\n{line}\n")
    with pytest.raises(Exception, match="longer than header"):
        C.read_csv(spark, path).collect()
    assert len(rows(C.read_csv(spark, path, fail_on_long_rows=False))) == 1


@pytest.mark.parametrize("line, cells", [("1", 1), ("1,2", 2), ('"1,1,1,1,1"', 1), ('"a""b,c",2', 2), ('5" x,6" y', 2), ('"a\nb,c,d,e","f"', 2)])
def test_short_rows_are_padded(spark, tmp_dir, line, cells):
    got = C.read_csv(spark, put(tmp_dir, f"a,b,c,d\n{line}\n")).collect()
    assert len(got) == 1 and [v is not None for v in got[0]] == [True] * cells + [False] * (4 - cells)


def test_count_of_a_long_quoted_cell(spark):
    text = '"' + 'x""y,' * 50_000 + '",2,3'
    assert spark.createDataFrame([(text,)], "t string").select(C.cell_count(F.col("t"))).first()[0] == 3


def test_other_separator(spark, tmp_dir):
    path = put(tmp_dir, 'a|b\n"1|1"|2,2\n')
    assert rows(C.read_csv(spark, path, sep="|")) == [("1|1", "2,2")]
    with pytest.raises(Exception, match="longer than header"):
        C.read_csv(spark, put(tmp_dir, "a|b\n1|2||\n", "wide.csv"), sep="|").collect()


@pytest.mark.parametrize("header", ["a,a,b,a", "a,a.1,a", ",x,", "a.b,a.b", "a,b"])
def test_repeated_headers_as_pandas_names_them(spark, tmp_dir, header):
    n = header.count(",") + 1
    path = put(tmp_dir, f"{header}\n" + ",".join(map(str, range(n))) + "\n" + "," * (n - 1) + "\n")
    got = C.read_csv(spark, path)
    names, want = by_pandas(path)
    assert got.columns == names and rows(got) == want
    assert C.infer_csv_schema(spark, path).names == names


def test_load_refuses_wide_rows(spark, tmp_dir):
    path = put(tmp_dir, 'k,v\n1,"a ""b"""\n2,b,,lost\n3,c\n')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    assert C.load_csv(spark, path, schema, f"{tmp_dir}/t", max_bad_records=1, reject_path=f"{tmp_dir}/r") == {"rows": 2, "bad": 1}
    assert sorted(rows(spark.read.parquet(f"{tmp_dir}/t"))) == [(1, 'a "b"'), (3, "c")]
    assert "lost" in spark.read.text(f"{tmp_dir}/r").first()[0]
