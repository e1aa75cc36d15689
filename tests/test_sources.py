import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.functions.names import accept_file, normalize_header
from snapfeed.sources import csv as CSV
from snapfeed.sources.files import list_files, new_feed_files
from snapfeed.sources.json_rows import append_json_rows, split_json_rows
from snapfeed.sources.tables import (append_query, ensure_table, export_csv, replace_table, run_query,
                                     run_script)


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_csv_na_literals_short_rows_and_empty_rows(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "a.csv"), 'a,b,c\n1,NA,"x\ny"\n2,n/a\n,,\nNone,null,\n3,4,5\n')
    df = CSV.read_csv(spark, p)
    assert df.columns == ["a", "b", "c"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", None, "x\ny"), ("2", None, None), ("3", "4", "5")]


def test_read_csv_long_row_fails(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "b.csv"), "a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        CSV.read_csv(spark, p).collect()


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType()),
                       T.StructField("note", T.StringType())])


def test_typed_csv_flags_bad_and_long_rows(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "c.csv"), "id,amt,note\n1,2.5,a\nx,1,b\n3,4\n4,5,c,extra\n5,6,d,e,f\n")
    df = CSV.read_csv_typed(spark, p, SCHEMA)
    got = {r["note"] if r["note"] else r["id"]: r["_bad"] for r in df.collect()}
    assert got == {"a": False, "b": True, 3: False, "c": True, "d": True}


def test_load_csv_limit(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "d.csv"), "id,amt,note\n1,2.5,a\nx,1,b\ny,1,c\n")
    out = os.path.join(tmp_dir, "out")
    rejects = os.path.join(tmp_dir, "rejects")
    assert CSV.load_csv(spark, p, SCHEMA, out, max_bad_records=2, reject_path=rejects) == {"rows": 1, "bad": 2}
    assert spark.read.parquet(out).count() == 1
    kept = sorted(json.loads(r[0])["_corrupt"] for r in spark.read.text(rejects).collect())
    assert kept == ["x,1,b", "y,1,c"]  # refused rows are kept as read
    for limit, path in ((1, rejects), (0, None)):
        with pytest.raises(ValueError):
            CSV.load_csv(spark, p, SCHEMA, os.path.join(tmp_dir, "out2"), max_bad_records=limit, reject_path=path)
    with pytest.raises(ValueError, match="reject_path"):
        CSV.load_csv(spark, p, SCHEMA, out, max_bad_records=2)


def test_file_order_columns(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "e.csv"), "a\n" + "".join(f"{i}\n" for i in range(100)))
    df = CSV.with_file_order(spark.read.option("header", True).csv(p))
    rows = df.orderBy(CSV.SOURCE_FILE, CSV.SPLIT_START, CSV.ROW_IN_SPLIT).select("a").collect()
    assert [int(r[0]) for r in rows] == list(range(100))


def test_json_rows(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "{bad"), (3, '{"k": null}')], "id int, v string")
    good, bad = split_json_rows(df, "v", T.StructType([T.StructField("k", T.LongType())]))
    assert sorted(tuple(r) for r in good.collect()) == [(1, 5), (3, None)]
    assert [r["id"] for r in bad.collect()] == [2]


def test_json_rows_without_content_or_with_unknown_fields(spark):
    df = spark.createDataFrame([(1, None), (2, " "), (3, "[1]"), (4, '{"k": 1, "z": 2, "y": {}}'), (5, "{}"), (6, '{"k": "x"}'), (7, "7")], "id int, v string")
    good, bad = split_json_rows(df, "v", T.StructType([T.StructField("k", T.LongType())]))
    assert [tuple(r) for r in good.collect()] == [(5, None)]
    errors = {r["id"]: r["_error"] for r in bad.collect()}
    assert set(errors) == {1, 2, 3, 4, 6, 7}
    assert errors[1] == errors[2] == "no content" and errors[4] == "unknown fields: z, y"


def test_header_normalization():
    assert normalize_header("PAT COPAY/COINS") == "PAT_COPAY_COINS"
    assert normalize_header("SCA _ APPROVED DATE") == "SCA__APPROVED_DATE"
    assert normalize_header("Supplier - Name") == "Supplier___Name"


def test_accept_file_rules(spark):
    names = ["RX_FEED_2025-05-05.csv", "rx_feed_2025-02-30.csv", "20250505- Benefit Summary.xlsx",
             "x 20250505- BENEFIT SUMMARY.xlsx", "20250230- BENEFIT SUMMARY.xlsx", "other.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(accept_file("name", "RX_FEED", "BENEFIT SUMMARY")).collect()]
    assert got == [True, False, True, False, False, False]


def test_listing_and_ledger(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    for n in ["RX_FEED_2025-05-05.csv", "RX_FEED_2025-05-06.csv", "junk.csv"]:
        write(os.path.join(land, n), "a\n1\n")
    files = list_files(spark, land)
    assert "content" not in files.columns
    ledger = spark.createDataFrame([("bucket/RX_FEED_2025-05-05.csv",)], "name string")
    got = [r["name"] for r in new_feed_files(files, ledger, "RX_FEED", "BENEFIT SUMMARY").collect()]
    assert got == ["RX_FEED_2025-05-06.csv"]


def test_tables_ddl_append_script_replace(spark, tmp_dir):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()),
                           T.StructField("d", T.DateType())])
    assert ensure_table(spark, "t_stage", schema, partition_col="d", cluster_cols=["k"], buckets=4)
    assert not ensure_table(spark, "t_stage", schema, partition_col="d")
    assert append_query(spark, "SELECT 'x' AS v, DATE'2024-01-01' AS d, 1L AS k", "t_stage") == 1
    assert run_query(spark, "SELECT count(*) FROM t_stage WHERE k = :k", args={"k": 1}).first()[0] == 1
    counts = []
    run_script(spark, ["INSERT INTO t_stage BY NAME SELECT 2L AS k, 'y' AS v, DATE'2024-01-02' AS d", "SELECT 1"], counts)
    assert counts == [1, None]
    assert spark.table("t_stage").count() == 2
    res = run_script(spark, "SELECT 1; SELECT 2 AS two").first()[0]
    assert res == 2
    new = spark.table("t_stage").withColumn("v", F.upper("v"))
    replace_table(spark, new, "t_replaced", os.path.join(tmp_dir, "replaced"))
    replace_table(spark, spark.table("t_replaced").where("k = 1"), "t_replaced", os.path.join(tmp_dir, "replaced"))
    assert [tuple(r)[:2] for r in spark.table("t_replaced").collect()] == [(1, "X")]
    path = export_csv(spark.table("t_replaced"), tmp_dir, "export_", __import__("datetime").date(2024, 3, 9))
    assert path.endswith("export_20240309.csv")
    assert spark.read.option("header", True).csv(path).count() == 1


def test_append_json_rows(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS t_json (k BIGINT, name STRING) USING parquet")
    df = spark.createDataFrame([('{"k": 1, "name": "a"}',), ("{oops",), ('{"name": "b", "k": 2}',), (None,), ('{"k": 3, "extra": 1}',)], "v string")
    bad = append_json_rows(df, "v", "t_json")
    assert sorted(r["v"] for r in bad.collect()) == ["", "{oops", '{"k": 3, "extra": 1}'][:1] + sorted(["{oops", '{"k": 3, "extra": 1}'])
    assert sorted(tuple(r) for r in spark.table("t_json").collect()) == [(1, "a"), (2, "b")]


def test_scan_file_name_is_decoded(spark, tmp_dir):
    d = os.path.join(tmp_dir, "names")
    os.makedirs(d)
    write(os.path.join(d, "20240105- A+B summary.csv"), "a\n1\n")
    df = CSV.with_file_order(spark.read.option("header", True).csv(d))
    assert df.first()[CSV.SOURCE_FILE] == "20240105- A+B summary.csv"


def test_load_csv_detects_schema(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "auto.csv"), "id,amt,note\n1,2.5,a\n2,3.5,b\n")
    out = os.path.join(tmp_dir, "auto_out")
    assert CSV.load_csv(spark, p, None, out) == {"rows": 2, "bad": 0}
    df = spark.read.parquet(out)
    assert dict(df.dtypes) == {"id": "int", "amt": "double", "note": "string"}


def test_read_csv_with_file_order_feeds_clean_rx(spark, tmp_dir):
    from snapfeed.plans.feeds import RX_FEED_COLUMNS, clean_rx
    header = ",".join(RX_FEED_COLUMNS)
    rows = []
    for i, serial in enumerate(["NI-1", "", "", "NM-2"]):
        cells = [""] * len(RX_FEED_COLUMNS)
        cells[0], cells[1], cells[2], cells[3], cells[4], cells[32] = "1", str(i), "2024-01-01", "2024-01-02", serial, "5"
        rows.append(",".join(cells))
    p = write(os.path.join(tmp_dir, "RX_FEED_2024-01-03.csv"), header + "\n" + "\n".join(rows) + "\n")
    raw = CSV.read_csv(spark, p, file_order=True)
    carry = [CSV.SOURCE_FILE, CSV.SPLIT_START, CSV.ROW_IN_SPLIT]
    out = clean_rx(raw, "2024-01-03", ndc_value=5, placeholder="PH", order_col=CSV.ROW_IN_SPLIT,
                   bucket_col=CSV.SPLIT_START, group_extra=[CSV.SOURCE_FILE], carry=carry)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    got = sorted((r["Rx_Number"], r["modified_serial_id"]) for r in out.collect())
    assert got == [(0, "NI-1"), (1, "NI-1refill1"), (2, "NI-1refill2"), (3, "NM-2")]
