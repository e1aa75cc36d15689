"""Elected date formats, counts in passing, bucketed merges, repeated stream batches."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.operators.dates import parse_dates
from snapfeed.operators.merge import merge_upsert
from snapfeed.operators.snapshot import exclude_keys_counted
from snapfeed.operators.windows import dedup_latest
from snapfeed.sources.counts import counted
from snapfeed.sources.json_rows import append_json_stream, json_rows_sink
from snapfeed.sources.tables import merge_into_buckets, run_query_counted, run_script, write_buckets

FORMATS = ("yyyy-M-d", "d/M/yyyy", "M/d/yyyy")


def files(spark, *columns):
    return spark.createDataFrame([(f"f{i}", t) for i, c in enumerate(columns) for t in c], "file string, day string")


def days(df):
    return sorted(((r[0], None if r[1] is None else r[1].isoformat()) for r in df.collect()), key=str)


def test_each_file_has_its_own_format(spark):
    df = files(spark, ["2024-1-2", None, "2024-12-31"], ["13/2/2024", "1/2/2024"], ["2/13/2024", "1/2/2024"], [None, None], ["5/5/2024"])
    assert days(parse_dates(df, ["day"], FORMATS, ["file"])) == sorted([
        ("f0", "2024-01-02"), ("f0", None), ("f0", "2024-12-31"), ("f1", "2024-02-13"), ("f1", "2024-02-01"), ("f2", "2024-02-13"), ("f2", "2024-01-02"),
        ("f3", None), ("f3", None), ("f4", "2024-05-05")], key=str)


@pytest.mark.parametrize("column, message", [(["2024-1-2", "1/20/2024"], "no one date format"), (["13/2/2024", "2/13/2024"], "no one date format"), (["x"], "no one date format"),
                                             (["1/2/2024", "3/4/2024"], "different dates"), (["1/2/2024", None], "different dates")])
@pytest.mark.parametrize("by", [[], ["file"]])
def test_mixed_and_ambiguous_columns_are_refused(spark, column, message, by):
    with pytest.raises(Exception, match=message):
        parse_dates(files(spark, column), ["day"], FORMATS, by).collect()


def test_dates_without_files(spark):
    df = files(spark, ["13/2/2024", None])
    assert days(parse_dates(df, ["day"], FORMATS)) == [("f0", "2024-02-13"), ("f0", None)]
    assert parse_dates(df.where("false"), ["day"], FORMATS).count() == 0 and parse_dates(df.where("false"), ["day"], FORMATS, ["file"]).count() == 0
    stamped = parse_dates(files(spark, ["2024-1-2 3:04:05"]), ["day"], ("yyyy-M-d H:m:s", "M/d/yyyy"), kind="timestamp")
    assert stamped.schema["day"].dataType == T.TimestampNTZType() and stamped.first()[1].hour == 3


def test_counts_come_from_the_same_run(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(100).select((F.col("id") % 10).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("v")).mapInArrow(touch, "k long, v long")
    kept, before, after = exclude_keys_counted(rows, ["k", "v"], [(1, 1), (1, 11)])
    assert kept.count() == 73 and (before["rows"], before["null_keys"], after["rows"]) == (100, 25, 73) and seen.value == 100
    some, counts = counted(rows.limit(7), odd=F.col("k") % 2 == 1)
    assert some.count() == counts["rows"] == 7 and counts["odd"] == 3
    empty, none = run_query_counted(spark, "SELECT 1 AS x WHERE false")
    assert empty.count() == none["rows"] == 0


def test_counts_of_statements_inside_a_script_text(spark, tmp_dir):
    t = f"t_{uuid.uuid4().hex}"
    found: list = []
    run_script(spark, f"""BEGIN
        DECLARE n INT = 1500;
        CREATE TABLE {t} (k BIGINT) USING parquet LOCATION '{tmp_dir}/t';
        INSERT INTO {t} SELECT id FROM range(1500);
        IF n > 1000 THEN INSERT INTO {t} SELECT id FROM range(3); END IF;
        INSERT INTO {t} SELECT id FROM range(10) WHERE id > 100;
        SELECT count(*) FROM {t};
    END""", found)
    assert [s.rows for s in found] == [1500, 3, 0] and all("Insert" in s.command for s in found)
    spark.sql(f"DROP TABLE {t}")


def test_bucketed_merge_has_no_exchange_on_either_side(spark, tmp_dir):
    names = [f"b_{uuid.uuid4().hex}" for _ in range(2)]
    for i, n in enumerate(names):
        write_buckets(spark.range(i * 50, 1000 + i * 50).select((F.col("id") % 700).alias("k"), F.col("id").alias("k2"), F.lit(i).alias("v")), n, ["k", "k2"], 4, f"{tmp_dir}/{n}")
    merged = merge_upsert(spark.table(names[0]), spark.table(names[1]), ["k", "k2"], salt_null_keys=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert merged.count() == 1050
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_merge_into_buckets(spark, tmp_dir):
    rng, table, model = random.Random(4), f"m_{uuid.uuid4().hex}", {}
    for step in range(3):
        batch = {rng.randrange(60): rng.randrange(1000) for _ in range(40)}
        source = spark.createDataFrame([(k, v, None) for k, v in batch.items()] + [(None, step, "null key")], "k long, v long, note string")
        place = merge_into_buckets(spark, table, source, ["k"], 4, f"{tmp_dir}/root")
        model |= batch
        rows = spark.table(table).collect()
        assert {r.k: r.v for r in rows if r.k is not None} == model and sum(r.k is None for r in rows) == step + 1
        files = [f for f in os.listdir(place) if f.endswith(".parquet")]
        assert len(files) <= 4 * (1 if step else 8)
    assert len([d for d in os.listdir(f"{tmp_dir}/root")]) == 2  # this version and the one before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table}__")]
    with pytest.raises(ValueError):
        merge_into_buckets(spark, table, source, ["k"], 4, "relative/root")
    spark.sql(f"DROP TABLE {table}")


def test_repeated_json_batch_leaves_its_rows_once(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    batch = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no"}',), (None,), ('{"a": 2, "c": 3}',), ('{"a": 4}',)], "value string")
    sink = json_rows_sink(schema, f"{tmp_dir}/good", f"{tmp_dir}/bad")
    for batch_id in (0, 1, 0, 1):
        sink(batch, batch_id)
    good, bad = spark.read.parquet(f"{tmp_dir}/good"), spark.read.parquet(f"{tmp_dir}/bad")
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(a, b, i) for i in (0, 1) for a, b in ((1, "x"), (4, None))], key=str)
    assert bad.groupBy("_batch").count().collect()[0]["count"] == 3 and bad.where("_error is null").count() == 0


def test_json_stream(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.LongType())])
    for part in range(2):
        spark.createDataFrame([(f'{{"a": {part}}}',), ("{",)], "value string").coalesce(1).write.mode("append").text(f"{tmp_dir}/in")
        append_json_stream(spark.readStream.text(f"{tmp_dir}/in"), schema, f"{tmp_dir}/good", f"{tmp_dir}/bad", f"{tmp_dir}/check")
        assert sorted(r.a for r in spark.read.parquet(f"{tmp_dir}/good").collect()) == list(range(part + 1))
    assert spark.read.parquet(f"{tmp_dir}/bad").count() == 2


def test_text_ordered_both_ways(spark):
    """Against Python's order, nulls and texts that begin others included."""
    rng = random.Random(9)
    texts = [None, "", "a", "ab", "b", "é", "a\x00", "z" * 40]
    rows = [(i % 5, rng.choice(texts), rng.choice(texts), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, down string, up string, id long")
    got = {r.k: r.id for r in dedup_latest(df, ["k"], ["down desc", "up", "id"]).collect()}
    window = {r.k: r.id for r in dedup_latest(df, ["k"], ["down desc", "up", "id"], method="window").collect()}
    place = lambda t: (t is not None, (t or "").encode())
    for k in range(5):
        mine = [r for r in rows if r[0] == k]
        top = max(place(r[1]) for r in mine)
        want = min((place(r[2]), r[3]) for r in mine if place(r[1]) == top)[1]
        assert got[k] == window[k] == want
    plan = dedup_latest(df, ["k"], ["down desc", "up", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
