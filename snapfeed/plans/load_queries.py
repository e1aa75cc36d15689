"""Queries for loads that decide by the data itself or report about their run: elected
date formats, counts taken in passing, bucketed merges, repeated stream batches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.operators.dates import parse_dates
from snapfeed.operators.snapshot import exclude_keys_counted
from snapfeed.operators.windows import dedup_latest
from snapfeed.plans import adapters as A
from snapfeed.plans.queries import _last_orders
from snapfeed.plans.registry import register
from snapfeed.session import read_table, scratch_path
from snapfeed.sources.counts import counted
from snapfeed.sources.json_rows import json_rows_sink
from snapfeed.sources.tables import merge_into_buckets, run_script


@register("date_election", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 1 END AS next_day FROM orders""")
def q_date_election(spark, sf_dir):
    """Orders as files by priority, each with its own date format in two columns: day
    first and month first are told apart by the values."""
    o = read_table(spark, sf_dir, "orders")
    shape = {"1-URGENT": "yyyy-MM-dd", "2-HIGH": "d/M/yyyy", "3-MEDIUM": "M/d/yyyy"}

    def text(day):
        out = F.date_format(day, "yyyyMMdd")
        for priority, fmt in shape.items():
            out = F.when(F.col("o_orderpriority") == priority, F.date_format(day, fmt)).otherwise(out)
        return out

    files = o.select("o_orderkey", F.col("o_orderpriority").alias("file"), text(F.col("o_orderdate")).alias("day"),
                     F.when(F.col("o_orderstatus") != "P", text(F.date_add("o_orderdate", 1))).alias("next_day"))
    parsed = parse_dates(files, ["day", "next_day"], ("yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyyMMdd"), ["file"])
    return parsed.select("o_orderkey", "day", "next_day")


@register("dedup_text_order", """
SELECT l_suppkey, l_linestatus, l_returnflag, l_orderkey, l_linenumber, dup_count FROM (
  SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS dup_count,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linestatus DESC NULLS LAST, l_returnflag ASC NULLS FIRST, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def q_dedup_text_order(spark, sf_dir):
    """First line of each supplier by two texts in opposite directions."""
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linestatus", "l_returnflag", "l_orderkey", "l_linenumber")
    return dedup_latest(li, ["l_suppkey"], ["l_linestatus desc", "l_returnflag", "l_orderkey", "l_linenumber"], count_col="dup_count")


@register("merge_buckets", f"""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderdate < TIMESTAMP '{A.ORDER_SPLIT_DAY}' AS early FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, early ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn,
             count(*) OVER (PARTITION BY o_custkey, early) AS n_orders FROM o),
b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY early) AS pick FROM r WHERE rn = 1)
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, n_orders FROM b WHERE pick = 1""")
def q_merge_buckets(spark, sf_dir):
    """The merge of later into earlier last orders, into a table in sorted buckets."""
    o = read_table(spark, sf_dir, "orders")
    split = F.lit(A.ORDER_SPLIT_DAY).cast("timestamp_ntz")
    table, root = f"merged_{uuid.uuid4().hex}", scratch_path(spark, f"buckets-{uuid.uuid4().hex}")
    merge_into_buckets(spark, table, _last_orders(o.where(F.col("o_orderdate") < split)), ["o_custkey"], 8, root)
    place = merge_into_buckets(spark, table, _last_orders(o.where(F.col("o_orderdate") >= split)), ["o_custkey"], 8, root)
    spark.sql(f"DROP TABLE {table}")  # the name only
    return spark.read.parquet(place)


@register("observed_counts", """
SELECT 'orders in' AS what, count(*) AS n FROM orders
UNION ALL SELECT 'without a clerk', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'kept', count(*) FROM orders WHERE o_orderpriority <> '5-LOW' AND NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')
UNION ALL SELECT 'script, statement 1', count(*) FROM customer
UNION ALL SELECT 'script, statement 2', count(*) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'joined', count(*) FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_observed_counts(spark, sf_dir):
    """Counts of what a key exclusion takes in and drops, of each write inside of a script
    text, and of a query's rows, all from the run that makes the rows."""
    o, c = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer")
    keyed = o.select("o_custkey", "o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("clerk"))
    kept, before, after = exclude_keys_counted(keyed, ["clerk", "o_orderstatus"], [("2-HIGH", "F")])
    kept.write.format("noop").mode("overwrite").save()

    view = f"customers_{uuid.uuid4().hex}"
    tables = [f"{view}_{i}" for i in range(2)]
    c.createOrReplaceTempView(view)
    make = "; ".join(f"CREATE TABLE {t} (k BIGINT) USING parquet LOCATION '{scratch_path(spark, t)}'" for t in tables)
    statements: list = []
    run_script(spark, f"{make}; INSERT INTO {tables[0]} SELECT c_custkey FROM {view}; INSERT INTO {tables[1]} SELECT c_custkey FROM {view} WHERE c_acctbal < 0", statements)
    for t in tables:
        spark.sql(f"DROP TABLE {t}")
    spark.catalog.dropTempView(view)

    joined, rows = counted(o.join(c, F.col("o_custkey") == F.col("c_custkey")))
    joined.write.format("noop").mode("overwrite").save()
    found = {"orders in": before["rows"], "without a clerk": before["null_keys"], "kept": after["rows"], "joined": rows["rows"]}
    found |= {f"script, statement {i}": s.rows for i, s in enumerate(statements, 1)}
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("what"), F.lit(v).cast("long").alias("n")) for k, v in found.items()])))


@register("json_batches", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type = 'click' AS late, CAST(NULL AS VARCHAR) AS error FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, NULL, false, 'not readable with the schema' FROM events WHERE event_type = 'error'""")
def q_json_batches(spark, sf_dir):
    """Events as JSON rows in two batches, the first delivered twice: its rows are there
    once, and refused rows are kept aside."""
    e = read_table(spark, sf_dir, "events")
    good = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    late = F.col("event_type") == "click"
    text = e.select(late.alias("late"), F.when(F.col("event_type") == "error", F.concat(F.lit("{bad "), F.col("event_id").cast("string"))).otherwise(good).alias("value"))
    path, rejects = (scratch_path(spark, f"{n}-{uuid.uuid4().hex}") for n in ("json", "json-refused"))
    sink = json_rows_sink(T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType())]), path, rejects)
    for batch, rows in ((0, text.where(~F.col("late"))), (1, text.where("late")), (0, text.where(~F.col("late")))):
        sink(rows, batch)
    kept = spark.read.parquet(path).select("event_id", F.col("k").cast("double").alias("k"), (F.col("_batch") == 1).alias("late"), F.lit(None).cast("string").alias("error"))
    bad = spark.read.parquet(rejects).select(F.regexp_extract("value", "[0-9]+", 0).cast("long").alias("event_id"), F.lit(None).cast("double").alias("k"),
                                             F.lit(False).alias("late"), F.col("_error").alias("error"))
    return kept.unionByName(bad)
