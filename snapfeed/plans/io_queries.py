"""Queries for the ingest helpers: scans, SQL text, appends, schemas, header
clean-up, missing-value literals, bad records and JSON rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.functions.names import normalize_headers
from snapfeed.operators.schema import enforce_schema, rename_map, rename_positional, select_schema
from snapfeed.plans.registry import register
from snapfeed.session import read_table, scratch_path, table_path
from snapfeed.sources import csv as CSV
from snapfeed.sources.json_rows import parse_json_rows
from snapfeed.sources.files import list_files
from snapfeed.sources.tables import append_query, appended, ensure_table, run_query, run_script, write_path


@register("scan_parquet", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'""")
def q_scan_parquet(spark, sf_dir):
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    return li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity")


@register("run_query", """
SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_regionkey >= 1""")
def q_run_query(spark, sf_dir):
    views = {"sf_nation": read_table(spark, sf_dir, "nation"), "sf_region": read_table(spark, sf_dir, "region")}
    sql = ("SELECT n.n_name, r.r_name FROM sf_nation n JOIN sf_region r ON n.n_regionkey = r.r_regionkey "
           "WHERE r.r_regionkey >= :min_region")
    return run_query(spark, sql, args={"min_region": 1}, views=views)


@register("append_query", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
UNION ALL
SELECT n_nationkey + 100, lower(n_name), n_regionkey FROM nation""")
def q_append_query(spark, sf_dir):
    nation = read_table(spark, sf_dir, "nation")
    rows = nation.select("n_regionkey", F.lower("n_name").alias("n_name"),
                         (F.col("n_nationkey") + 100).alias("n_nationkey"))
    return appended(nation, rows)


NATION_SCHEMA = T.StructType([T.StructField("n_nationkey", T.LongType()), T.StructField("n_name", T.StringType()),
                              T.StructField("n_regionkey", T.LongType())])


@register("enforce_schema", """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation""")
def q_enforce_schema(spark, sf_dir):
    return enforce_schema(read_table(spark, sf_dir, "nation"), NATION_SCHEMA)


@register("rename_positional", """
SELECT r_regionkey AS region_id, r_name AS region_name FROM region""")
def q_rename_positional(spark, sf_dir):
    return rename_positional(read_table(spark, sf_dir, "region"), ["region_id", "region_name"])


@register("normalize_headers", """
SELECT s_suppkey AS Supplier_Id, s_name AS Supplier___Name, s_acctbal AS MED_CLAIM_PAYMENT, s_nationkey AS Nation__Key
FROM supplier""")
def q_normalize_headers(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").toDF("Supplier Id", "Supplier - Name", "Nation _ Key", "CLAIM/PAYMENT")
    s = rename_map(normalize_headers(s), {"CLAIM_PAYMENT": "MED_CLAIM_PAYMENT", "ABSENT": "IGNORED"})
    return select_schema(s, ["Supplier_Id", "Supplier___Name", "MED_CLAIM_PAYMENT", "Nation__Key"])


def _supplier_text(s):
    neg = F.col("s_acctbal") < 0
    bal = F.col("s_acctbal").cast("decimal(12,2)").cast("string")
    return s.select(F.when(neg, F.lit("NA")).otherwise(F.col("s_name")).alias("name"),
                    F.when(neg, F.lit("n/a")).otherwise(F.col("s_nationkey").cast("string")).alias("nation"),
                    F.when(neg, F.lit("")).otherwise(bal).alias("bal"))


@register("drop_all_null", """
WITH t AS (SELECT CASE WHEN s_acctbal < 0 THEN 'NA' ELSE s_name END AS name,
                  CASE WHEN s_acctbal < 0 THEN 'n/a' ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
                  CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS bal
           FROM supplier)
SELECT name, nation, bal FROM t WHERE NOT (name = 'NA' AND nation = 'n/a' AND bal = '')""")
def q_drop_all_null(spark, sf_dir):
    t = _supplier_text(read_table(spark, sf_dir, "supplier"))
    return CSV.drop_all_null(CSV.na_to_null(t))


SUPPLIER_SCHEMA = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                                T.StructField("s_acctbal", T.DoubleType())])


@register("bad_records", """
WITH t AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, s_name,
                  CASE WHEN s_nationkey IN (3, 7) THEN 'n/a' || CAST(s_suppkey AS VARCHAR)
                       ELSE CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS bal FROM supplier)
SELECT TRY_CAST(k AS BIGINT) AS s_suppkey, s_name, TRY_CAST(bal AS DOUBLE) AS s_acctbal,
       (bal IS NOT NULL AND TRY_CAST(bal AS DOUBLE) IS NULL) AS _bad
FROM t""")
def q_bad_records(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    bal = (F.when(F.col("s_nationkey").isin(3, 7), F.concat(F.lit("n/a"), F.col("s_suppkey").cast("string")))
           .otherwise(F.col("s_acctbal").cast("decimal(12,2)").cast("string")))
    t = s.select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name", bal.alias("s_acctbal"))
    return CSV.flag_bad_records(t, SUPPLIER_SCHEMA)


@register("json_rows", """
WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN '{bad' WHEN event_type = 'signup' THEN NULL
                  WHEN event_type = 'view' THEN '{"k": 1, "other": 2}' ELSE props END AS v FROM events),
g AS (SELECT event_id, v, v IS NOT NULL AND json_valid(v) AND event_type <> 'view' AS good FROM t JOIN (SELECT event_id, event_type FROM events) USING (event_id))
SELECT event_id, CAST(CASE WHEN good THEN TRY_CAST(json_extract_string(v, '$.k') AS BIGINT) END AS DOUBLE) AS k,
       NOT good AS is_corrupt,
       CASE WHEN good THEN NULL WHEN v IS NULL THEN 'no content' WHEN json_valid(v) THEN 'unknown fields: other' ELSE 'not readable with the schema' END AS error
FROM g""")
def q_json_rows(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    t = e.select("event_id", F.when(F.col("event_type") == "error", F.lit("{bad")).when(F.col("event_type") == "signup", F.lit(None).cast("string"))
                 .when(F.col("event_type") == "view", F.lit('{"k": 1, "other": 2}')).otherwise(F.col("props")).alias("v"))
    p = parse_json_rows(t, "v", T.StructType([T.StructField("k", T.LongType())]))
    return p.select("event_id", F.col("k").cast("double").alias("k"), F.col("_error").isNotNull().alias("is_corrupt"),
                    F.col("_error").alias("error"))


# --- files, tables and scripts: written below the shared scratch folder ------------

def _new_path(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _new_table(name):
    return f"{name}_{uuid.uuid4().hex}"


_SUPPLIER_TEXT_SQL = """t AS (SELECT CASE WHEN s_acctbal < 0 THEN 'NA' ELSE s_name END AS name,
                  CASE WHEN s_acctbal < 0 THEN 'n/a' ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
                  CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS bal FROM supplier)"""


def _hard_name():
    """Names with quotes, separators, backslashes, line ends and outer blanks, by nation."""
    kind, name = F.col("s_nationkey") % 4, F.col("s_name")
    return (F.when(kind == 0, F.concat(F.lit('say "'), name, F.lit('", C:\\dir\\')))
            .when(kind == 1, F.concat(name, F.lit(',\n"second" line\\')))
            .when(kind == 2, F.concat(F.lit('  5" of '), name, F.lit(" "))).otherwise(name))


_HARD_NAME_SQL = r"""CASE s_nationkey % 4 WHEN 0 THEN 'say "' || s_name || '", C:\dir\' WHEN 1 THEN s_name || ',' || chr(10) || '"second" line\'
                   WHEN 2 THEN '  5" of ' || s_name || ' ' ELSE s_name END"""


@register("read_csv", f"""
SELECT {_HARD_NAME_SQL} AS name, CAST(s_nationkey AS VARCHAR) AS nation, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS bal
FROM supplier WHERE s_acctbal >= 0""")
def q_read_csv(spark, sf_dir):
    """All suppliers through CSV files: cells come back as they were, missing literals
    become NULL, all-empty rows go."""
    path = _new_path(spark, "csv")
    s = read_table(spark, sf_dir, "supplier")
    missing = _supplier_text(s.where("s_acctbal < 0"))
    filled = _supplier_text(s.where("s_acctbal >= 0").withColumn("s_name", _hard_name()))
    CSV.csv_writer(filled.unionByName(missing)).csv(path)
    return CSV.read_csv(spark, path, ["name", "nation", "bal"])


@register("load_csv", f"""
SELECT CASE WHEN s_nationkey IN (3, 7, 11) THEN 'refused' ELSE 'loaded' END AS part, count(*) AS n,
       CAST(sum(s_suppkey) AS DOUBLE) AS keys, CAST(sum(length({_HARD_NAME_SQL})) AS DOUBLE) AS name_chars FROM supplier GROUP BY 1""")
def q_load_csv(spark, sf_dir):
    """Rows whose balance doesn't convert, and rows of too many cells of which the first
    further one is empty, are refused and kept as text."""
    s = read_table(spark, sf_dir, "supplier")
    bad, wide = F.col("s_nationkey").isin(3, 7), F.col("s_nationkey") == 11
    name = F.concat(F.lit('"'), F.replace(_hard_name(), F.lit('"'), F.lit('""')), F.lit('"'))
    balance = F.when(bad, F.lit("x")).otherwise(F.col("s_acctbal").cast("decimal(12,2)").cast("string"))
    line = F.concat_ws(",", F.col("s_suppkey").cast("string"), name, balance, F.when(wide, F.lit(",lost")))
    source, target, rejects = (_new_path(spark, n) for n in ("csv", "loaded", "refused"))
    s.select(line).write.text(source)
    CSV.load_csv(spark, source, SUPPLIER_SCHEMA, target, max_bad_records=s.count(), reject_path=rejects, skip_leading_rows=0)
    loaded = spark.read.parquet(target).select(F.lit("loaded").alias("part"), "s_suppkey", "s_name")
    cell = lambda c: F.get_json_object("value", f"$.{c}")
    refused = spark.read.schema("value string").text(rejects).select(F.lit("refused").alias("part"), cell("s_suppkey").cast("long").alias("s_suppkey"), cell("s_name").alias("s_name"))
    both = loaded.unionByName(refused).groupBy("part").agg(F.count("*").alias("n"), F.sum("s_suppkey").alias("keys"), F.sum(F.length("s_name")).alias("name_chars"))
    return both.withColumns({c: F.col(c).cast("double") for c in ("keys", "name_chars")})


@register("insert_query", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
UNION ALL
SELECT n_nationkey + 100, lower(n_name), n_regionkey FROM nation""")
def q_insert_query(spark, sf_dir):
    """``ensure_table`` and the INSERT of ``append_query`` on a catalog table."""
    nation = read_table(spark, sf_dir, "nation")
    table, view = _new_table("nation_copy"), _new_table("nation_rows")
    ensure_table(spark, table, nation.schema, cluster_cols=["n_nationkey"], buckets=4, location=_new_path(spark, "nation"))
    nation.createOrReplaceTempView(view)
    append_query(spark, f"SELECT n_regionkey, n_name, n_nationkey FROM {view}", table)
    append_query(spark, f"SELECT lower(n_name) AS n_name, n_nationkey + 100 AS n_nationkey, n_regionkey FROM {view}", table)
    return spark.table(table)


@register("script_counts", """
SELECT 'orders' AS step, count(*) AS n FROM orders UNION ALL SELECT 'lines', count(*) FROM lineitem
UNION ALL SELECT 'joined', count(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def q_script_counts(spark, sf_dir):
    """A script of writes; its affected-row counts, read from a table that the script's counts fill."""
    views = {}
    for name in ("orders", "lineitem"):
        views[name] = _new_table(name)
        read_table(spark, sf_dir, name).createOrReplaceTempView(views[name])
    tables = [_new_table(n) for n in ("orders", "lines", "joined")]
    counts: list = []
    run_script(spark, [f"CREATE TABLE {t} (k BIGINT) USING parquet LOCATION '{_new_path(spark, 'script')}'" for t in tables])
    run_script(spark, [f"INSERT INTO {tables[0]} SELECT o_orderkey FROM {views['orders']}",
                       f"INSERT INTO {tables[1]} SELECT l_orderkey FROM {views['lineitem']}",
                       f"INSERT INTO {tables[2]} SELECT a.k FROM {tables[0]} a JOIN {tables[1]} b ON a.k = b.k"], counts)
    steps = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(n).cast("long").alias("n")) for s, n in zip(("orders", "lines", "joined"), counts)])
    return spark.range(1).select(F.inline(steps))


@register("write_modes", """
SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey + 10, r_name FROM region""")
def q_write_modes(spark, sf_dir):
    """Truncate twice and append once: the first content is gone."""
    region = read_table(spark, sf_dir, "region")
    path = _new_path(spark, "modes")
    write_path(region.withColumn("r_name", F.lit("old")), path, "truncate")
    write_path(region, path, "truncate")
    write_path(region.withColumn("r_regionkey", F.col("r_regionkey") + 10), path, "append")
    return spark.read.parquet(path)


@register("list_files", """
SELECT 'c_nationkey=' || c_nationkey AS folder, count(*) AS n_rows FROM customer GROUP BY c_nationkey""")
def q_list_files(spark, sf_dir):
    """Customers written in a folder per nation; the listing finds each folder's files."""
    path = _new_path(spark, "listing")
    read_table(spark, sf_dir, "customer").repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(path)
    folder = F.element_at(F.split("path", "/"), -2)
    found = list_files(spark, path, "*.parquet", recursive=True).select(folder.alias("folder")).distinct()
    rows = spark.read.parquet(path).groupBy(F.concat(F.lit("c_nationkey="), "c_nationkey").alias("folder")).agg(F.count("*").alias("n_rows"))
    return found.join(rows, "folder")
