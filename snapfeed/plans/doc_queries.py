"""Queries for the document-collection operators.

Collections are built from ``customer`` / ``orders``: a customer is a document,
orders before a cut-off day give its initial arrays, later orders are the edit
batch (the order key is the edit sequence).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from snapfeed.operators import docs as D
from snapfeed.plans.adapters import ORDER_SPLIT_DAY
from snapfeed.plans.registry import register
from snapfeed.session import read_table

_SPLIT_SQL = f"TIMESTAMP '{ORDER_SPLIT_DAY}'"


def _split():
    return F.lit(ORDER_SPLIT_DAY).cast("timestamp_ntz")


def _customer_docs(spark, sf_dir):
    return read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_acctbal", "c_mktsegment")


# Every order names a document: its customer, or, for the orders of one
# priority, an id beyond all customers (a document that does not exist yet).
BEYOND = 10 ** 9


def _named(column: str = "o_custkey"):
    return F.when(F.col("o_orderpriority") == "5-LOW", F.col(column) + BEYOND).otherwise(F.col(column))


_NAMED_SQL = f"CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + {BEYOND} ELSE o_custkey END"


@register("docs_upsert", f"""
WITH coll AS (SELECT c_custkey AS key, c_name, c_acctbal, c_mktsegment FROM customer),
e AS (SELECT {_NAMED_SQL} AS key, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS seq, o_orderkey FROM orders
      WHERE o_orderstatus <> 'P' OR o_orderkey IN (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'P' GROUP BY {_NAMED_SQL})),
last AS (SELECT key, arg_max(o_totalprice, coalesce(seq, -1)) AS c_acctbal FROM e GROUP BY key)
SELECT coalesce(c.key, l.key) AS key, c.c_name,
       CASE WHEN l.key IS NOT NULL THEN l.c_acctbal ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment
FROM coll c FULL JOIN last l ON c.key = l.key""")
def q_docs_upsert(spark, sf_dir):
    # Every order is an edit. Those of status 'P' have no sequence number: of a
    # document only the newest of them comes in, as two would have no order.
    o = read_table(spark, sf_dir, "orders").withColumn("key", _named())
    unordered = F.col("o_orderstatus") == "P"
    newest = o.where(unordered).groupBy("key").agg(F.max_by("o_totalprice", "o_orderkey").alias("c_acctbal")).withColumn("seq", F.lit(None).cast("long"))
    edits = o.where(~unordered).select("key", F.col("o_totalprice").alias("c_acctbal"), F.col("o_orderkey").alias("seq")).unionByName(newest)
    return D.docs_upsert(_customer_docs(spark, sf_dir), edits, key="key", seq="seq")


def _tag_docs(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return (o.where(F.col("o_orderdate") < _split()).groupBy(F.col("o_custkey").alias("key"))
            .agg(F.array_sort(F.collect_set("o_orderpriority")).alias("tags"),
                 F.array_sort(F.collect_set("o_orderstatus")).alias("tags_archive")))


def _later_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") >= _split())


_COLL_SQL = f"""coll AS (SELECT o_custkey AS key, list_sort(list_distinct(list(o_orderpriority))) AS tags,
                 list_sort(list_distinct(list(o_orderstatus))) AS tags_archive
          FROM orders WHERE o_orderdate < {_SPLIT_SQL} GROUP BY o_custkey)"""


def _add_sql(field: str, values: str, cond: str = "true") -> str:
    return f"""
WITH {_COLL_SQL},
ev AS (SELECT o_custkey AS key, o_orderkey AS seq, unnest({values}) AS v, generate_subscripts({values}, 1) AS pos
       FROM orders WHERE o_orderdate >= {_SPLIT_SQL} AND {cond}),
firsts AS (SELECT key, v, min(seq * 10 + pos) AS f FROM ev GROUP BY key, v),
fresh AS (SELECT f.key, list(f.v ORDER BY f.f) AS vals FROM firsts f JOIN coll c ON f.key = c.key
          WHERE NOT list_contains(c.{field}, f.v) GROUP BY f.key)
SELECT c.key, array_to_string(list_concat(c.{field}, coalesce(fresh.vals, [])), '|') AS {field}_text
FROM coll c LEFT JOIN fresh ON c.key = fresh.key"""


def _remove_sql(field: str, values: str, cond: str = "true") -> str:
    return f"""
WITH {_COLL_SQL},
rem AS (SELECT DISTINCT o_custkey AS key, unnest({values}) AS v FROM orders
        WHERE o_orderdate >= {_SPLIT_SQL} AND {cond}),
elems AS (SELECT key, unnest({field}) AS v, generate_subscripts({field}, 1) AS pos FROM coll),
kept AS (SELECT e.key, list(e.v ORDER BY e.pos) AS vals FROM elems e
         WHERE NOT EXISTS (SELECT 1 FROM rem r WHERE r.key = e.key AND r.v = e.v) GROUP BY e.key)
SELECT c.key, array_to_string(coalesce(k.vals, []), '|') AS {field}_text
FROM coll c LEFT JOIN kept k ON c.key = k.key"""


@register("array_add", _add_sql("tags", "[o_orderstatus, o_orderpriority]"))
def q_array_add(spark, sf_dir):
    edits = _later_orders(spark, sf_dir).select(
        F.col("o_custkey").alias("key"), F.array("o_orderstatus", "o_orderpriority").alias("values"),
        F.col("o_orderkey").alias("seq"))
    out = D.array_add(_tag_docs(spark, sf_dir), edits, "tags", seq="seq")
    return out.select("key", F.array_join("tags", "|").alias("tags_text"))


@register("array_remove", _remove_sql("tags", "[o_orderpriority]"))
def q_array_remove(spark, sf_dir):
    edits = _later_orders(spark, sf_dir).select(
        F.col("o_custkey").alias("key"), F.array("o_orderpriority").alias("values"))
    out = D.array_remove(_tag_docs(spark, sf_dir), edits, "tags")
    return out.select("key", F.array_join("tags", "|").alias("tags_text"))


@register("array_archive", _add_sql("tags_archive", "[o_orderstatus]"))
def q_array_archive(spark, sf_dir):
    edits = _later_orders(spark, sf_dir).select(
        F.col("o_custkey").alias("key"), F.array("o_orderstatus").alias("values"), F.col("o_orderkey").alias("seq"))
    out = D.array_archive(_tag_docs(spark, sf_dir), edits, "tags", seq="seq")
    return out.select("key", F.array_join("tags_archive", "|").alias("tags_archive_text"))


@register("array_unarchive", _remove_sql("tags_archive", "[o_orderstatus]"))
def q_array_unarchive(spark, sf_dir):
    edits = _later_orders(spark, sf_dir).select(F.col("o_custkey").alias("key"), F.array("o_orderstatus").alias("values"))
    out = D.array_unarchive(_tag_docs(spark, sf_dir), edits, "tags")
    return out.select("key", F.array_join("tags_archive", "|").alias("tags_archive_text"))


@register("read_by_ids", f"""
SELECT o.o_orderkey AS pos, c.c_custkey AS key, c.c_name, c.c_acctbal, c.c_mktsegment
FROM orders o JOIN customer c ON {_NAMED_SQL} = c.c_custkey""")
def q_read_by_ids(spark, sf_dir):
    # Request list: the customer of every order, in order-key order.
    o = read_table(spark, sf_dir, "orders")
    ids = o.select(F.col("o_orderkey").alias("pos"), _named().alias("id"))
    return D.read_by_ids(_customer_docs(spark, sf_dir), ids, key="key", id_col="id", pos_col="pos")


@register("read_ordered", """
SELECT c_custkey AS key, c_name, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal""")
def q_read_ordered(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_acctbal")
    return D.read_ordered(c, "c_acctbal")


@register("read_where", """
SELECT c_custkey AS key, c_name, c_nationkey AS nation FROM customer WHERE c_nationkey IN (1, 3, 5, 7)""")
def q_read_where(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), "c_name",
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("addr"))
    out = D.read_where(c, "addr.nation", "in", [1, 3, 5, 7])
    return out.select("key", "c_name", F.col("addr.nation").alias("nation"))


@register("add_routing", """
SELECT s_suppkey, s_name, 'suppliers' AS collection_id, s_suppkey AS doc_id FROM supplier""")
def q_add_routing(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    out = D.add_routing(s, "suppliers", "s_suppkey")
    return out.select("s_suppkey", "s_name", F.col("fs_location.collection_id").alias("collection_id"),
                      F.col("fs_location.doc_id").alias("doc_id"))


@register("lookup_nested", """
WITH m AS (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS user_key FROM events)
SELECT m.event_id, m.user_key, c.c_name AS chat_id FROM m LEFT JOIN customer c ON m.user_key = c.c_custkey""")
def q_lookup_nested(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    msgs = e.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("user_key"))
    users = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.struct(F.col("c_name").alias("id")).alias("chat"))
    return D.lookup_nested(msgs, users, "user_key", "key", "chat.id", "chat_id")


@register("missing_ids", f"""
SELECT pos, id FROM (SELECT o_orderkey AS pos, {_NAMED_SQL} AS id FROM orders)
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = id)""")
def q_missing_ids(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    ids = o.select(F.col("o_orderkey").alias("pos"), _named().alias("id"))
    return D.missing_ids(_customer_docs(spark, sf_dir), ids, key="key", id_col="id")
