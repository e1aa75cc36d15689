"""Queries for documents of unknown shape. A customer is a document whose fields
depend on its market segment; an order is an edit whose fields depend on its status."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapfeed.operators import payloads as P
from snapfeed.plans.registry import register
from snapfeed.session import read_table


def _documents(spark, sf_dir):
    """``balance`` is a number or a text, ``address`` an object, a text or missing."""
    c = read_table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    address = F.to_variant_object(F.struct(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("line")))
    shape = (F.when(segment == "BUILDING", F.to_variant_object(F.struct(F.col("c_acctbal").alias("balance"), address.alias("address"))))
             .when(segment == "AUTOMOBILE", F.to_variant_object(F.struct(F.lit("n/a").alias("balance"), F.array("c_mktsegment").alias("tags"))))
             .otherwise(F.to_variant_object(F.struct(F.col("c_acctbal").alias("balance"), F.lit("none").alias("address")))))
    return c.select(F.col("c_custkey").alias("key"), shape.alias("payload"), "c_nationkey")


def _edits(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    shape = (F.when(status == "F", F.to_variant_object(F.struct(F.col("o_totalprice").alias("balance"))))
             .when(status == "O", F.to_variant_object(F.struct(F.col("o_orderpriority").alias("address.nation"))))
             .otherwise(F.to_variant_object(F.struct(F.struct(F.col("o_orderkey").alias("order")).alias("last")))))
    return o.select(F.col("o_custkey").alias("key"), shape.alias("payload"), F.col("o_orderkey").alias("seq"))


def _get(path: str, kind: str):
    return F.try_variant_get(P.field("payload", path), "$", kind)


_BALANCE = "CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_acctbal END"


@register("payload_upsert", f"""
WITH e AS (SELECT o_custkey AS key, arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS balance,
                  arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS nation,
                  max(o_orderkey) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS last_order FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, e.key) AS key, coalesce(e.balance, {_BALANCE}) AS balance,
       coalesce(e.nation, CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) END) AS nation,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS line, CAST(last_order AS DOUBLE) AS last_order,
       CASE WHEN e.nation IS NOT NULL OR c_mktsegment = 'BUILDING' THEN 'object' WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'text' END AS address_kind,
       c_mktsegment IS NOT NULL AND c_mktsegment = 'AUTOMOBILE' AS has_tags
FROM customer FULL JOIN e ON c_custkey = e.key""")
def q_payload_upsert(spark, sf_dir):
    docs = P.payload_upsert(_documents(spark, sf_dir).drop("c_nationkey"), _edits(spark, sf_dir), seq="seq")
    return docs.select("key", _get("balance", "double").alias("balance"), _get("address.nation", "string").alias("nation"), _get("address.line", "string").alias("line"),
                       _get("last.order", "double").alias("last_order"), P.value_kind(P.field("payload", "address")).alias("address_kind"),
                       P.field("payload", "tags").isNotNull().alias("has_tags"))


@register("payload_where", """
SELECT c_custkey AS key, 'rich' AS filter FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' AND c_acctbal > 5000
UNION ALL SELECT c_custkey, 'no balance' FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL SELECT c_custkey, 'nation' FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN (3, 7)
UNION ALL SELECT c_custkey, 'tag' FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL SELECT c_custkey, 'elsewhere' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE')""")
def q_payload_where(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    filters = {"rich": ("balance", ">", 5000), "no balance": ("balance", ">=", ""), "nation": ("address.nation", "in", [3, 7, "3"]),
               "tag": ("tags", "array-contains", "AUTOMOBILE"), "elsewhere": ("address", "==", "none")}
    found = [P.payload_where(docs, *f).select("key", F.lit(name).alias("filter")) for name, f in filters.items()]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@register("payload_ordered", """
SELECT c_nationkey, arg_min(c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN (1, 0.0, c_custkey) ELSE (0, c_acctbal, c_custkey) END) AS first_key,
       arg_max(c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN (1, 0.0, c_custkey) ELSE (0, c_acctbal, c_custkey) END) AS last_key,
       count(*) AS n FROM customer GROUP BY 1""")
def q_payload_ordered(spark, sf_dir):
    """The first and last document of each nation in the order that ``payload_ordered``
    sorts by: numbers before texts."""
    by = F.struct(P.order_key(P.field("payload", "balance")).alias("v"), F.col("key"))
    docs = P.payload_ordered(_documents(spark, sf_dir), "balance")
    return docs.groupBy("c_nationkey").agg(F.min_by("key", by).alias("first_key"), F.max_by("key", by).alias("last_key"), F.count("*").alias("n"))
