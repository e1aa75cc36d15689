"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver's tables. The DuckDB twin of each lives in :mod:`snapfeed.plans.oracle`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.operators.merge import merge_upsert
from snapfeed.operators.snapshot import distinct_rows, exclude_keys, in_list, latest_snapshot
from snapfeed.operators.windows import add_dup_count, dedup_latest, refill_numbering
from snapfeed.plans import adapters as A
from snapfeed.plans import rx
from snapfeed.plans.registry import register
from snapfeed.session import read_table


# --- snapshot stage ----------------------------------------------------------

@register("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    return latest_snapshot(A.fills(spark, sf_dir))


@register("distinct_rows")
def q_distinct_rows(spark, sf_dir):
    f = A.fills(spark, sf_dir)
    return distinct_rows(f.select(rx.PATIENT, rx.RX, "Serial__", "Script_Status", "_snapshot_date"))


@register("derived_cols")
def q_derived_cols(spark, sf_dir):
    f = rx.derive_rx_columns(A.fills(spark, sf_dir), A.BASE_AMOUNT)
    return f.select("row_order", "substatus", "by_copay", rx.SERIAL_C, rx.DISPENSE_C)


@register("in_list")
def q_in_list(spark, sf_dir):
    return in_list(A.fills(spark, sf_dir), "Script_Status", A.RX_STATUSES).select("row_order", "Script_Status")


@register("key_exclusion")
def q_key_exclusion(spark, sf_dir):
    f = A.fills(spark, sf_dir)
    return exclude_keys(f, [rx.PATIENT, rx.RX, "Serial__"], A.EXCLUDED_SERIALS).select("row_order", rx.PATIENT, rx.RX, "Serial__")


# --- windows / dedup / merge -------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate desc", "l_partkey", "l_suppkey", "l_extendedprice"]


@register("dup_count")
def q_dup_count(spark, sf_dir):
    return add_dup_count(read_table(spark, sf_dir, "lineitem"), LINE_KEYS)


@register("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return dedup_latest(li, LINE_KEYS, LINE_ORDER, count_col="dup_count")


@register("refill_number")
def q_refill_number(spark, sf_dir):
    f = A.fills(spark, sf_dir)
    out = refill_numbering(f, rx.PATIENT, "Serial__", "Dispense_Date", "NDC", "row_order",
                           ndc_value=A.REFILL_NDC, placeholder=A.PLACEHOLDER)
    return out.select("row_order", rx.PATIENT, "Serial__", "modified_serial_id")


def _last_orders(orders: DataFrame) -> DataFrame:
    o = orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return dedup_latest(o, ["o_custkey"], ["o_orderdate desc", "o_orderkey desc"], count_col="n_orders")


@register("merge_upsert")
def q_merge_upsert(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    split = F.lit(A.ORDER_SPLIT_DAY).cast("timestamp_ntz")
    staging = _last_orders(o.where(F.col("o_orderdate") < split))
    batch = _last_orders(o.where(F.col("o_orderdate") >= split))
    return merge_upsert(staging, batch, ["o_custkey"], with_action=True)


def rx_flagship(spark, sf_dir):
    f = A.fills(spark, sf_dir)
    args = dict(base_amount=A.BASE_AMOUNT, statuses=A.RX_STATUSES, excluded_keys=A.EXCLUDED_KEYS,
                position=["row_order"])
    latest = f.select(F.max("_snapshot_date")).scalar()
    staging = rx.rx_source(f.where(F.col("_snapshot_date") < latest), latest=False, **args)
    return rx.rx_upsert(staging, f, **args)


register("rx_upsert")(rx_flagship)


# --- further operator views -------------------------------------------------------

@register("merge_counts")
def q_merge_counts(spark, sf_dir):
    from snapfeed.operators.merge import merge_counts
    return merge_counts(q_merge_upsert(spark, sf_dir)).withColumnRenamed("count", "n_rows")


@register("dedup_latest_window")
def q_dedup_latest_window(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return dedup_latest(li, LINE_KEYS, LINE_ORDER, method="window")


@register("seq_within_group")
def q_seq_within_group(spark, sf_dir):
    from snapfeed.operators.windows import number_within_group
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    return number_within_group(e, ["user_id"], "event_id", "seq")


@register("rx_exact_duplicates")
def q_rx_exact_duplicates(spark, sf_dir):
    """Every error fill stands in the feed three times, at three positions."""
    f = A.fills(spark, sf_dir)
    again = f.where(F.col("Script_Status") == "error")
    for k in (1, 2):
        f = f.unionByName(again.withColumn("row_order", F.col("row_order") + k * A.COPY_OFFSET))
    return rx.rx_source(f, base_amount=A.BASE_AMOUNT, statuses=A.RX_STATUSES, excluded_keys=A.EXCLUDED_KEYS, position=["row_order"])


@register("rx_batch_source")
def q_rx_batch_source(spark, sf_dir):
    f = A.fills(spark, sf_dir)
    return rx.rx_source(f, base_amount=A.BASE_AMOUNT, statuses=A.RX_STATUSES, excluded_keys=A.EXCLUDED_KEYS,
                        position=["row_order"], latest=False, per_snapshot=True)
