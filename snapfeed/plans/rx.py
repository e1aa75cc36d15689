"""Prescription feed pipeline: snapshot history -> deduplicated upsert source ->
MERGE into the staging table (latest snapshot, exact-duplicate removal, key
dedup with a duplicate count, keyed upsert)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.operators.merge import merge_upsert
from snapfeed.operators.snapshot import (SNAPSHOT_COL, distinct_rows, exclude_keys, in_list,
                                         latest_snapshot, with_defaults)
from snapfeed.operators.windows import dedup_latest

PATIENT = "De_identified_Patient_ID"
RX = "Rx_Number"
SERIAL = "Serial__"
DISPENSE = "Dispense_Date"
SERIAL_C = "Serial_coalesce"
DISPENSE_C = "Dispense_Date_coalesce"
RX_KEYS = [PATIENT, RX, SERIAL_C, DISPENSE_C]

# Defaults that stand in for a missing serial / dispense date in the key.
UNKNOWN_SERIAL = "Unknown"
NO_DATE = _dt.date(1000, 1, 1)


def derive_rx_columns(df: DataFrame, base_amount: float, status_detail: str = "CLOSED_STATUS",
                      copay: str = "Copay") -> DataFrame:
    """substatus, ``by_copay = base_amount - copay`` and the two key defaults."""
    df = df.withColumns({
        "substatus": F.col(status_detail),
        "by_copay": F.lit(float(base_amount)) - F.col(copay),
    })
    return with_defaults(df, {SERIAL_C: (SERIAL, UNKNOWN_SERIAL), DISPENSE_C: (DISPENSE, NO_DATE)})


def rx_source(snapshots: DataFrame, *, base_amount: float, statuses: list[str],
              excluded_keys: list[tuple] = (), status_col: str = "Script_Status",
              position: list[str] = (), latest: bool = True, per_snapshot: bool = False,
              snapshot_col: str = SNAPSHOT_COL) -> DataFrame:
    """The MERGE source: one row per key with ``dup_count``, the number of its
    different rows.

    ``position`` columns (where a row stood) are left out when exact duplicates
    are removed; ascending, they make the winner among equal dispense dates
    deterministic. ``per_snapshot`` (with ``latest=False``) gives what
    merging each snapshot in date order would leave: per key, the row and
    count of its newest snapshot.
    """
    df = latest_snapshot(snapshots, snapshot_col) if latest else snapshots
    df = derive_rx_columns(df, base_amount)
    df = exclude_keys(df, RX_KEYS, list(excluded_keys), drop_null_keys=True)
    df = in_list(df, status_col, statuses)
    df = distinct_rows(df, list(position))
    order = [f"{DISPENSE} desc"] + list(position)
    if not per_snapshot:
        return dedup_latest(df, RX_KEYS, order, count_col="dup_count")
    per_day = dedup_latest(df, RX_KEYS + [snapshot_col], order, count_col="dup_count")
    return dedup_latest(per_day, RX_KEYS, [f"{snapshot_col} desc"])


# Staging partition derived from a key (a key never changes partition).
DISPENSE_MONTH = "_dispense_month"


# Rows without a dispense date are spread over this many partitions by their key,
# as they would otherwise be one partition that every batch rewrites.
UNDISPENSED_PARTS = 64


def with_dispense_month(df: DataFrame, undispensed_parts: int = UNDISPENSED_PARTS) -> DataFrame:
    part = F.pmod(F.xxhash64(PATIENT, RX), F.lit(undispensed_parts)).cast("string")
    month = F.when(F.col(DISPENSE_C) == F.lit(NO_DATE), F.concat(F.lit("none-"), part)).otherwise(F.date_format(DISPENSE_C, "yyyy-MM"))
    return df.withColumn(DISPENSE_MONTH, month)


def rx_upsert(target: DataFrame, snapshots: DataFrame, **source_args) -> DataFrame:
    """New staging-table content after merging the latest snapshot."""
    source = rx_source(snapshots, **source_args)
    # Keys are non-NULL here: patient and rx are filtered by the exclusion
    # step, serial and date are coalesced.
    return merge_upsert(target, source, RX_KEYS, validate_source=False, salt_null_keys=False)
