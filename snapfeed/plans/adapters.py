"""Feed-shaped views derived from the driver's tables.

The prescription feed is modelled on ``events``: a user is a patient, an event
a dispensed fill, and the event time falls into one of three ten-day
snapshots. Every derived column is a plain expression over the whole table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfeed.session import read_table

# Parameters of the modelled feed (our own values).
SNAPSHOT_ORIGIN = "2024-01-01"
SNAPSHOT_DAYS = 10
RX_MODULUS = 50
REFILL_NDC = 10020030040
OTHER_NDC = 50060070080
PLACEHOLDER = "PENDING-LOT"
BASE_AMOUNT = 100.0
RX_STATUSES = ["click", "error", "signup"]
# Keys excluded by the SQL stage (patient, rx, serial, dispense date); both have
# rows at every scale.
EXCLUDED_KEYS = [(2, 37, "Unknown", _dt.date(1000, 1, 1)), (3, 9, "Unknown", _dt.date(1000, 1, 1))]
EXCLUDED_SERIALS = [(0, 12, "NI-0"), (1, 37, "NM-1"), (1, 38, "NM-1")]
# Added to row_order for further copies of a row.
COPY_OFFSET = 10 ** 9
# Orders before this day form the staging table, later ones the upsert batch.
ORDER_SPLIT_DAY = "1999-01-01"


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    origin = F.lit(SNAPSHOT_ORIGIN).cast("date")
    days = F.datediff(F.col("ts"), origin)
    snapshot = F.date_add(origin, (F.floor(days / SNAPSHOT_DAYS) * SNAPSHOT_DAYS).cast("int"))
    et = F.col("event_type")
    serial = (F.when(et == "signup",
                     F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("NI-"), F.col("user_id").cast("string")))
                     .otherwise(F.concat(F.lit("NI-"), (F.col("event_id") % 5).cast("string"))))
              .when(et == "error", F.lit(PLACEHOLDER))
              .when(et == "click", F.lit(None).cast("string"))
              .otherwise(F.concat(F.lit("NM-"), F.col("user_id").cast("string"))))
    return e.select(
        F.col("user_id").alias("De_identified_Patient_ID"),
        (F.col("event_id") % RX_MODULUS).alias("Rx_Number"),
        F.when(et == "click", F.lit(None).cast("date")).otherwise(F.col("ts").cast("date")).alias("Dispense_Date"),
        serial.alias("Serial__"),
        et.alias("Script_Status"),
        F.col("value").alias("Copay"),
        F.when(F.col("value") > 25, F.lit("late")).otherwise(F.lit("on time")).alias("CLOSED_STATUS"),
        F.when(F.col("value") > 50, F.lit(REFILL_NDC)).otherwise(F.lit(OTHER_NDC)).cast("bigint").alias("NDC"),
        F.col("event_id").alias("row_order"),
        snapshot.alias("_snapshot_date"),
    )


FILLS_SQL = f"""
fills AS (
  SELECT user_id AS De_identified_Patient_ID,
         event_id % {RX_MODULUS} AS Rx_Number,
         CASE WHEN event_type = 'click' THEN NULL ELSE CAST(ts AS DATE) END AS Dispense_Date,
         CASE WHEN event_type = 'signup' THEN
                CASE WHEN user_id % 2 = 0 THEN 'NI-' || CAST(user_id AS VARCHAR)
                     ELSE 'NI-' || CAST(event_id % 5 AS VARCHAR) END
              WHEN event_type = 'error' THEN '{PLACEHOLDER}'
              WHEN event_type = 'click' THEN NULL
              ELSE 'NM-' || CAST(user_id AS VARCHAR) END AS Serial__,
         event_type AS Script_Status,
         value AS Copay,
         CASE WHEN value > 25 THEN 'late' ELSE 'on time' END AS CLOSED_STATUS,
         CAST(CASE WHEN value > 50 THEN {REFILL_NDC} ELSE {OTHER_NDC} END AS BIGINT) AS NDC,
         event_id AS row_order,
         CAST(DATE '{SNAPSHOT_ORIGIN}' + CAST(floor(datediff('day', DATE '{SNAPSHOT_ORIGIN}', ts) / {SNAPSHOT_DAYS}) * {SNAPSHOT_DAYS} AS INTEGER) AS DATE) AS _snapshot_date
  FROM events
)"""
