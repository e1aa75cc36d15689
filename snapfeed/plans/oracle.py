"""DuckDB twins of the registered queries, written independently of the Spark
code from the operator definitions. Used by the driver's correctness check and
by ``scripts/check_oracle.py``."""

from __future__ import annotations

from snapfeed.plans import adapters as A
from snapfeed.plans.registry import ORACLE

FILL_COLS = ["De_identified_Patient_ID", "Rx_Number", "Dispense_Date", "Serial__", "Script_Status",
             "Copay", "CLOSED_STATUS", "NDC", "row_order", "_snapshot_date"]
RX_COLS = FILL_COLS + ["substatus", "by_copay", "Serial_coalesce", "Dispense_Date_coalesce", "dup_count"]
RX_KEYS = ["De_identified_Patient_ID", "Rx_Number", "Serial_coalesce", "Dispense_Date_coalesce"]
STATUSES = ", ".join(f"'{s}'" for s in A.RX_STATUSES)
WITH_FILLS = "WITH " + A.FILLS_SQL


def _prefer_source(cols, s="s", t="t", flag="__s"):
    return ",\n  ".join(f"CASE WHEN {s}.{flag} THEN {s}.{c} ELSE {t}.{c} END AS {c}" for c in cols)


ORACLE["latest_snapshot"] = WITH_FILLS + """
SELECT * FROM fills WHERE _snapshot_date = (SELECT max(_snapshot_date) FROM fills)"""

ORACLE["distinct_rows"] = WITH_FILLS + """
SELECT DISTINCT De_identified_Patient_ID, Rx_Number, Serial__, Script_Status, _snapshot_date FROM fills"""

ORACLE["derived_cols"] = WITH_FILLS + f"""
SELECT row_order, CLOSED_STATUS AS substatus, {A.BASE_AMOUNT} - Copay AS by_copay,
       coalesce(Serial__, 'Unknown') AS Serial_coalesce,
       coalesce(Dispense_Date, DATE '1000-01-01') AS Dispense_Date_coalesce
FROM fills"""

ORACLE["in_list"] = WITH_FILLS + f"""
SELECT row_order, Script_Status FROM fills WHERE Script_Status IN ({STATUSES})"""

ORACLE["key_exclusion"] = WITH_FILLS + """
SELECT row_order, De_identified_Patient_ID, Rx_Number, Serial__ FROM fills
WHERE De_identified_Patient_ID IS NOT NULL AND Rx_Number IS NOT NULL AND Serial__ IS NOT NULL
  AND (De_identified_Patient_ID, Rx_Number, Serial__) NOT IN ((0, 12, 'NI-0'), (1, 37, 'NM-1'), (1, 38, 'NM-1'))"""

ORACLE["dup_count"] = """
SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count FROM lineitem"""

ORACLE["dedup_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS FIRST,
                                     l_suppkey ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLE["refill_number"] = WITH_FILLS + f""",
stats AS (
  SELECT De_identified_Patient_ID AS pid,
         min(CASE WHEN starts_with(coalesce(Serial__, ''), 'NI') THEN Serial__ END) AS lo,
         max(CASE WHEN starts_with(coalesce(Serial__, ''), 'NI') THEN Serial__ END) AS hi
  FROM fills WHERE De_identified_Patient_ID IS NOT NULL GROUP BY 1),
base AS (
  SELECT f.*, s.lo,
         coalesce(f.Dispense_Date IS NOT NULL AND f.NDC = {A.REFILL_NDC}
                  AND (coalesce(trim(f.Serial__), '') = '' OR contains(coalesce(trim(f.Serial__), ''), '{A.PLACEHOLDER}'))
                  AND s.lo IS NOT NULL AND s.lo = s.hi, false) AS refill
  FROM fills f LEFT JOIN stats s ON f.De_identified_Patient_ID = s.pid)
SELECT row_order, De_identified_Patient_ID, Serial__,
       CASE WHEN refill THEN lo || 'refill' || CAST(row_number() OVER (PARTITION BY De_identified_Patient_ID, refill ORDER BY row_order) AS VARCHAR)
            ELSE Serial__ END AS modified_serial_id
FROM base"""

_ORDER_COLS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "n_orders"]


def _last_orders_sql(cond: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
           count(*) OVER (PARTITION BY o_custkey) AS n_orders,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
    FROM orders WHERE {cond}) WHERE rn = 1"""


ORACLE["merge_upsert"] = f"""
WITH old AS ({_last_orders_sql(f"o_orderdate < TIMESTAMP '{A.ORDER_SPLIT_DAY}'")}),
new AS ({_last_orders_sql(f"o_orderdate >= TIMESTAMP '{A.ORDER_SPLIT_DAY}'")})
SELECT {_prefer_source(_ORDER_COLS)},
  CASE WHEN t.__t IS NULL THEN 'insert' WHEN s.__s THEN 'update' ELSE 'keep' END AS _merge_action
FROM (SELECT *, true AS __t FROM old) t FULL JOIN (SELECT *, true AS __s FROM new) s ON t.o_custkey = s.o_custkey"""

_SAME = [c for c in FILL_COLS if c != "row_order"]
_EXCLUDED = " OR ".join(f"""(De_identified_Patient_ID = {k[0]} AND Rx_Number = {k[1]} AND coalesce(Serial__, 'Unknown') = '{k[2]}'
             AND coalesce(Dispense_Date, DATE '1000-01-01') = DATE '{k[3].isoformat()}')""" for k in A.EXCLUDED_KEYS)
_RX_PREP = f"""
prep AS (
  SELECT *, CLOSED_STATUS AS substatus, {A.BASE_AMOUNT} - Copay AS by_copay,
         coalesce(Serial__, 'Unknown') AS Serial_coalesce,
         coalesce(Dispense_Date, DATE '1000-01-01') AS Dispense_Date_coalesce
  FROM (SELECT {", ".join(_SAME)}, min(row_order) AS row_order FROM fills GROUP BY ALL)
  WHERE De_identified_Patient_ID IS NOT NULL AND Rx_Number IS NOT NULL
    AND NOT ({_EXCLUDED})
    AND Script_Status IN ({STATUSES}) {{cond}})"""


def _rx_ranked(name: str, cond: str) -> str:
    keys = ", ".join(RX_KEYS)
    return _RX_PREP.replace("prep AS", f"{name}_prep AS").format(cond=cond) + f""",
{name} AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY {keys}) AS dup_count,
         row_number() OVER (PARTITION BY {keys} ORDER BY Dispense_Date DESC NULLS LAST, row_order ASC NULLS FIRST) AS rn
  FROM {name}_prep) WHERE rn = 1)"""


ORACLE["rx_upsert"] = WITH_FILLS + """,
mx AS (SELECT max(_snapshot_date) AS m FROM fills),""" + _rx_ranked(
    "tgt", "AND _snapshot_date < (SELECT m FROM mx)") + "," + _rx_ranked(
    "src", "AND _snapshot_date = (SELECT m FROM mx)") + f"""
SELECT {_prefer_source(RX_COLS)}
FROM (SELECT *, true AS __t FROM tgt) t FULL JOIN (SELECT *, true AS __s FROM src) s
  ON {" AND ".join(f"t.{k} = s.{k}" for k in RX_KEYS)}"""


ORACLE["merge_counts"] = f"""
WITH old AS ({_last_orders_sql(f"o_orderdate < TIMESTAMP '{A.ORDER_SPLIT_DAY}'")}),
new AS ({_last_orders_sql(f"o_orderdate >= TIMESTAMP '{A.ORDER_SPLIT_DAY}'")})
SELECT CASE WHEN t.__t IS NULL THEN 'insert' WHEN s.__s THEN 'update' ELSE 'keep' END AS _merge_action,
       count(*) AS n_rows
FROM (SELECT *, true AS __t FROM old) t FULL JOIN (SELECT *, true AS __s FROM new) s ON t.o_custkey = s.o_custkey
GROUP BY 1"""

ORACLE["dedup_latest_window"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS FIRST,
                                        l_suppkey ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLE["seq_within_group"] = """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events"""

ORACLE["rx_exact_duplicates"] = WITH_FILLS.replace("fills AS (", "single AS (", 1) + f""",
fills AS (SELECT * FROM single UNION ALL
          SELECT * EXCLUDE (k) REPLACE (row_order + k * {A.COPY_OFFSET} AS row_order) FROM single, (VALUES (1), (2)) n(k) WHERE Script_Status = 'error'),
mx AS (SELECT max(_snapshot_date) AS m FROM fills),""" + _rx_ranked("src", "AND _snapshot_date = (SELECT m FROM mx)") + """
SELECT * FROM src"""

_KEYS = ", ".join(RX_KEYS)
ORACLE["rx_batch_source"] = WITH_FILLS + "," + _RX_PREP.replace("prep AS", "all_prep AS").format(cond="") + f""",
per_day AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY {_KEYS}, _snapshot_date) AS dup_count,
         row_number() OVER (PARTITION BY {_KEYS}, _snapshot_date
                            ORDER BY Dispense_Date DESC NULLS LAST, row_order ASC NULLS FIRST) AS rn
  FROM all_prep) WHERE rn = 1)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY _snapshot_date DESC NULLS LAST) AS rn FROM per_day)
WHERE rn = 1"""
