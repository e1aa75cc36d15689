"""The two feed cleaners: prescription fills (positional columns) and the
benefit-investigation summary (named columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.functions import clean as C
from snapfeed.functions.names import normalize_headers
from snapfeed.operators.dates import parse_dates
from snapfeed.operators.schema import rename_map, select_schema
from snapfeed.operators.snapshot import SNAPSHOT_COL, stamp_snapshot
from snapfeed.operators.windows import refill_numbering
from snapfeed.session import materialise, spread

# Column names of the cleaned prescription table, in feed order
# (the last two are added by the cleaner).
RX_COLUMNS = [
    "De_identified_Patient_ID", "Rx_Number", "Received_Date", "Dispense_Date", "Serial__", "Total_Fills",
    "Fills_Dispensed", "Fill_Remaining", "Provider_Last_Name", "Provider_First_Name", "Provider_Address",
    "Provider_City", "Provider_State__", "Provider_Zip_Code", "Provider_NPI", "Region", "Script_Status", "Patient_OOP",
    "Payor_Name", "Plan_Name", "Copay", "Source", "Fill_Type_Recieved", "Fill_Type_Shipped", "Date_Written",
    "CLOSED_STATUS", "Insurance_Type", "PA_STATUS", "Order_PA_Status", "REMINDERSTATUS_PAT", "Plan_Name_Claim", "AGE",
    "NDC", "USAGE", "modified_serial_id", "_snapshot_date",
]
RX_FEED_COLUMNS = RX_COLUMNS[:-2]

# Column names of the cleaned benefit summary, and the three
# renamed headers.
SUMMARY_COLUMNS = [
    "PATID", "RX_NUM", "DATE_ENTERED", "WE_DATE_ENTERED_MED_BI", "STATUS_ID", "SUBCATEGORY_MED_BI",
    "MEDBISTATUS", "INS_PLN", "MEDICAL_PLN_NAME", "RX_REJ_CODE", "RX_BIN", "RX_PCN", "RX_PBM", "DR_NPI",
    "DR_NAME", "DR_ADD", "DR_ST", "DR_ZIP", "DATE_PA_FAXED_MED_BI", "PRECERTIFICATION", "DATE_CLM_SUBMT_MED_BI",
    "MED_BILLING_STATUS", "SCA__APPROVED_DATE", "SCA_STATUS_MED_BI", "MIDAS_CODE_BI", "SUPPORT_DOCS_MD_MED_BI",
    "ICD_10_MED_BI", "TRIED_FAILED_BI", "SERIAL_NUMBER", "ACUTE_PREVENTION", "DATEWRITTEN", "DATE_RESP_LTR_RECD_BI",
    "DATE_CLINCL_DOC_REQ", "APPL_STATUS_MED_BI", "DATE_APPL_FAXED_HCP_MED_BI", "DATE_APPL_FAXED_INS_MED_BI",
    "DATE_APPL_DENIED_MED_BI", "CLAIM_REJECT", "MED_CLAIM_PAYMENT", "MED_APPLIED_DEDUCTIBLE", "MED_PAT_COPAY_CO_INS",
]
SUMMARY_RENAMES = {"CLAIM_PAYMENT": "MED_CLAIM_PAYMENT", "APPLIED_DEDUCTIBLE": "MED_APPLIED_DEDUCTIBLE",
                   "PAT_COPAY_COINS": "MED_PAT_COPAY_CO_INS"}
SUMMARY_STRINGIFIED = ["SUPPORT_DOCS_MD_MED_BI", "TRIED_FAILED_BI", "DATE_APPL_FAXED_HCP_MED_BI",
                       "DATE_APPL_FAXED_INS_MED_BI", "DATE_APPL_DENIED_MED_BI"]
RX_DATE_COLUMNS = ["Received_Date", "Dispense_Date", "Date_Written"]
# Date texts that the feeds use: year first or US order, with or without a time.
RX_DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "yyyy-M-d H:m:s", "M/d/yyyy H:m", "M/d/yyyy H:m:s")
SUMMARY_TIMESTAMP_FORMATS = ("yyyy-M-d H:m:s", "yyyy-M-d", "M/d/yyyy H:m:s", "M/d/yyyy H:m", "M/d/yyyy")
NO_CLAIM_LABEL = "no data"
NO_REGION_LABEL = "N/A"


def clean_rx(raw: DataFrame, snapshot_day, *, ndc_value, placeholder: str,
             order_col: str, prefix: str = "NI", date_formats: tuple[str, ...] = RX_DATE_FORMATS,
             group_extra: list[str] = (), bucket_col: str | None = None,
             carry: list[str] = (), partitions: int | None = None) -> DataFrame:
    """Clean a prescription feed read as text.

    ``raw`` holds the 34 feed columns first (named by position) and then the
    ``carry`` columns (row order, source file ...), which pass through. AGE and
    NDC stay as read; the refill rule compares NDC as a number. The cleaned rows
    are written once to the shared scratch folder, so the raw feed is read and
    cleaned once although refill numbering reads its rows twice. ``partitions``
    spreads an input of few splits over that many tasks. A date column has one
    format per file (``group_extra``), elected from all its values.
    """
    carry = list(carry)
    n = len(RX_FEED_COLUMNS)
    if len(raw.columns) != n + len(carry):
        raise ValueError(f"expected {n} feed columns plus {carry}, got {len(raw.columns)} columns")
    df = raw.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(raw.columns[:n], RX_FEED_COLUMNS)], *carry)
    df = parse_dates(spread(df, partitions), RX_DATE_COLUMNS, date_formats, list(group_extra))
    df = df.withColumns({
        "__ndc": C.number_text("NDC").try_cast("double"),
        "Provider_NPI": C.first_digits("Provider_NPI"),
        "Total_Fills": C.int_or_default("Total_Fills", 0),
        "Fills_Dispensed": C.int_or_default("Fills_Dispensed", 0),
        "Fill_Remaining": C.strict_int_null0("Fill_Remaining"),
        "Rx_Number": C.strict_int_null0("Rx_Number"),
        "Provider_Zip_Code": C.numeric_or_zero_int("Provider_Zip_Code"),
        "Patient_OOP": C.money("Patient_OOP"),
        "Copay": C.money("Copay"),
        "Region": C.fill_label("Region", NO_REGION_LABEL),
        "Serial__": C.clean_serial("Serial__"),
    })
    df = materialise(df, "cleaned")
    df = refill_numbering(df, "De_identified_Patient_ID", "Serial__", "Dispense_Date", "__ndc", order_col,
                          ndc_value=float(ndc_value), placeholder=placeholder, prefix=prefix,
                          group_extra=list(group_extra), bucket_col=bucket_col)
    df = stamp_snapshot(df, snapshot_day, SNAPSHOT_COL)
    return df.select(*RX_COLUMNS, *carry)


def clean_summary(raw: DataFrame, snapshot_day,
                  ts_fmts: tuple[str, ...] = SUMMARY_TIMESTAMP_FORMATS,
                  fallback_fmts: tuple[str, ...] = SUMMARY_TIMESTAMP_FORMATS,
                  partitions: int | None = None,
                  carry: list[str] = ()) -> DataFrame:
    """Clean a benefit summary read as text with its original headers;
    ``carry`` columns (e.g. the source file) pass through unchanged, and DATE_ENTERED
    has one format for each of their values."""
    df = rename_map(normalize_headers(raw), SUMMARY_RENAMES)
    df = spread(select_schema(df, SUMMARY_COLUMNS + list(carry)), partitions)
    df = parse_dates(df, ["DATE_ENTERED"], ts_fmts, list(carry), "timestamp")
    entered = F.col("DATE_ENTERED")
    cols = {c: C.stringify(c) for c in SUMMARY_STRINGIFIED}
    cols.update({
        "MED_CLAIM_PAYMENT": C.fill_label("MED_CLAIM_PAYMENT", NO_CLAIM_LABEL),
        "RX_NUM": C.numeric_or_zero_int("RX_NUM"),
        "DATEWRITTEN": C.timestamp_or_column("DATEWRITTEN", entered, fallback_fmts),
        "WE_DATE_ENTERED_MED_BI": C.timestamp_or_column("WE_DATE_ENTERED_MED_BI", entered, fallback_fmts),
        "MIDAS_CODE_BI": C.strict_int_null0("MIDAS_CODE_BI"),
        "PATID": C.strict_int_null0("PATID"),
        "DR_ZIP": C.numeric_or_null_int("DR_ZIP"),
    })
    return stamp_snapshot(df.withColumns(cols), snapshot_day, SNAPSHOT_COL)
