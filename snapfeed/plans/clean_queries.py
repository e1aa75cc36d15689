"""Queries for the cleaning expressions, file-name rules and answer decoding.

Noisy text is derived from the driver tables by attribute (part type, order
priority, event type ...), so every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from snapfeed.functions import answers as AN
from snapfeed.functions import clean as C
from snapfeed.functions import names as N
from snapfeed.functions.clean import PY_WHITESPACE_CLASS, PY_WORD_CLASS
from snapfeed.plans.registry import register
from snapfeed.session import read_table

# --- integers -----------------------------------------------------------------

def _part_txt():
    return (F.when(F.col("p_type") == "ECONOMY", F.concat(F.col("p_size").cast("string"), F.lit(".9999999")))
            .when((F.col("p_type") == "SMALL") & (F.col("p_size") % 2 == 0), F.concat(F.lit("0"), F.col("p_size").cast("string"), F.lit("D")))
            .when(F.col("p_type") == "SMALL", F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
            .when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
            .otherwise(F.col("p_brand")))
_PART_TXT_SQL = """CASE WHEN p_type = 'ECONOMY' THEN CAST(p_size AS VARCHAR) || '.9999999'
            WHEN p_type = 'SMALL' AND p_size % 2 = 0 THEN '0' || CAST(p_size AS VARCHAR) || 'D'
            WHEN p_type = 'SMALL' THEN ' ' || CAST(p_size AS VARCHAR) || ' '
            WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END"""


@register("int_or_zero", f"""
WITH t AS (SELECT p_partkey, p_brand, {_PART_TXT_SQL} AS txt FROM part)
SELECT p_partkey, txt,
       coalesce(CAST(trunc(TRY_CAST(txt AS DOUBLE)) AS BIGINT), 0) AS lenient,
       coalesce(CASE WHEN regexp_matches(txt, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim(txt) AS BIGINT) END, -1) AS lenient_text,
       coalesce(TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT), 0) AS brand_num
FROM t""")
def q_int_or_zero(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", _part_txt().alias("txt"))
    return p.select("p_partkey", "txt",
                    C.int_or_default("txt", 0).alias("lenient"),
                    C.int_or_default("txt", -1, decimal_text="default").alias("lenient_text"),
                    C.first_digits("p_brand").alias("brand_num"))


@register("first_digits", """
SELECT p_partkey, coalesce(TRY_CAST(regexp_extract(p_name || ' ' || p_brand, '([0-9]+)', 1) AS BIGINT), 0) AS digits
FROM part""")
def q_first_digits(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", C.first_digits(F.concat_ws(" ", "p_name", "p_brand")).alias("digits"))


@register("num_or_zero", f"""
WITH t AS (SELECT p_partkey, {_PART_TXT_SQL} AS txt FROM part),
d AS (SELECT p_partkey, txt, TRY_CAST(txt AS DOUBLE) AS v FROM t)
SELECT p_partkey, txt, coalesce(TRY_CAST(trunc(CASE WHEN isnan(v) THEN NULL ELSE v END) AS BIGINT), 0) AS num_zero FROM d""")
def q_num_or_zero(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_partkey", _part_txt().alias("txt"))
    return p.select("p_partkey", "txt", C.numeric_or_zero_int("txt").alias("num_zero"))


@register("strict_int", """
WITH t AS (SELECT l_orderkey, l_linenumber, nullif(CAST(l_linenumber AS VARCHAR) || '.0', '1.0') AS txt FROM lineitem)
SELECT l_orderkey, l_linenumber, txt, CAST(trunc(CAST(coalesce(txt, '0') AS DECIMAL(38,6))) AS BIGINT) AS v FROM t""")
def q_strict_int(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    txt = F.nullif(F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")), F.lit("1.0"))
    t = li.select("l_orderkey", "l_linenumber", txt.alias("txt"))
    return t.select("l_orderkey", "l_linenumber", "txt", C.strict_int_null0("txt").alias("v"))


def _cust_code():
    return (F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("n/a-"), F.col("c_nationkey").cast("string")))
            .otherwise(F.lpad(F.col("c_nationkey").cast("string"), 5, "0")))
_CUST_CODE_SQL = """CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a-' || CAST(c_nationkey AS VARCHAR)
            ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END"""


@register("num_or_null", f"""
WITH t AS (SELECT c_custkey, {_CUST_CODE_SQL} AS txt FROM customer),
d AS (SELECT c_custkey, txt, TRY_CAST(txt AS DOUBLE) AS v FROM t)
SELECT c_custkey, txt, CAST(CAST(CASE WHEN isnan(v) THEN NULL ELSE v END AS BIGINT) AS DOUBLE) AS code FROM d""")
def q_num_or_null(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", _cust_code().alias("txt"))
    # Nullable integers are shown as DOUBLE so both engines' row conversions agree.
    return c.select("c_custkey", "txt", C.numeric_or_null_int("txt").cast("double").alias("code"))


@register("fill_label", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, 'N/A') AS segment FROM customer""")
def q_fill_label(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    seg = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return c.select("c_custkey", C.fill_label(seg, "N/A").alias("segment"))


@register("stringify", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END, 'nan') AS nation_text
FROM customer""")
def q_stringify(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    nat = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    return c.select("c_custkey", C.stringify(nat).alias("nation_text"))


# --- money ------------------------------------------------------------------------

@register("money_parse", """
WITH t AS (SELECT c_custkey,
                  CASE WHEN c_acctbal < 0 THEN '($' || format('{:,.2f}', -c_acctbal) || ')'
                       ELSE '$' || format('{:,.2f}', c_acctbal) END AS txt FROM customer),
v AS (SELECT c_custkey, txt, CAST(regexp_replace(txt, '[$(),]', '', 'g') AS DOUBLE) AS amount FROM t)
SELECT c_custkey, txt, amount,
       CASE WHEN regexp_matches(trim(txt), '^\\(.*\\)$') THEN -amount ELSE amount END AS signed_amount
FROM v""")
def q_money_parse(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    bal = F.col("c_acctbal")
    txt = (F.when(bal < 0, F.concat(F.lit("($"), F.format_number(-bal, 2), F.lit(")")))
           .otherwise(F.concat(F.lit("$"), F.format_number(bal, 2))))
    t = c.select("c_custkey", txt.alias("txt"))
    return t.select("c_custkey", "txt", C.money("txt").alias("amount"),
                    C.money("txt", accounting_negatives=True).alias("signed_amount"))


# --- dates ------------------------------------------------------------------------

@register("strict_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS txt,
       CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS day
FROM orders""")
def q_strict_date(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("txt"))
    return t.select("o_orderkey", "txt", C.strict_date("txt", "yyyyMMdd").alias("day"))


@register("date_or_col", """
WITH t AS (SELECT o_orderkey, o_orderdate,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(year(o_orderdate) AS VARCHAR) || '0230'
                       WHEN o_orderpriority = '5-LOW' THEN NULL
                       ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') END AS txt FROM orders)
SELECT o_orderkey, txt, coalesce(try_strptime(txt, '%Y%m%d'), o_orderdate) AS written FROM t""")
def q_date_or_col(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    txt = (F.when(pr == "1-URGENT", F.concat(F.year("o_orderdate").cast("string"), F.lit("0230")))
           .when(pr == "5-LOW", F.lit(None).cast("string"))
           .otherwise(F.date_format(F.date_add("o_orderdate", 1), "yyyyMMdd")))
    t = o.select("o_orderkey", "o_orderdate", txt.alias("txt"))
    return t.select("o_orderkey", "txt", C.timestamp_or_column("txt", "o_orderdate", ("yyyyMMdd",)).alias("written"))


# --- serials -----------------------------------------------------------------------

_DOC_PREFIXES = ("Th", "th")
_WS = PY_WHITESPACE_CLASS


@register("clean_serial", f"""
WITH t AS (SELECT doc_id, regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') AS s FROM documents)
SELECT doc_id, coalesce(nullif(regexp_extract(s, '(Th|th)[{PY_WORD_CLASS}-]+', 0), ''), s) AS serial FROM t""")
def q_clean_serial(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", C.clean_serial("text", _DOC_PREFIXES).alias("serial"))


# --- file names ----------------------------------------------------------------------

FEED_PREFIX = "RX_FEED"
SUMMARY_LABEL = "BENEFIT SUMMARY"
ROUTES = [(FEED_PREFIX, "rx"), (SUMMARY_LABEL, "summary")]


def _landed_names(o):
    pr, d = F.col("o_orderpriority"), F.col("o_orderdate")
    return (F.when(pr == "1-URGENT", F.concat(F.lit("in/rx_feed_"), F.date_format(d, "yyyy-MM-dd"), F.lit(".csv")))
            .when(pr == "2-HIGH", F.concat(F.date_format(d, "yyyyMMdd"), F.lit("- Benefit Summary.xlsx")))
            .when(pr == "3-MEDIUM", F.concat(F.lit("copy of "), F.date_format(d, "yyyyMMdd"),
                                             F.lit("- BENEFIT SUMMARY.xlsx")))
            .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("RX_FEED_"), F.date_format(d, "yyyy"), F.lit("-02-30.csv")))
            .otherwise(F.concat(F.lit("notes_"), F.col("o_orderkey").cast("string"), F.lit(".txt"))))


_NAMES_SQL = """
WITH t AS (SELECT o_orderkey,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN 'in/rx_feed_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv'
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y%m%d') || '- Benefit Summary.xlsx'
    WHEN '3-MEDIUM' THEN 'copy of ' || strftime(o_orderdate, '%Y%m%d') || '- BENEFIT SUMMARY.xlsx'
    WHEN '4-NOT SPECIFIED' THEN 'RX_FEED_' || strftime(o_orderdate, '%Y') || '-02-30.csv'
    ELSE 'notes_' || CAST(o_orderkey AS VARCHAR) || '.txt' END AS name
  FROM orders),
d AS (SELECT o_orderkey, name,
  CAST(try_strptime(nullif(regexp_extract(upper(name), 'RX_FEED_([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''), '%Y-%m-%d') AS DATE) AS feed_date,
  CAST(try_strptime(nullif(regexp_extract(upper(name), '^([0-9]{8})- BENEFIT SUMMARY', 1), ''), '%Y%m%d') AS DATE) AS summary_date
  FROM t)"""


@register("file_name_date", _NAMES_SQL + """
SELECT o_orderkey, name, feed_date, summary_date,
  CASE WHEN regexp_matches(upper(name), 'RX_FEED_[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN feed_date IS NOT NULL
       WHEN contains(upper(name), 'BENEFIT SUMMARY') THEN summary_date IS NOT NULL
       ELSE false END AS accepted,
  CASE WHEN contains(upper(name), 'RX_FEED') THEN 'rx'
       WHEN contains(upper(name), 'BENEFIT SUMMARY') THEN 'summary'
       ELSE 'unrecognised' END AS route
FROM d""")
def q_file_name_date(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", _landed_names(o).alias("name"))
    n = F.col("name")
    return t.select("o_orderkey", "name",
                    N.feed_name_date(n, FEED_PREFIX).alias("feed_date"),
                    N.summary_name_date(n, SUMMARY_LABEL).alias("summary_date"),
                    N.accept_file(n, FEED_PREFIX, SUMMARY_LABEL).alias("accepted"),
                    N.route_by_name(n, ROUTES).alias("route"))


@register("route_by_name", """
SELECT page_id, CASE WHEN contains(upper(url), '/EN/') THEN 'rx'
                     WHEN contains(upper(url), '/DE/') THEN 'summary'
                     ELSE 'unrecognised' END AS route
FROM pages""")
def q_route_by_name(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", N.route_by_name("url", [("/EN/", "rx"), ("/DE/", "summary")]).alias("route"))


@register("new_files_anti", """
WITH files AS (SELECT page_id, string_split(url, '/')[-1] AS name FROM pages WHERE url LIKE 'https://%'),
ledger AS (SELECT string_split(url, '/')[-1] AS name FROM pages WHERE url LIKE 'http://%')
SELECT page_id, name FROM files f WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.name = f.name)""")
def q_new_files_anti(spark, sf_dir):
    from snapfeed.sources.files import new_files
    p = read_table(spark, sf_dir, "pages")
    files = p.where(F.col("url").startswith("https://")).select("page_id", N.base_name("url").alias("name"))
    ledger = p.where(F.col("url").startswith("http://")).select(F.col("url").alias("name"))
    return new_files(files, ledger)


@register("dated_name", """
SELECT o_orderkey, 'export_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS name FROM orders""")
def q_dated_name(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", N.dated_name("export_", "o_orderdate").alias("name"))


# --- questionnaire answers ---------------------------------------------------------

def _answer_text():
    et = F.col("event_type")
    return (F.when(et == "error", F.concat(F.lit("x"), F.col("event_id").cast("string")))
            .when((et == "purchase") & (F.col("value") < 10), F.lit("00"))
            .when((et == "purchase") & (F.col("value") < 20), F.lit("0"))
            .when((et == "purchase") & (F.col("value") < 40), F.concat(F.lit("5"), F.lit("\n")))
            .when(et == "view", F.concat(F.col("event_id").cast("string"), F.lit("000000000000000000001")))
            .otherwise((F.col("event_id") * F.lit(9876543210) + F.lit(12345)).cast("string")))
_ANSWER_SQL = """CASE WHEN event_type = 'error' THEN 'x' || CAST(event_id AS VARCHAR)
     WHEN event_type = 'purchase' AND value < 10 THEN '00'
     WHEN event_type = 'purchase' AND value < 20 THEN '0'
     WHEN event_type = 'purchase' AND value < 40 THEN '5' || chr(10)
     WHEN event_type = 'view' THEN CAST(event_id AS VARCHAR) || '000000000000000000001'
     ELSE CAST(event_id * 9876543210 + 12345 AS VARCHAR) END"""
_WORDS_SQL = """CASE WHEN regexp_full_match(answer, '[0-9]+')
     THEN CAST(CAST(right(answer, 32) AS HUGEINT) % 4294967296 AS BIGINT) END"""


def _answers(spark, sf_dir, base: int, span: int):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", _answer_text().alias("answer"),
                    (F.lit(base) + F.col("event_id") % span).cast("int").alias("question_id"))


def _answers_sql(base: int, span: int) -> str:
    return f"""WITH a AS (SELECT event_id, {_ANSWER_SQL} AS answer,
                  CAST({base} + event_id % {span} AS INTEGER) AS question_id FROM events),
w AS (SELECT *, {_WORDS_SQL} AS n32 FROM a),
b AS (SELECT *, n32 & 65535 AS low, (n32 >> 16) & 65535 AS high FROM w)"""


def _bits_sql(bits: int, flagged: bool = False) -> str:
    terms = []
    for i in range(bits):
        n = 1 << i
        label = f"CASE WHEN (high & {n}) <> 0 THEN '{n}h' ELSE '{n}' END" if flagged else f"'{n}'"
        terms.append(f"CASE WHEN (low & {n}) <> 0 THEN {label} END")
    return "concat_ws(', ', " + ", ".join(terms) + ")"


def _decodable_sql(questions) -> str:
    qs = ", ".join(str(q) for q in questions)
    return f"regexp_full_match(answer, '[0-9]+') AND answer <> '0' AND question_id IN ({qs})"


@register("split_hex", _answers_sql(10, 5) + """
SELECT event_id, answer, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high FROM b""")
def q_split_hex(spark, sf_dir):
    a = _answers(spark, sf_dir, 10, 5)
    low, high = AN.split_words("answer")
    return a.select("event_id", "answer", low.cast("double").alias("low"), high.cast("double").alias("high"))


@register("decode_baseline", _answers_sql(10, 5) + f"""
SELECT event_id, question_id, answer,
       CASE WHEN {_decodable_sql(AN.BASELINE_QUESTIONS)} THEN {_bits_sql(AN.BASELINE_BITS)}
            ELSE answer END AS decoded
FROM b""")
def q_decode_baseline(spark, sf_dir):
    a = AN.with_words(_answers(spark, sf_dir, 10, 5), "answer")
    return a.select("event_id", "question_id", "answer",
                    AN.decode_baseline("answer", "question_id", words=("_low", "_high")).alias("decoded"))


@register("decode_daily", _answers_sql(56, 8) + f"""
SELECT event_id, question_id, answer,
       CASE WHEN {_decodable_sql(AN.DAILY_PLAIN_QUESTIONS)} THEN {_bits_sql(AN.DAILY_PLAIN_BITS)}
            WHEN {_decodable_sql(AN.DAILY_FLAGGED_QUESTIONS)} THEN {_bits_sql(AN.DAILY_FLAGGED_BITS, True)}
            ELSE answer END AS decoded
FROM b""")
def q_decode_daily(spark, sf_dir):
    a = AN.with_words(_answers(spark, sf_dir, 56, 8), "answer")
    return a.select("event_id", "question_id", "answer",
                    AN.decode_daily("answer", "question_id", words=("_low", "_high")).alias("decoded"))
