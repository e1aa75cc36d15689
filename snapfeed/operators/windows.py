"""Duplicate counting, keep-latest dedup, numbering within groups, refill numbering.

Every operator here is written so that one hot key (a third of all rows) never
lands whole in one task:

* counts and keep-latest use aggregation with a map-side partial step, so each
  map task reduces its share of a hot key to one row before the shuffle;
* numbering within a group splits each group into order-range buckets, numbers
  inside each bucket and adds a per-bucket offset computed on the (tiny) table
  of bucket sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.functions.clean import py_strip

# Rows per numbering bucket: 2**20. Bounds the rows one task numbers in a hot group.
BUCKET_BITS = 20

_NEGATABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
              T.DoubleType, T.DecimalType)


def parse_order(order: list) -> list[tuple[str, bool]]:
    """``['d desc', 'x']`` or ``[('d', True)]`` -> ``[(name, descending)]``."""
    out = []
    for o in order:
        if isinstance(o, tuple):
            out.append((o[0], bool(o[1])))
            continue
        parts = o.split()
        desc = len(parts) > 1 and parts[1].lower() == "desc"
        out.append((parts[0], desc))
    return out


def _order_columns(order: list[tuple[str, bool]]) -> list[Column]:
    # Spark defaults: ASC NULLS FIRST, DESC NULLS LAST.
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in order]


def _negated(col: Column, t: T.DataType) -> Column | None:
    if isinstance(t, _NEGATABLE):
        return -col
    if isinstance(t, T.DateType):
        return -F.unix_date(col)
    if isinstance(t, T.TimestampType):
        return -F.unix_micros(col)
    if isinstance(t, T.BooleanType):
        return -col.cast("int")
    return None


def inverted_text(col: Column) -> Column:
    """A text that sorts in the opposite order of ``col`` (text or binary): its bytes'
    hex digits inverted, with an end mark above all digits, so that a text sorts
    after those it begins."""
    return F.concat(F.translate(F.hex(col), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def _extreme_key(df: DataFrame, order: list[tuple[str, bool]]) -> tuple[Column, str] | None:
    """A struct whose maximum (or minimum) is the first row of ``order``, and
    which extreme to take; None when a type has no opposite order.

    Spark orders NULL lowest inside structs. Max form: a DESC part is the column
    itself (NULL loses: NULLS LAST); an ASC part is (is NULL, negated value)
    (NULL wins: NULLS FIRST). Min form: an ASC part is the column itself (NULL
    wins: NULLS FIRST); a DESC part is (is NULL, negated value) (NULL loses:
    NULLS LAST). So text that is ordered in one direction goes as it is; ordered
    both ways, its opposite order is ``inverted_text``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    for invert in (False, True):
        for extreme, plain_when_desc in (("max", True), ("min", False)):
            parts = []
            for i, (c, desc) in enumerate(order):
                col = F.col(c)
                if desc == plain_when_desc:
                    parts.append(col.alias(f"k{i}"))
                    continue
                neg = _negated(col, types[c])
                if neg is None and invert and isinstance(types[c], (T.StringType, T.BinaryType)):
                    neg = inverted_text(col)
                if neg is None:
                    break
                # (is NULL, negated): in the max form NULL wins (ASC NULLS FIRST),
                # in the min form NULL loses (DESC NULLS LAST).
                parts.append(col.isNull().alias(f"n{i}"))
                parts.append(neg.alias(f"k{i}"))
            else:
                return F.struct(*parts), extreme
    return None


def _renamed_keys(keys: list[str], tag: str) -> list:
    return [F.col(k).alias(f"__{tag}{i}") for i, k in enumerate(keys)]


def _on_renamed(keys: list[str], tag: str) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__{tag}{i}")) for i, k in enumerate(keys)])


def add_dup_count(df: DataFrame, keys: list[str], name: str = "dup_count") -> DataFrame:
    """Attach ``count(*) over (partition by keys)`` to every row.

    Computed as a partially aggregated count joined back on the keys, so a hot
    key is pre-reduced map-side and AQE can split its join partition.
    """
    counts = df.groupBy(*_renamed_keys(keys, "d")).agg(F.count(F.lit(1)).alias(name))
    joined = df.join(counts, _on_renamed(keys, "d"), "left")
    return joined.select(*df.columns, name)


def dedup_latest(df: DataFrame, keys: list[str], order: list, count_col: str | None = None,
                 method: str = "aggregate") -> DataFrame:
    """Keep the first row per key under ``order`` (``row_number() = 1``).

    ``count_col`` also returns how many rows the key had. ``order`` must break
    all ties for a deterministic winner.

    ``method='aggregate'`` runs one partially aggregated ``max_by`` per key
    (safe for a hot key). ``'window'`` runs ``row_number``: faster on even
    data, and Spark adds a map-side group limit when no count is asked for,
    but with a count a hot key's whole group is sorted in one task; it is never
    chosen silently.
    """
    parsed = parse_order(order)
    found = _extreme_key(df, parsed) if method == "aggregate" else None
    if method == "aggregate" and found is None:
        raise ValueError("a column of the order has no opposite order in an aggregate; choose method='window'")
    if found is not None:
        key, extreme = found
        rest = [c for c in df.columns if c not in keys]
        row = F.struct(*[F.col(c) for c in rest])
        pick = F.max_by if extreme == "max" else F.min_by
        aggs = [pick(row, key).alias("__row")]
        if count_col:
            aggs.append(F.count(F.lit(1)).alias(count_col))
        # Grouping on the key columns themselves keeps the result hash-partitioned
        # on them (a later join on the keys needs no new shuffle) and keeps
        # their nullability.
        best = df.groupBy(*keys).agg(*aggs)
        out = [F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns]
        if count_col:
            out.append(F.col(count_col))
        return best.select(*out)
    w = Window.partitionBy(*keys).orderBy(*_order_columns(parsed))
    ranked = df.withColumn("__rn", F.row_number().over(w))
    if count_col:
        ranked = ranked.withColumn(count_col, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def _bucket(order_col: str, bucket_bits: int, bucket_col: str | None) -> Column:
    return F.col(bucket_col) if bucket_col else F.shiftright(F.col(order_col), bucket_bits)


def _bucket_offsets(per_bucket: DataFrame, group: list[str], count_col: str) -> DataFrame:
    """Per (group, bucket): the sum of ``count_col`` over all earlier buckets of
    the group. Works on the small per-bucket table only."""
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.withColumn("__off", F.coalesce(F.sum(count_col).over(before), F.lit(0)))


def number_within_group(df: DataFrame, group: list[str], order_col: str, out: str = "seq",
                        bucket_bits: int = BUCKET_BITS, bucket_col: str | None = None) -> DataFrame:
    """``row_number() over (partition by group order by bucket, order_col)``
    (1-based), computed bucket by bucket so no task numbers a whole hot group.

    Buckets are ``order_col >> bucket_bits`` for an integral order, or an
    explicit ``bucket_col`` (for CSV input: the split start, so the order
    within a split is the scan order). One shuffle of the rows on
    (group, bucket); the offsets come from a table with one row per bucket.
    """
    parts = group + ["__b"]
    local = (df.withColumn("__b", _bucket(order_col, bucket_bits, bucket_col))
             .withColumn("__local", F.row_number().over(Window.partitionBy(*parts).orderBy(F.col(order_col)))))
    sizes = local.groupBy(*parts).agg(F.max("__local").alias("__n"))
    offsets = _bucket_offsets(sizes, group, "__n").drop("__n")
    joined = local.join(offsets, parts, "left")
    return joined.select(*df.columns, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local"))
                         .cast("bigint").alias(out))


def refill_numbering(df: DataFrame, patient: str, serial: str, dispensed: str, ndc: str,
                     order_col: str, ndc_value, placeholder: str, prefix: str = "NI",
                     out: str = "modified_serial_id", group_extra: list[str] = (),
                     bucket_col: str | None = None, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Number refills of a patient's single original serial.

    Per non-NULL patient: if exactly one distinct serial starts with ``prefix``,
    rows that are dispensed, of NDC ``ndc_value`` and have a blank serial or one
    containing ``placeholder`` get ``<serial>refill<i>``, ``i = 1..`` in
    ``order_col`` order. Every other row keeps its serial in ``out``.
    ``group_extra`` (e.g. the source file) narrows the group further.

    Plan: one shuffle on (patient, order bucket); inside each bucket a running
    count of candidates and the bucket's smallest / largest original serial;
    a per-bucket table (tiny) gives the patient's originals and the count of
    candidates in earlier buckets; it is joined back on (patient, bucket).
    """
    group = [patient] + list(group_extra)
    parts = group + ["__b"]
    s = F.col(serial)
    stripped = F.coalesce(py_strip(s), F.lit(""))
    candidate = F.coalesce(F.col(dispensed).isNotNull() & (F.col(ndc) == F.lit(ndc_value))
                           & ((stripped == F.lit("")) | stripped.contains(placeholder)), F.lit(False))
    original = F.when(F.coalesce(s, F.lit("")).startswith(prefix), s)
    cols = [c for c in df.columns if c != out]
    running = Window.partitionBy(*parts).orderBy(F.col(order_col)).rowsBetween(Window.unboundedPreceding, 0)
    x = (df.select(*cols, _bucket(order_col, bucket_bits, bucket_col).alias("__b"),
                   candidate.cast("int").alias("__cand"), original.alias("__orig"))
         .withColumn("__run", F.sum("__cand").over(running)))
    per_bucket = x.groupBy(*parts).agg(F.min("__orig").alias("__lo_b"), F.max("__orig").alias("__hi_b"),
                                       F.sum("__cand").alias("__n_b"))
    whole = Window.partitionBy(*group)
    facts = (_bucket_offsets(per_bucket, group, "__n_b")
             .select(*parts, "__off", F.min("__lo_b").over(whole).alias("__lo"),
                     F.max("__hi_b").over(whole).alias("__hi")))
    j = x.join(facts, parts, "left")
    refill = (F.col(patient).isNotNull() & (F.col("__cand") == 1) & F.col("__lo").isNotNull()
              & (F.col("__lo") == F.col("__hi")))
    number = (F.col("__off") + F.col("__run")).cast("string")
    value = F.when(refill, F.concat(F.col("__lo"), F.lit("refill"), number)).otherwise(s)
    return j.select(*cols, value.alias(out))
