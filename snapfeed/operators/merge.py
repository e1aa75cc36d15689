"""Keyed upsert (MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT) as a
DataFrame plan.

The result is the new content of the target: matched rows take the source's
update columns, unmatched source rows are inserted, target-only rows are kept.
One full outer join on the keys: each side is shuffled at most once, and not
at all when it is already partitioned on the keys (e.g. a deduplicated source).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACTION_COL = "_merge_action"


def _any_null(cols: list[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def check_unique_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source with a check in its plan: the job fails when one key has several
    rows (a MERGE may not update a target row twice). One partially aggregated
    grouping on the keys, whose partitioning the merge join reuses; rows with a
    NULL key part can never match and are not grouped."""
    rest = [c for c in source.columns if c not in keys]
    row = F.struct(*rest) if rest else F.lit(True)
    grouped = source.where(~_any_null(keys)).groupBy(*keys).agg(F.first(row).alias("__row"), F.count(F.lit(1)).alias("__n"))
    key_text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    grouped = grouped.where(F.when(F.col("__n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("MERGE source has several rows for key "), key_text)).cast("boolean")))
    checked = grouped.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in source.columns])
    if any(source.schema[k].nullable for k in keys):
        checked = checked.unionByName(source.where(_any_null(keys)))
    return checked


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None, insert_cols: list[str] | None = None,
                 with_action: bool = False, validate_source: bool = True,
                 salt_null_keys: bool | None = None, newer_by: str | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` on equal, non-NULL ``keys``.

    ``update_cols`` default: every non-key target column the source has.
    ``insert_cols`` default: every target column the source has (others NULL).
    ``with_action`` adds ``_merge_action`` in (update, insert, keep).
    ``newer_by`` names a column by which a target row that is newer than its
    source row is kept.

    One full outer join. When a key column is nullable, rows with a NULL key
    part (which can never match) get a content-hash salt as an extra join key,
    so they spread over all partitions instead of meeting in one; matchable
    rows have salt 0 on both sides. ``salt_null_keys=None`` decides from the
    schemas' nullability; pass False when the caller has filtered NULL keys
    out (the join then reuses an existing partitioning on the keys).
    """
    t_cols = target.columns
    s_set = set(source.columns)
    missing = [k for k in keys if k not in s_set or k not in t_cols]
    if missing:
        raise KeyError(f"merge keys missing: {missing}")
    if update_cols is None:
        update_cols = [c for c in t_cols if c in s_set and c not in keys]
    if insert_cols is None:
        insert_cols = [c for c in t_cols if c in s_set]
    if validate_source:
        source = check_unique_source(source, keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    used = [c for c in t_cols if c in set(update_cols) | set(insert_cols) | set(keys) | {newer_by}]
    nullable = (any(target.schema[k].nullable or source.schema[k].nullable for k in keys)
                if salt_null_keys is None else salt_null_keys)

    def salt(key_cols: list[str], row_cols: list[str]):
        return (F.when(_any_null(key_cols), F.xxhash64(*[F.col(c) for c in row_cols]))
                .otherwise(F.lit(0).cast("bigint")))

    t = target.withColumn("__t", F.lit(True))
    s = source.select(*[F.col(c).cast(types[c]).alias(f"__s_{c}") for c in used], F.lit(True).alias("__s"))
    cond = [t[k] == s[f"__s_{k}"] for k in keys]
    if nullable:
        t = t.withColumn("__salt_t", salt(keys, t_cols))
        s = s.withColumn("__salt_s", salt([f"__s_{k}" for k in keys], [f"__s_{c}" for c in used]))
        cond = [t[k] == s[f"__s_{k}"] for k in keys] + [t["__salt_t"] == s["__salt_s"]]
    j = t.join(s, reduce(lambda a, b: a & b, cond), "full")

    is_insert = F.col("__t").isNull()
    is_update = F.col("__t").isNotNull() & F.col("__s").isNotNull()
    if newer_by:
        is_update &= F.coalesce(F.col(newer_by) <= F.col(f"__s_{newer_by}"), F.lit(True))
    out = []
    for c in t_cols:
        tv = F.col(c)
        if c in keys:
            v = F.when(is_insert, F.col(f"__s_{c}")).otherwise(tv)
        else:
            ins = F.col(f"__s_{c}") if c in insert_cols else F.lit(None).cast(types[c])
            v = F.when(is_insert, ins)
            v = v.when(is_update, F.col(f"__s_{c}")) if c in update_cols else v
            v = v.otherwise(tv)
        out.append(v.alias(c))
    if with_action:
        out.append(F.when(is_insert, "insert").when(is_update, "update").otherwise("keep").alias(ACTION_COL))
    return j.select(*out)


def merge_counts(merged_with_action: DataFrame) -> DataFrame:
    """Affected-row report: rows per action (partial aggregation, tiny result)."""
    return merged_with_action.groupBy(ACTION_COL).count()


def merge_into_table(source: DataFrame, table: str, keys: list[str], newer_by: str | None = None) -> None:
    """MERGE ``source`` into a catalog table that supports row-level changes
    (e.g. a Delta or Iceberg table): matched rows updated, others inserted,
    target-only rows untouched; only the files holding touched rows are
    rewritten. Built-in parquet tables refuse MERGE; for them use
    :func:`merge_upsert` and write the result with ``replace_table``."""
    target_alias = table.split(".")[-1]
    cond = " AND ".join(f"{target_alias}.`{k}` = src.`{k}`" for k in keys)
    newer = F.expr(f"coalesce({target_alias}.`{newer_by}` <= src.`{newer_by}`, true)") if newer_by else F.lit(True)
    (source.alias("src").mergeInto(table, F.expr(cond))
     .whenMatched(newer).updateAll()
     .whenNotMatched().insertAll()
     .merge())
