"""Tables: loads, writes, DDL with partitioning and bucketing, SQL text,
appends, exports and a safe whole-table replacement."""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snapfeed.operators.schema import enforce_schema
from snapfeed.sources.counts import Counts, counted, run_counted
from snapfeed.sources.csv import csv_writer

WRITE_MODES = {"truncate": "overwrite", "overwrite": "overwrite", "append": "append"}


def _mode(mode: str) -> str:
    try:
        return WRITE_MODES[mode.lower()]
    except KeyError:
        raise ValueError(f"write mode must be one of {sorted(WRITE_MODES)}") from None


def write_path(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
               partition_by: list[str] | None = None) -> None:
    w = df.write.mode(_mode(mode)).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def load_parquet(spark: SparkSession, source: str, target: str, mode: str = "append",
                 partition_by: list[str] | None = None) -> DataFrame:
    """Copy parquet files into a table path; returns the source frame."""
    df = spark.read.parquet(source)
    write_path(df, target, mode, partition_by=partition_by)
    return df


def load_dataframe(df: DataFrame, target: str, schema: T.StructType, mode: str = "append",
                   partition_by: list[str] | None = None) -> None:
    """Write with an explicit schema (select-cast by name)."""
    write_path(enforce_schema(df, schema), target, mode, partition_by=partition_by)


def ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, partition_col: str | None = None,
                 cluster_cols: list[str] | None = None, buckets: int = 0, location: str | None = None) -> bool:
    """Create the table if it does not exist. Returns True if it was created.

    ``cluster_cols`` with ``buckets`` buckets and sorts the files, so joins and
    merges on those columns read co-located data without a shuffle.
    """
    if spark.catalog.tableExists(table):
        return False
    ddl = f"CREATE TABLE IF NOT EXISTS {table} ({ddl_columns(schema)}) USING parquet"
    if partition_col:
        ddl += f" PARTITIONED BY (`{partition_col}`)"
    if cluster_cols and buckets:
        cols = ", ".join(f"`{c}`" for c in cluster_cols)
        ddl += f" CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {int(buckets)} BUCKETS"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return True


def run_query(spark: SparkSession, sql: str, args: dict | None = None,
              views: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL text -> lazy DataFrame, with named parameters and temp views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def run_query_counted(spark: SparkSession, sql: str, args: dict | None = None, views: dict[str, DataFrame] | None = None) -> tuple[DataFrame, Counts]:
    """:func:`run_query` with its row count (``counts["rows"]``), known once the rows
    have been read."""
    return counted(run_query(spark, sql, args, views))


def affected_rows(result: DataFrame) -> int | None:
    """Rows that a write statement run by ``spark.sql`` wrote, from its own plan
    (nothing runs again); None for statements that write no rows."""
    plan = result._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() != "CommandResultExec":
        return None
    ran = plan.commandPhysicalPlan()
    if ran.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        ran = ran.executedPlan()
    if ran.getClass().getSimpleName() == "ResultQueryStageExec":
        ran = ran.plan()
    metric = ran.metrics().get("numOutputRows")
    return int(metric.get().value()) if metric.isDefined() else None


def run_script(spark: SparkSession, script: str | list[str], counts: list | None = None) -> DataFrame | None:
    """Run statements in order. A list runs statement by statement; a string is
    run as one SQL script (``BEGIN ... END``). Returns the last result.
    ``counts``, for a list of statements, receives the affected rows of each
    (None where a statement writes none); for a script text, a
    :class:`~snapfeed.sources.counts.Statement` of each write that it ran."""
    if isinstance(script, str):
        body = script.strip().rstrip(";")
        if not body.upper().startswith("BEGIN"):
            body = f"BEGIN\n{body};\nEND"
        if counts is None:
            return spark.sql(body)
        result, statements = run_counted(spark, lambda: spark.sql(body))
        counts.extend(statements)
        return result
    result = None
    for stmt in script:
        result = spark.sql(stmt)
        if counts is not None:
            counts.append(affected_rows(result))
    return result


def append_query(spark: SparkSession, sql: str, table: str) -> int | None:
    """Append a query's rows to a table, matching columns by name; returns how many."""
    return affected_rows(spark.sql(f"INSERT INTO {table} BY NAME {sql}"))


def appended(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The content a by-name append produces (columns aligned to the target)."""
    types = {f.name: f.dataType for f in target.schema.fields}
    aligned = rows.select(*[rows[c].cast(types[c]).alias(c) for c in target.columns])
    return target.unionByName(aligned)


def export_csv(df: DataFrame, base_dir: str, prefix: str, day: _dt.date) -> str:
    """Header CSV, UTF-8, into ``<base_dir>/<prefix><yyyymmdd>.csv`` (a directory
    of part files, written in parallel), quoted as RFC 4180 has it."""
    path = f"{base_dir.rstrip('/')}/{prefix}{day.strftime('%Y%m%d')}.csv"
    csv_writer(df).mode("overwrite").csv(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other failure (permission, network) is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _absolute(root: str) -> str:
    """Table and partition locations must be absolute paths or URIs: a relative
    one would be resolved differently for tables and for partitions."""
    if "://" not in root and not root.startswith("/") and not root.startswith("file:"):
        raise ValueError(f"location must be an absolute path or URI, got {root!r}")
    return root.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def replace_table(spark: SparkSession, df: DataFrame, table: str, base_location: str, keep_versions: int = 1) -> str:
    """Write ``df`` to a fresh location and repoint ``table`` at it, in one catalog
    change: a reader sees the old or the new content.

    ``df`` may read ``table`` itself (a MERGE result): the old files are never
    overwritten while being read. Of the earlier versions below
    ``base_location`` the newest ``keep_versions`` stay (for readers that have
    begun); older ones are deleted.
    """
    root = _absolute(base_location)
    location = f"{root}/v-{time.time_ns():020d}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(location)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    _drop_versions(spark, root, keep_versions)
    return location


def write_buckets(df: DataFrame, table: str, keys: list[str], buckets: int, location: str) -> None:
    """Write ``df`` as a catalog table of sorted buckets of ``keys``. A frame that is
    already hash-partitioned into that many parts writes one file a bucket."""
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", location).saveAsTable(table)


def merge_into_buckets(spark: SparkSession, table: str, source: DataFrame, keys: list[str], buckets: int, root: str, **merge_args) -> str:
    """MERGE ``source`` into a table kept in ``buckets`` sorted buckets of ``keys``.

    Only the source is shuffled, once, into the same buckets; then every task joins
    one bucket of the table with its counterpart and writes that bucket of the next
    version, without an exchange on the table's side. The table is repointed in one
    catalog change, as by :func:`replace_table`; the first call creates it. Rows with
    a NULL key part never match; they stay in the bucket that their other parts give.
    Returns the new location."""
    from snapfeed.operators.merge import merge_upsert

    root = _absolute(root)
    name = f"{table}__{uuid.uuid4().hex}"
    location, staged = f"{root}/v-{time.time_ns():020d}-{uuid.uuid4().hex}", f"{root}/staged-{uuid.uuid4().hex}"
    exists = spark.catalog.tableExists(table)
    if exists:
        write_buckets(source, f"{name}_source", keys, buckets, staged)
        merged = merge_upsert(spark.table(table), spark.table(f"{name}_source"), keys, salt_null_keys=False, **merge_args)
    else:
        merged = source
    write_buckets(merged, name if exists else table, keys, buckets, location)
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
        for done in (name, f"{name}_source"):  # names only: the files are below root
            spark.sql(f"DROP TABLE {done}")
        _delete(spark, staged)
        _drop_versions(spark, root, keep=1)
    return location


def _drop_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Delete the versions below ``root`` but the current one and ``keep`` earlier ones."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    listed = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(fs)
    old = sorted(x.getPath().toString() for x in listed if x.getPath().getName().startswith("v-"))[:-1]
    for path in old[:max(0, len(old) - keep)]:
        _delete(spark, path)


def upsert_partitions(spark: SparkSession, table: str, source: DataFrame, keys: list[str], partition_col: str,
                      root: str, **merge_args) -> list:
    """MERGE ``source`` into a table partitioned by ``partition_col``, rewriting
    only the partitions the source touches.

    ``partition_col`` must be a function of the keys (e.g. the month of a key
    date), so a key never changes partition and the untouched partitions stay
    correct. ``table`` is a view on the current version, a partitioned table of
    which every version lists all partitions: untouched ones at their old place,
    touched ones newly written. Replacing the view is one catalog change, so a
    reader never sees some partitions swapped and others not; a crash before it
    leaves the old version. What reaches the driver is catalog metadata: the
    values of the touched and existing partitions. Returns the touched ones as
    text.
    """
    from snapfeed.operators.merge import merge_upsert

    root = _absolute(root)
    if source.where(source[partition_col].isNull()).limit(1).count():
        raise ValueError(f"{partition_col} must not be NULL")
    version = f"{table}__v{time.time_ns():020d}"
    location = f"{root}/{version.rsplit('.')[-1]}"
    exists = spark.catalog.tableExists(table)
    before = spark.sql(f"SHOW TBLPROPERTIES {table}").where("key = 'version_table'").collect()[0]["value"] if exists else None
    touched_rows = source.select(partition_col).distinct()
    if exists:
        current = spark.table(before)
        target = current.join(touched_rows, partition_col, "left_semi").select(*current.columns)
        merged = merge_upsert(target, source.select(*current.columns), keys, **merge_args)
    else:
        merged = source
    merged = merged.select(*[c for c in merged.columns if c != partition_col], partition_col)
    merged.write.partitionBy(partition_col).parquet(location)
    spark.sql(f"CREATE TABLE {version} ({ddl_columns(merged.schema)}) USING parquet PARTITIONED BY (`{partition_col}`) LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {version}")
    touched = {r[0] for r in spark.sql(f"SHOW PARTITIONS {version}").collect()}
    if exists:
        for spec in {r[0] for r in spark.sql(f"SHOW PARTITIONS {before}").collect()} - touched:
            value = unquote(spec.partition("=")[2])
            clause = f"PARTITION (`{partition_col}` = {_text_literal(value)})"
            place = spark.sql(f"DESCRIBE FORMATTED {before} {clause}").where("col_name = 'Location'").collect()[0]["data_type"]
            spark.sql(f"ALTER TABLE {version} ADD {clause} LOCATION '{place}'")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('version_table' = '{version}') AS SELECT * FROM {version}")
    if before:
        spark.sql(f"DROP TABLE {before}")  # the metadata only: its files belong to later versions too
    return sorted(unquote(x.partition("=")[2]) for x in touched)


def _text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
