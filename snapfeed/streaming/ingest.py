"""File-arrival ingest with Structured Streaming.

Each newly landed file is read once (the stream's checkpoint is the ledger of
seen files). A micro-batch is parsed once into the shared scratch folder, routed
by file name, cleaned, written to the snapshot history and merged into the
staging table. ``foreachBatch`` is at-least-once, so every step can run twice:

* the history has one partition per (snapshot date, source file), and a write
  replaces the partitions of its files, so a half-written or repeated append
  leaves each file's rows once;
* a ledger row per file is written last, after the merge. A batch that failed
  anywhere before that is done again in full; files in the ledger are skipped;
* the merge source is rebuilt from the whole history of the snapshot dates that
  the batch touched, and a staged row is never replaced by one of an older
  snapshot. So the staging table depends on the files alone, not on their order
  of arrival or on how they were cut into batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.functions.names import feed_name_date, normalize_header_col, route_by_name, scan_file_name, summary_name_date
from snapfeed.operators.merge import merge_into_table
from snapfeed.operators.snapshot import SNAPSHOT_COL
from snapfeed.plans import rx
from snapfeed.plans.feeds import RX_DATE_FORMATS, RX_FEED_COLUMNS, SUMMARY_COLUMNS, SUMMARY_RENAMES, SUMMARY_TIMESTAMP_FORMATS, clean_rx, clean_summary
from snapfeed.session import materialise
from snapfeed.sources.csv import (CORRUPT_COL, OVER_COL, ROW_IN_SPLIT, SOURCE_FILE, SPLIT_START, fail_long_rows, keep_filled_rows, na_to_null,
                                  record_options, text_schema, with_cells, with_file_order)
from snapfeed.sources.tables import path_exists, replace_table, upsert_partitions

BatchHandler = Callable[[DataFrame, int], None]
POSITION = [SOURCE_FILE, SPLIT_START, ROW_IN_SPLIT]


def cell_columns(n: int) -> list[str]:
    """Column names for files whose header is matched by name, file by file."""
    return [f"_c{i}" for i in range(n)]


def _csv_options(reader, columns: list[str], header: bool, quoted_newlines: bool):
    return record_options(with_cells(reader.schema(text_schema(columns + [OVER_COL, CORRUPT_COL]))), header, quoted_newlines)


def csv_file_stream(spark: SparkSession, landing_dir: str, columns: list[str], glob: str | None = None,
                    max_files_per_trigger: int | None = 1000, quoted_newlines: bool = True, header: bool = True) -> DataFrame:
    """Stream of text rows from CSV files landing in a folder, tagged with the
    source file and scan position. Rows longer than ``columns`` are marked; the
    handler refuses them.

    ``quoted_newlines`` allows line ends inside quoted cells, at the price of one
    task per file whatever its size; switch it off for large files without them.
    ``header=False`` reads the header as a row (see ``SummaryIngest``)."""
    r = _csv_options(spark.readStream.format("csv"), columns, header, quoted_newlines)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # The in-split counter is added per micro-batch (see ``with_row_counter``):
    # streaming plans do not allow it.
    return r.load(landing_dir).select(*columns, OVER_COL, CORRUPT_COL, scan_file_name("_metadata.file_name").alias(SOURCE_FILE),
                                      F.col("_metadata.file_block_start").alias(SPLIT_START))


def with_row_counter(batch: DataFrame) -> DataFrame:
    """Add the in-split counter to a micro-batch; the batch is still the file
    scan, so the counter follows scan order within each split."""
    if ROW_IN_SPLIT in batch.columns:
        return batch
    return batch.withColumn(ROW_IN_SPLIT, F.monotonically_increasing_id())


def csv_file_batch(spark: SparkSession, paths: str | list[str], columns: list[str],
                   quoted_newlines: bool = True, header: bool = True) -> DataFrame:
    """The same rows as :func:`csv_file_stream`, read once as a batch (e.g. to
    reprocess a landing folder). The handler's ledger makes a second run a
    no-op."""
    return with_file_order(_csv_options(spark.read, columns, header, quoted_newlines).csv(paths))


def run_available(stream: DataFrame, checkpoint: str, handler: BatchHandler) -> None:
    """Process every file that has landed so far, then stop."""
    q = (stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


class FeedIngest:
    """Base batch handler: take the batch's valid files of one route that are not
    in the ledger, clean them, write them to the history (partitioned by the
    file's date and name), run :meth:`after_append`, then enter them in the ledger.

    ``history_path`` and ``ledger_path`` are shared folders. ``post_merge`` is
    called with (spark, batch_id) after the merge and before the ledger entry,
    e.g. to append the staging table elsewhere; it may run again for a batch that
    failed later."""

    route = "feed"

    def __init__(self, spark: SparkSession, history_path: str, ledger_path: str | None = None,
                 post_merge: Callable[[SparkSession, int], None] | None = None, partitions: int | None = None):
        self.spark = spark
        self.history_path = history_path.rstrip("/")
        self.ledger_path = ledger_path or f"{self.history_path}__ledger"
        self.post_merge = post_merge
        self.partitions = partitions

    # -- hooks --------------------------------------------------------------
    def file_date(self, name: Column) -> Column:
        raise NotImplementedError

    def route_of(self, name: Column) -> Column:
        raise NotImplementedError

    def text_rows(self, rows: DataFrame) -> DataFrame:
        """Named text columns and the position, from the batch's raw rows."""
        raise NotImplementedError

    def clean(self, rows: DataFrame, day: Column) -> DataFrame:
        raise NotImplementedError

    def after_append(self, days: DataFrame, batch_id: int) -> None:
        """Runs after the history has the batch's rows; ``days``: the snapshot
        dates that the batch touched."""

    # -- shared -------------------------------------------------------------
    def history(self) -> DataFrame:
        return self.spark.read.parquet(self.history_path)

    def _unseen(self, rows: DataFrame) -> DataFrame:
        """Rows of valid files of this route that the ledger doesn't have. A ledger
        that can't be read is an error, except that none exists yet."""
        n = F.col(SOURCE_FILE)
        rows = rows.where((self.route_of(n) == self.route) & self.file_date(n).isNotNull())
        if not path_exists(self.spark, self.ledger_path):
            return rows
        done = self.spark.read.schema("name string, day date, batch_id bigint").parquet(self.ledger_path).select(F.col("name").alias(SOURCE_FILE))
        return rows.join(done, SOURCE_FILE, "left_anti").select(*rows.columns)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # One parse of the files; everything below reads this table.
        rows = materialise(self._unseen(with_row_counter(batch)), "landed")
        files = rows.select(F.col(SOURCE_FILE).alias("name"), self.file_date(F.col(SOURCE_FILE)).alias("day")).distinct()
        if files.isEmpty():
            return
        cleaned = self.clean(self.text_rows(rows), self.file_date(F.col(SOURCE_FILE)))
        (cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(SNAPSHOT_COL, SOURCE_FILE).parquet(self.history_path))
        self.after_append(files.select(F.col("day").alias(SNAPSHOT_COL)).distinct(), batch_id)
        if self.post_merge:
            self.post_merge(self.spark, batch_id)
        files.select("name", "day", F.lit(batch_id).cast("bigint").alias("batch_id")).coalesce(1).write.mode("append").parquet(self.ledger_path)


class RxFeedIngest(FeedIngest):
    """Prescription files: clean, write to the snapshot history and merge into the
    staging table. Columns are taken by position."""

    route = "rx"

    def __init__(self, spark: SparkSession, history_path: str, staging_table: str, staging_root: str,
                 feed_prefix: str, *, ndc_value, placeholder: str, base_amount: float,
                 statuses: list[str], excluded_keys: list[tuple] = (), row_level_table: bool = False,
                 partition_by_month: bool = True, date_formats: tuple[str, ...] = RX_DATE_FORMATS, **base):
        super().__init__(spark, history_path, **base)
        # Staging partitioned by the month of the key's dispense date: an
        # upsert rewrites only the months the batch touches.
        self.partition_by_month = partition_by_month
        self.staging_table = staging_table
        self.staging_root = staging_root
        self.prefix = feed_prefix
        # True when the staging table's format supports MERGE (only touched
        # files are rewritten); otherwise the merged table is written anew.
        self.row_level_table = row_level_table
        self.clean_args = dict(ndc_value=ndc_value, placeholder=placeholder, date_formats=tuple(date_formats))
        self.source_args = dict(base_amount=base_amount, statuses=statuses, excluded_keys=list(excluded_keys), position=POSITION)

    def file_date(self, name: Column) -> Column:
        return feed_name_date(name, self.prefix)

    def route_of(self, name: Column) -> Column:
        return route_by_name(name, [(self.prefix, self.route)])

    def text_rows(self, rows: DataFrame) -> DataFrame:
        rows = keep_filled_rows(fail_long_rows(rows, len(RX_FEED_COLUMNS)), RX_FEED_COLUMNS)
        return na_to_null(rows, cols=RX_FEED_COLUMNS).select(*RX_FEED_COLUMNS, *POSITION)

    def clean(self, rows: DataFrame, day: Column) -> DataFrame:
        return clean_rx(rows, day, order_col=ROW_IN_SPLIT, group_extra=[SOURCE_FILE], bucket_col=SPLIT_START, carry=POSITION,
                        partitions=self.partitions, **self.clean_args)

    def after_append(self, days: DataFrame, batch_id: int) -> None:
        # All files of these dates, whichever batch brought them (the join prunes
        # the history's partitions at run time).
        touched = self.history().join(days, SNAPSHOT_COL, "left_semi")
        source = rx.rx_source(touched, latest=False, per_snapshot=True, **self.source_args)
        self._upsert(source.drop(SPLIT_START, ROW_IN_SPLIT))

    def _upsert(self, source: DataFrame) -> None:
        if self.partition_by_month:
            upsert_partitions(self.spark, self.staging_table, rx.with_dispense_month(source), rx.RX_KEYS,
                              rx.DISPENSE_MONTH, self.staging_root, validate_source=False, salt_null_keys=False, newer_by=SNAPSHOT_COL)
            return
        if self.row_level_table and self.spark.catalog.tableExists(self.staging_table):
            merge_into_table(source, self.staging_table, rx.RX_KEYS, newer_by=SNAPSHOT_COL)
            return
        if self.spark.catalog.tableExists(self.staging_table):
            target = self.spark.table(self.staging_table)
            merged = rx.merge_upsert(target, source, rx.RX_KEYS, validate_source=False, salt_null_keys=False, newer_by=SNAPSHOT_COL)
        else:
            merged = source
        replace_table(self.spark, merged, self.staging_table, self.staging_root)


class SummaryIngest(FeedIngest):
    """Benefit-summary files (``yyyymmdd- <LABEL>…``): read without header
    (``header=False``, ``cell_columns(n)``), as every file's own header gives the
    columns by name. Cleaned, then written to the summary history. The rx label
    wins when a name carries both markers."""

    route = "summary"

    def __init__(self, spark: SparkSession, history_path: str, label: str, rx_prefix: str | None = None,
                 timestamp_formats: tuple[str, ...] = SUMMARY_TIMESTAMP_FORMATS, **base):
        super().__init__(spark, history_path, **base)
        self.label = label
        self.rx_prefix = rx_prefix
        self.timestamp_formats = tuple(timestamp_formats)

    def file_date(self, name: Column) -> Column:
        return summary_name_date(name, self.label)

    def route_of(self, name: Column) -> Column:
        routes = ([(self.rx_prefix, "rx")] if self.rx_prefix else []) + [(self.label, self.route)]
        return route_by_name(name, routes)

    def text_rows(self, rows: DataFrame) -> DataFrame:
        """Match each row's cells to its file's header: the file's first row. A cell
        beyond the header, or a missing column, fails the batch."""
        cells = [c for c in rows.columns if c not in (OVER_COL, CORRUPT_COL, *POSITION)]
        rows = fail_long_rows(rows, len(cells))
        place = F.struct(SPLIT_START, ROW_IN_SPLIT)
        names = F.array(*(normalize_header_col(F.col(c)) for c in cells))
        heads = rows.groupBy(F.col(SOURCE_FILE).alias("of_file")).agg(F.min(place).alias("first"), F.min_by(names, place).alias("names"))
        body = rows.join(heads, F.col(SOURCE_FILE) == F.col("of_file")).where(place != F.col("first"))
        extra = reduce(lambda a, b: a | b, (F.col(c).isNotNull() & F.col("names")[i].isNull() for i, c in enumerate(cells)))
        body = body.where(F.when(extra, F.raise_error(F.concat(F.lit("CSV row longer than its header in "), SOURCE_FILE))).otherwise(F.lit(True)))
        known = F.filter(F.arrays_zip("names", F.array(*cells).alias("cells")), lambda x: x["names"].isNotNull())
        by_name = F.map_from_entries(F.transform(known, lambda x: F.struct(x["names"].alias("key"), x["cells"].alias("value"))))
        body = body.withColumn("by_name", by_name)

        def column(name: str) -> Column:
            said = [name] + [old for old, new in SUMMARY_RENAMES.items() if new == name]
            found = [F.array_contains(F.map_keys("by_name"), s) for s in said]
            value = F.coalesce(*(F.col("by_name")[s] for s in said))
            missing = F.raise_error(F.concat(F.lit(f"no column {name} in "), SOURCE_FILE)).cast("string")
            return F.when(reduce(lambda a, b: a | b, found), value).otherwise(missing).alias(name)

        named = body.select(*map(column, SUMMARY_COLUMNS), *POSITION)
        # Matched once: the election of date formats and the cleaning both read these rows.
        return materialise(na_to_null(keep_filled_rows(named, SUMMARY_COLUMNS), cols=SUMMARY_COLUMNS), "summary-rows")

    def clean(self, rows: DataFrame, day: Column) -> DataFrame:
        return clean_summary(rows.select(*SUMMARY_COLUMNS, SOURCE_FILE), day, carry=[SOURCE_FILE], ts_fmts=self.timestamp_formats,
                             fallback_fmts=self.timestamp_formats, partitions=self.partitions)


def rx_file_schema() -> T.StructType:
    return text_schema(RX_FEED_COLUMNS)
