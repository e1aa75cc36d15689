"""JSON rows against a table schema: good rows typed, bad rows kept aside."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfeed.session import materialise

CORRUPT_COL = "_corrupt"
ERROR_COL = "_error"
TEXT_COL = "_json_text"


def json_error(value: Column, corrupt: Column, fields: list[str]) -> Column:
    """Why a JSON row is refused (NULL: it isn't): no content, not JSON, not an
    object, or fields that the schema doesn't have."""
    names = F.json_object_keys(value)
    unknown = F.array_except(names, F.array(*[F.lit(f) for f in fields]).cast("array<string>"))
    return (F.when(value.isNull() | (F.trim(value) == ""), F.lit("no content"))
            .when(corrupt.isNotNull(), F.lit("not readable with the schema"))
            .when(names.isNull(), F.lit("not a JSON object"))
            .when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", "))))


def parse_json_rows(df: DataFrame, value_col: str, schema: T.StructType) -> DataFrame:
    """Parse ``value_col`` with ``schema``. A refused row has all fields NULL, its
    text in ``_corrupt`` ('' for a NULL text) and the reason in ``_error``. Works on
    a stream as well as a batch."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    parsed = F.from_json(F.col(value_col), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    others = [c for c in df.columns if c != value_col]
    j = df.select(*others, F.col(value_col).alias(TEXT_COL), parsed.alias("__j"))
    j = j.withColumn(ERROR_COL, json_error(F.col(TEXT_COL), F.col(f"__j.{CORRUPT_COL}"), schema.fieldNames()))
    good = F.col(ERROR_COL).isNull()
    return j.select(*others, *[F.when(good, F.col(f"__j.{f}")).alias(f) for f in schema.fieldNames()],
                    F.when(~good, F.coalesce(F.col(TEXT_COL), F.lit(""))).alias(CORRUPT_COL), ERROR_COL)


def split_json_rows(df: DataFrame, value_col: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows typed, bad rows with their text and reason)."""
    p = parse_json_rows(df, value_col, schema)
    good = p.where(F.col(ERROR_COL).isNull()).drop(CORRUPT_COL, ERROR_COL)
    bad = p.where(F.col(ERROR_COL).isNotNull())
    return good, bad


def append_json_rows(df: DataFrame, value_col: str, table: str) -> DataFrame:
    """Insert the JSON rows that fit ``table``'s schema (by name) and return the
    others, with their text and reason. The table must exist."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise LookupError(f"table {table} was not found")
    schema = spark.table(table).schema
    # Parsed once into the shared scratch folder: the insert and the returned
    # bad rows come from the same data.
    parsed = materialise(parse_json_rows(df.select(value_col), value_col, schema), "json-rows")
    good = parsed.where(F.col(ERROR_COL).isNull()).drop(CORRUPT_COL, ERROR_COL)
    view = f"__json_rows_{uuid.uuid4().hex}"
    good.createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return parsed.where(F.col(ERROR_COL).isNotNull()).select(F.col(CORRUPT_COL).alias(value_col), ERROR_COL)


BATCH_COL = "_batch"


def json_rows_sink(schema: T.StructType, path: str, reject_path: str, value_col: str = "value"):
    """A ``foreachBatch`` function that appends the JSON rows that fit ``schema`` to the
    table at ``path`` and the others, with their text and reason, to ``reject_path``.

    Both are partitioned by the batch's id, and a batch overwrites its own partition: a
    batch that comes again, after a crash anywhere, leaves its rows once. A batch
    without good (or bad) rows leaves no partition. The text is parsed once."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed = materialise(parse_json_rows(batch.select(value_col), value_col, schema), "json-rows").withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
        good, bad = F.col(ERROR_COL).isNull(), F.col(ERROR_COL).isNotNull()
        for rows, target in ((parsed.where(good).drop(CORRUPT_COL, ERROR_COL), path),
                             (parsed.where(bad).select(F.col(CORRUPT_COL).alias(value_col), ERROR_COL, BATCH_COL), reject_path)):
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(target))
    return sink


def append_json_stream(stream: DataFrame, schema: T.StructType, path: str, reject_path: str, checkpoint: str, value_col: str = "value") -> None:
    """Append all JSON rows that have arrived on a stream, then stop."""
    query = (stream.writeStream.foreachBatch(json_rows_sink(schema, path, reject_path, value_col))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
