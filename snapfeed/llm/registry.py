"""Registered queries of this package and their DuckDB twins."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this library's modules to the executors once per application (they
    run its Arrow functions and need not have it installed), let Spark remove the
    shuffle files of each finished query, as every step here is stored, and keep the
    batches that Python gets small unless the session says otherwise."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2000")
    if any(str(f).rpartition("/")[2] == _ARCHIVE for f in sc.listFiles):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="snapfeed-zip-"), _ARCHIVE)
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)


_ARCHIVE = "snapfeed_modules.zip"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def query(name: str, sql: str | None = None):
    def add(run):
        @functools.wraps(run)
        def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add
