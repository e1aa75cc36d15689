"""Landing-folder listing and the processed-file ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfeed.functions.names import accept_file, base_name


def list_files(spark: SparkSession, folder: str, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """(path, name, modified, length) of the files in a folder; the file
    contents are pruned from the read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.load(folder)
    return df.select("path", base_name("path").alias("name"),
                     F.col("modificationTime").alias("modified"), "length")


def new_files(files: DataFrame, ledger: DataFrame, name_col: str = "name",
              ledger_col: str = "name", keep: Column | None = None) -> DataFrame:
    """Files that pass ``keep`` and whose base name is not yet in the ledger."""
    f = files.where(keep) if keep is not None else files
    led = ledger.select(base_name(ledger_col).alias("__done"))
    return f.join(led, base_name(F.col(name_col)) == led["__done"], "left_anti")


def new_feed_files(files: DataFrame, ledger: DataFrame, prefix: str, label: str,
                   name_col: str = "name", ledger_col: str = "name") -> DataFrame:
    """Valid dated feed / summary files not yet processed."""
    return new_files(files, ledger, name_col, ledger_col, accept_file(F.col(name_col), prefix, label))
