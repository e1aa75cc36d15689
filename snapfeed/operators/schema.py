"""Column naming and schema enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(names)} columns, got {len(df.columns)}")
    return df.toDF(*names)


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the present columns; absent names are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_schema(df: DataFrame, names: list[str]) -> DataFrame:
    lower = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in lower]
    if missing:
        raise KeyError(f"columns missing: {missing}")
    return df.select(*names)


def enforce_schema(df: DataFrame, schema: StructType, lenient: bool = False) -> DataFrame:
    """Select and cast every field of ``schema`` by name (error if one is missing).

    ``lenient`` uses ``try_cast`` (bad values become NULL) instead of a failing cast.
    """
    select_schema(df, schema.fieldNames())
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        out.append((c.try_cast(f.dataType) if lenient else c.cast(f.dataType)).alias(f.name))
    return df.select(*out)
