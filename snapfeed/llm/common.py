"""Shared helpers of the training-data operators: shared folders, Arrow rows,
and a vectorised word tokenizer over Arrow text buffers.

The tokenizer never makes Python strings. It looks at the UTF-8 bytes of a
block of documents at once, finds the words ``[^\\x20\\x09-\\x0D]+`` and gives
each a 64-bit hash of its bytes (A-Z folded to a-z where asked). Two words are
treated as equal when their 64-bit hashes are equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from snapfeed.session import ensure_checkpoint_dir

U64 = np.uint64
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage
    is cut at a table that outlives any executor."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    forget_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate rows when the application ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove tables made by ``stored`` that no later step reads. The shuffles of the
    steps that made them go with each finished step (see ``registry.ship``)."""
    jvm = spark.sparkContext._jvm
    for frame in frames:
        for file in frame.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def aside(df: DataFrame, needed: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with every column but ``needed`` under a name that no operator uses, and
    a function that selects the original columns again: extra columns may have any name."""
    names = {c: c if c in needed else f"_{i}" for i, c in enumerate(df.columns)}

    def restore(out: DataFrame) -> DataFrame:
        return out.select(*(out[new].alias(old) for old, new in names.items()))

    return df.toDF(*names.values()), restore


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (in place)."""
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def hash_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hash arrays."""
    return mixed(a * U64(0xD6E8FEB86659FD93) + (b ^ (b >> U64(29))) * U64(0xA0761D6478BD642F) + U64(1))


def _byte_table(fold: bool, keep_space: bool) -> np.ndarray:
    table = mixed(np.arange(1, 257, dtype=U64) * U64(_BASE))
    if fold:
        table[65:91] = table[97:123]
    if not keep_space:
        table[[9, 10, 11, 12, 13, 32]] = 0
    return table


WORD_BYTES = _byte_table(fold=False, keep_space=False)
FOLDED_WORD_BYTES = _byte_table(fold=True, keep_space=False)
LINE_BYTES = _byte_table(fold=False, keep_space=True)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _power(kind: str, n: int) -> np.ndarray:
    """base**i (or its inverse) modulo 2**64 for i < n."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        size = max(n, SLICE_BYTES + (1 << 16))
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=U64)
        if size <= 8 * SLICE_BYTES:
            _powers[kind] = have
    return have[:n]


def span_hashes(buf: np.ndarray, table: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Hash of the bytes from each start to the next start (to its end, if given);
    bytes that ``table`` maps to 0 count as absent."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    values = table[buf]
    values *= _power("up", len(buf))
    if ends is None:
        sums = np.add.reduceat(values, starts)
    else:
        total = np.zeros(len(buf) + 1, dtype=U64)
        np.cumsum(values, out=total[1:])
        sums = total[ends] - total[starts]
    return mixed(sums * _power("down", len(buf))[starts])


class Block:
    """Words of a block of documents.

    ``buf``: the bytes, ``offsets``: where each document starts in them,
    ``starts`` / ``ends``: of each word, ``first``: each document's first word
    (one more entry than documents), ``doc``: the document of each word. ``gaps``:
    the bytes that separate words (white space unless given)."""

    def __init__(self, texts: pa.Array, gaps: np.ndarray = IS_SPACE):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        raw = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        self.n = len(texts)
        low = int(raw[0]) if self.n else 0
        high = int(raw[-1]) if self.n else 0
        self.buf = np.frombuffer(data, dtype=np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
        self.offsets = raw - low if self.n else np.zeros(1, dtype=np.int64)
        inside = ~gaps[self.buf]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = self.offsets[:-1]
        cuts = cuts[cuts < len(self.buf)]
        begins[cuts] = inside[cuts]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        before = cuts[cuts > 0] - 1
        stops[before] = inside[before]
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n, dtype=np.int64), self.counts)

    def word_hashes(self, fold: bool = True) -> np.ndarray:
        return span_hashes(self.buf, FOLDED_WORD_BYTES if fold else WORD_BYTES, self.starts)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each document."""
        total = np.zeros(len(self.buf) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def per_doc_words(self, values: np.ndarray) -> np.ndarray:
        """Sum of a per-word array over each document."""
        total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.first[1:]] - total[self.first[:-1]]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with at most ``most`` bytes of text each (a
    longer text comes alone)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        limit = (int(total[start - 1]) if start else 0) + most
        stop = max(start + 1, int(np.searchsorted(total, limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
