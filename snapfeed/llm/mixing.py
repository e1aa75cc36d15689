"""Mixing sources to target weights by blocks of tokens.

The words of a source's documents, in an order drawn by hash, form one token
stream, packed into blocks of ``BLOCK`` words (the last may be shorter). A mix
is a set of numbered slots per source. Slot k reads epoch k // blocks and, in
it, the block that a pseudorandom permutation of the source's block indices
gives for k % blocks, so every block is read once before any is read again. The
last slot is cut so that a source gives exactly its rounded target. Slots go to
output shards by multinomial draws: given the totals per source, the counts per
shard of independent multinomial draws are one multinomial per source with equal
shares, and so they are drawn. ``mix`` joins slots with blocks by index.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating; they
share ``SHARE`` of all words by weight; a target stops at ``MOST_EPOCHS`` times
the source's words and the excess is shared again by weight until none is above.

A source may hold a third of all rows: streams are numbered by buckets of a
hash of doc_id (``BUCKET_ROWS`` documents each on average), never by one window
over a source. All draws come from hashes of the seed, so reruns agree.

Defined results: null and empty texts have no words and are never taken; a null
source is a source of its own; a null doc_id is numbered as the empty text;
repeated rows are separate documents; an empty table has no targets; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapfeed.llm.common import Block, aside, slices, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2
BLOCK = 128
SHARDS = 64
BUCKET_ROWS = 2_000
SEED = 20_26


def count_words(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the number of words of each text."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = Block(part.column("text")).counts
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(counts, pa.int64())], [*keep, "size"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{kinds}, size bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, ...) -> the same with target. One row per source, so
    the running number over all sources is over names only. ``SHARE`` of
    ``MOST_EPOCHS`` times all words always fits; each round caps the sources that
    are above and shares the rest, so there are at most as many rounds as caps."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int")))
    ranked = stored(ranked, "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, most = 0.0, MOST_EPOCHS * F.col("source_size")
    while True:  # target = min(most, level * weight); the level only rises
        over = most <= level * F.col("weight")
        capped, free = ranked.agg(F.sum(F.when(over, most).otherwise(0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0))).first()
        if not free:
            break
        risen = (SHARE * total - capped) / free
        if risen <= level:
            break
        level = risen
    return ranked.withColumn("target", F.least(most.cast("double"), F.lit(level) * F.col("weight")))


def _mix(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x = (x ^ x >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
    return x ^ x >> 31


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed pseudorandom permutation of range(n): a four-round Feistel network
    over the next even number of bits, walked until the value is below n."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(_mix(key * 4 + r + 1 & (1 << 64) - 1)) for r in range(4)]

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        for k in reversed(keys) if back else keys:
            moved = left if back else right
            f = (moved ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ f >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32) & mask
            left, right = (right ^ f, left) if back else (right, left ^ f)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (source, source_key, words, want, shard, first, count): the slots first.. of one shard."""
    for batch in batches:
        for r in batch.to_pylist():
            n, blocks, cut = r["count"], -(-r["words"] // BLOCK), r["words"] % BLOCK
            k = np.arange(r["first"], r["first"] + n, dtype=np.int64)
            epoch, place = k // blocks, k % blocks
            index = np.empty(n, dtype=np.int64)
            short = np.zeros(n, dtype=np.int64)  # words missing in earlier slots
            for e in np.unique(epoch):
                now = epoch == e
                index[now] = permuted(place[now], blocks, _mix(r["source_key"] + int(e) & (1 << 64) - 1))
            if cut:
                for e in range(int(epoch.max()) + 1):
                    at = e * blocks + int(permuted(np.array([blocks - 1]), blocks, _mix(r["source_key"] + e & (1 << 64) - 1), back=True)[0])
                    short[k > at] += BLOCK - cut
            size = np.where((index == blocks - 1) & (cut > 0), cut, BLOCK)
            take = np.clip(r["want"] - (k * BLOCK - short), 0, size)
            keep = take > 0
            m = int(keep.sum())
            yield pa.RecordBatch.from_arrays([pa.array([r["source"]] * m, pa.string()), pa.array([r["shard"]] * m, pa.int32()), pa.array(k[keep]), pa.array(epoch[keep]), pa.array(index[keep]), pa.array(take[keep])],
                                             ["source", "shard", "slot", "epoch", "block", "take"])


def _draws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Multinomial counts of a source's slots per output shard, in parts of bounded size."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            blocks = -(-r["source_size"] // BLOCK)
            want = min(int(round(r["target"])), MOST_EPOCHS * r["source_size"])
            slots = min(MOST_EPOCHS * blocks, -(-want // BLOCK) + MOST_EPOCHS) if want else 0
            drawn = np.random.default_rng(r["source_key"] & (1 << 63) - 1).multinomial(slots, [1 / SHARDS] * SHARDS)
            first = 0
            for shard, n in enumerate(drawn.tolist()):
                while n:
                    part = min(n, 1 << 16)
                    rows.append({"source": r["source"], "source_key": r["source_key"], "words": r["source_size"], "want": want, "shard": shard, "first": first, "count": part})
                    first, n = first + part, n - part
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("source", pa.string()), ("source_key", pa.int64()), ("words", pa.int64()), ("want", pa.int64()), ("shard", pa.int32()), ("first", pa.int64()), ("count", pa.int64())]))


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their place in the stream (row_id, doc_id, source, size,
    start), sources with targets, and slots (source, shard, slot, epoch, block, take)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    files = docs.sparkSession.sparkContext.defaultParallelism  # of a few numbers a document: one a core, however many parts the texts have
    sized = stored(count_words(docs, ["doc_id", "source"]).repartition(files), "sized")
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED), F.coalesce("doc_id", F.lit(-1))), F.lit(buckets)))
    parts = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    # as many rows as sources x buckets, a small part of the documents
    parts = parts.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    within = Window.partitionBy("source", "bucket").orderBy("doc_id", "size")
    placed = sized.withColumn("inside", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.withColumn("copy", F.row_number().over(Window.partitionBy("source", "bucket", "doc_id", "size").orderBy("inside")))
    parts = parts.select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), "before")
    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket"))
    placed = placed.join(parts, same).select("doc_id", "source", "size", "copy", (F.col("inside") + F.coalesce("before", F.lit(0))).alias("start"))
    placed = stored(placed.repartition(files), "placed")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = stored(sources.withColumn("source_key", F.xxhash64(F.lit(SEED), "source")), "targets")
    drawn = sources.where("source_size > 0").mapInArrow(_draws, "source string, source_key bigint, words bigint, want bigint, shard int, first bigint, count bigint")
    drawn = drawn.repartition("source", "shard", "first")
    slots = drawn.mapInArrow(_slots, "source string, shard int, slot bigint, epoch bigint, block bigint, take bigint")
    return placed, sources, slots


def pieces(placed: DataFrame) -> DataFrame:
    """The part of each document in each block it reaches into: words ``first`` ..
    ``first + n`` of the document, ``offset`` words into the block."""
    spread = placed.where("size > 0").select("*", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))).alias("block"))
    spread = spread.withColumn("first", F.greatest(F.lit(0), F.col("block") * BLOCK - F.col("start")))
    spread = spread.withColumn("offset", F.col("start") + F.col("first") - F.col("block") * BLOCK)
    return spread.withColumn("n", F.least(F.col("size") - F.col("first"), BLOCK - F.col("offset")))


def mix(placed: DataFrame, slots: DataFrame) -> DataFrame:
    """The mix: for each slot the words it takes of each document. The slots grow with the
    corpus, whatever size Spark takes them for, so they are merged and not broadcast."""
    slots = slots.withColumnsRenamed({"source": "of_source", "block": "of_block"})
    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("block") == F.col("of_block"))
    taken = F.least(F.col("n"), F.col("take") - F.col("offset"))
    return pieces(placed).join(slots.hint("merge"), same).where("offset < take").select("shard", "slot", "epoch", "doc_id", "source", "copy", "size", "first", taken.alias("words"))


def taken_words(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    placed, sources, slots = plan(docs)
    keys = ["doc_id", "source", "size", "copy"]
    used = mix(placed, slots).groupBy(*(F.col(k).alias(f"of_{k}") for k in keys)).agg(F.sum("words").alias("words"))
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    rows = placed.join(used.hint("merge"), same, "left").select("doc_id", "source", "size", F.coalesce("words", F.lit(0)).alias("taken"))
    sources = sources.select(F.col("source").alias("of_source"), "source_size", "target")
    return rows.join(sources, F.col("source").eqNullSafe(F.col("of_source"))).select("doc_id", "size", "source_size", "target", "taken")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text by the words of ``spans`` (first, words), in order."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = []
        for text, size, spans in zip(batch.column("text"), batch.column("size").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            joined: list[list[int]] = []
            for s in sorted(spans, key=lambda s: s["first"]):
                if joined and joined[-1][1] == s["first"]:
                    joined[-1][1] += s["words"]
                else:
                    joined.append([s["first"], s["first"] + s["words"]])
            if joined == [[0, size]]:
                texts.append(text.as_py())
                continue
            block = Block(pa.array([text.as_py() or ""], pa.string()))
            raw = block.buf.tobytes()
            texts.append("\n".join(raw[block.starts[a]:block.ends[b - 1]].decode() for a, b in joined))
        batch = batch.set_column(at, "text", pa.array(texts, pa.string()))
        yield batch.drop_columns(["spans", "size"])


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows with the columns of ``docs`` (doc_id, text, source, n_chars,
    ...): for each document and epoch a row with the words that the mix takes of it
    there; parts that do not follow each other are joined by a line end."""
    placed, _, slots = plan(docs)
    keys = ["doc_id", "source", "size", "copy"]
    spans = mix(placed, slots).groupBy(*(F.col(k).alias(f"of_{k}") for k in keys), "epoch")
    spans = spans.agg(F.collect_list(F.struct("first", "words")).alias("spans")).hint("merge")  # at most one a block of the document
    renamed, restore = aside(docs, ["doc_id", "source", "text", "n_chars"])
    rows = renamed.withColumns({"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string"), "text": F.col("text").cast("string")})
    rows = count_words(rows, renamed.columns)
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("text"))))
    rows = rows.join(spans, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]).select(*renamed.columns, "size", "spans")
    out = rows.mapInArrow(_cut, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("spans", "size")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text"))
    kinds = dict(zip(renamed.columns, (f.dataType for f in docs.schema), strict=True))
    return restore(out.select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items())))
