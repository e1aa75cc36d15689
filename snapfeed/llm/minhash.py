"""MinHash near-duplicates by an inverted join of signature coordinates.

1. Every whole text becomes its set of distinct 5-word shingles (64-bit hashes)
   and a signature of ``COORDINATES`` minimum hashes. Documents with equal sets
   form one class; its smallest doc_id stands for it from here on.
2. Each representative is posted under its (coordinate, value) pairs. Values
   that one representative alone has are dropped by a count; a representative
   with fewer than ``MATCHES`` shared values can match nobody and goes too.
3. Prefix merging: a pair with at least ``MATCHES`` common values must meet in
   the posting lists of the rarest ``m - MATCHES + 1`` of each one's ``m``
   shared values, so only those short lists are merged. The long lists are
   skipped: for a pair that met, the signatures are compared instead.
4. Lists are merged in two passes. The first compares each member of a list
   with the list's smallest member only, which is linear in the postings and
   joins the members of a large group of copies. The second compares the pairs
   of a list that are still in different components, and only those, by blocks
   of the list inside the tasks. Pairs of one component need no further link.
5. Pairs with at least ``MATCHES`` equal coordinates are confirmed on the full
   shingle sets (100 * intersection >= 75 * union).

At a similarity of 0.75 a pair has 48 of 64 equal coordinates on average; fewer
than 36 occur in one pair of about 3,060 (binomial 3.3e-4), and less often above.

Defined results: null and empty texts have no shingles and link with nothing; a
text of fewer than five words has its word sequence as its only shingle; equal
sets are linked without comparison; rows that share a doc_id count as one node;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import Block, U64, drop_stored, mixed, slices, stored
from snapfeed.llm.components import connected_components

WORDS = 5
COORDINATES = 64
MATCHES = 36
SIMILARITY_PERCENT = 75
LIST_BLOCK, DOC_BLOCK = 1024, 4096

_STEP = U64(0x9E3779B97F4A7C15)
_XORS = mixed(np.arange(1, COORDINATES + 1, dtype=U64) * _STEP)
_FACTORS = mixed(np.arange(1001, COORDINATES + 1001, dtype=U64) * _STEP) | U64(1)


def shingle_sets(block: Block, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block."""
    w = block.word_hashes()
    windows = max(0, len(w) - words + 1)
    total = np.zeros(windows, dtype=U64)
    for k in range(words):
        total *= U64(0xD6E8FEB86659FD93)
        total += w[k:k + windows]
    total = mixed(total)
    sets = []
    for i in range(block.n):
        a, b = int(block.first[i]), int(block.first[i + 1])
        if b - a >= words:
            sets.append(np.unique(total[a:b - words + 1]))
        elif b > a:
            short = U64(b - a)
            for x in w[a:b]:
                short = mixed(np.array([short], dtype=U64) * U64(0xA0761D6478BD642F) + x)[0]
            sets.append(np.array([short], dtype=U64))
        else:
            sets.append(np.zeros(0, dtype=U64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDINATES values for each non-empty set."""
    full = [s for s in sets if len(s)]
    out = np.empty((len(full), COORDINATES), dtype=np.int32)
    if full:
        values = np.concatenate(full)
        at = np.cumsum([0, *map(len, full[:-1])])
        for k in range(COORDINATES):
            low = np.minimum.reduceat((values ^ _XORS[k]) * _FACTORS[k], at)
            out[:, k] = (low >> U64(16)).astype(np.uint32).view(np.int32)
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(Block(part.column("text")))
            rows = iter(signatures(sets))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sigs = [next(rows) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "set_key", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(Block(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"])


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    if 100 * min(len(x), len(y)) < SIMILARITY_PERCENT * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= SIMILARITY_PERCENT * (len(x) + len(y) - common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, dtype=bool)
        for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"), strict=True)):
            keep[i] = _similar(np.frombuffer(a.as_buffer(), dtype=U64), np.frombuffer(b.as_buffer(), dtype=U64))
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep))


def _equal_coordinates(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs``: (doc_id, text, ...). One row per document: doc_id, n_shingles,
    component_id, kept; see the module docstring."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = stored(docs.mapInArrow(_describe, "doc_id bigint, n_shingles bigint, set_key binary, signature array<int>"), "shingled")
    classes = described.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
    classes = stored(classes, "classes")
    sigs = classes.groupBy("rep").agg(F.min_by("signature", "set_key").alias("signature"))  # a doc_id may have several texts

    posted = sigs.select("rep", F.posexplode("signature").alias("k", "value"))
    posted = posted.select("rep", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    lists = posted.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    lists = lists.where(F.size("tokens") >= MATCHES)
    prefix = lists.select("rep", F.explode(F.expr(f"slice(tokens, 1, size(tokens) - {MATCHES} + 1)")).alias("t")).select("rep", "t.token")
    prefix = stored(prefix, "postings")

    smallest = prefix.groupBy("token").agg(F.min("rep").alias("v"), F.max("rep").alias("last")).where("last > v").select("token", "v")
    pairs = prefix.join(smallest, "token").where("rep <> v").select(F.col("rep").alias("u"), "v").distinct()
    first = _confirmed(docs, sigs, pairs)
    joined = stored(connected_components(first), "components")

    member = prefix.join(joined, prefix.rep == joined.node, "left").select("token", "rep", F.coalesce("component", "rep").alias("c"))
    split = member.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).where("low < high").select("token", "n")
    member = stored(member.join(split, "token"), "unjoined")
    second = _across(docs, sigs, prefix, member)
    if not second.isEmpty():
        joined = stored(connected_components(first.unionByName(second)), "components")

    classes = classes.select("set_key", "rep").join(joined, F.col("rep") == F.col("node"), "left")
    classes = classes.select("set_key", F.coalesce("component", "rep").alias("of_class"))
    rows = described.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    rows = rows.select("doc_id", "n_shingles", F.coalesce("of_class", "doc_id").alias("component_id"))
    return rows.withColumn("kept", F.expr("doc_id is null or doc_id = component_id"))


def _meet(table: pa.Table) -> pa.Table:
    """Pairs of one posting list (one block of it against another) that are in
    different components and have enough equal coordinates, as lists for each pair of
    document blocks. Of the lists where a pair meets, that of its first common
    prefix coordinate reports it."""
    rep, c, side = (table.column(x).to_numpy() for x in ("rep", "c", "side"))
    sig = np.stack([np.frombuffer(x, dtype=np.int32) for x in table.column("sig").to_pylist()])
    mask = table.column("mask").to_numpy().view(U64)[:, None] >> np.arange(COORDINATES, dtype=U64) & U64(1) > 0
    k = int(table.column("token")[0].as_py()) >> 32 & COORDINATES - 1
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    found = [(left[:0], left[:0])]
    for i in range(0, len(left), 64):
        rows = left[i:i + 64]
        able = c[rows][:, None] != c[right][None]
        if (side == 2).all():
            able &= rep[rows][:, None] < rep[right][None]
        same = np.zeros(able.shape, dtype=np.uint8)
        for j in range(COORDINATES):
            same += sig[rows, j][:, None] == sig[right, j][None]
        x, y = np.nonzero(able & (same >= MATCHES))
        x, y = rows[x], right[y]
        common = (sig[x] == sig[y]) & mask[x] & mask[y]
        here = common.argmax(1) == k if len(x) else np.zeros(0, dtype=bool)
        found.append((x[here], y[here]))
    x, y = (np.concatenate([f[n] for f in found]) for n in (0, 1))
    u, v = np.maximum(rep[x], rep[y]), np.minimum(rep[x], rep[y])
    block = table.column("block").to_numpy()
    of_u = rep[x] > rep[y]
    bu, bv = np.where(of_u, block[x], block[y]), np.where(of_u, block[y], block[x])
    order = np.lexsort((bv, bu))
    u, v, bu, bv = u[order], v[order], bu[order], bv[order]
    starts = np.flatnonzero(np.append(True, (bu[1:] != bu[:-1]) | (bv[1:] != bv[:-1]))) if len(u) else np.zeros(0, dtype=np.int64)
    cut = np.append(starts, len(u))
    lists = lambda z: pa.array([z[cut[i]:cut[i + 1]] for i in range(len(starts))], pa.list_(pa.int64()))
    return pa.table({"bu": pa.array(bu[starts], pa.int64()), "bv": pa.array(bv[starts], pa.int64()), "us": lists(u), "vs": lists(v)})


def _confirm_lists(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    of = {d: np.frombuffer(x.as_buffer(), dtype=U64) for d, x in zip(sets.column("doc").to_pylist(), sets.column("shingles"), strict=True)}
    out = []
    for us, vs in zip(pairs.column("us").to_pylist(), pairs.column("vs").to_pylist(), strict=True):
        out += [(u, v) for u, v in zip(us, vs, strict=True) if _similar(of[u], of[v])]
    return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})


def _across(docs: DataFrame, sigs: DataFrame, prefix: DataFrame, member: DataFrame) -> DataFrame:
    """Confirmed pairs (u, v) between different components that share a prefix
    value. Lists are compared in blocks of ``LIST_BLOCK`` members, and what passes is
    confirmed in pairs of blocks of documents, so no step has a row a pair."""
    packed = sigs.join(member.select("rep").distinct(), "rep", "left_semi").mapInArrow(_pack_signature, "rep bigint, sig binary")
    masks = prefix.groupBy("rep").agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftright(token, 32) & {COORDINATES - 1} as int))")).alias("mask"))
    described = stored(packed.join(masks, "rep"), "unjoined-signatures")
    rows = member.join(described, "rep").join(_document_blocks(member), "rep").withColumn("parts", F.ceil(F.col("n") / LIST_BLOCK).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    rows = rows.select("token", "rep", "c", "sig", "mask", "block", "part", other)
    rows = rows.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other"), "side": F.expr("cast(if(part = other, 2, if(part < other, 0, 1)) as int)")})
    lists = rows.groupBy("token", "i", "j").applyInArrow(_meet, "bu bigint, bv bigint, us array<bigint>, vs array<bigint>")
    lists = stored(lists, "meetings")
    need = lists.select("bu", "bv", F.explode(F.array_union("us", "vs")).alias("doc")).distinct()
    wanted = need.select(F.col("doc").alias("doc_id")).distinct()
    sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id bigint, shingles binary").dropDuplicates(["doc_id"])
    sets = need.join(sets, F.col("doc") == F.col("doc_id")).select(F.col("bu").alias("with_u"), F.col("bv").alias("with_v"), "doc", "shingles")
    confirmed = lists.groupBy("bu", "bv").cogroup(sets.groupBy("with_u", "with_v")).applyInArrow(_confirm_lists, "u bigint, v bigint")
    return stored(confirmed, "confirmed")


def _document_blocks(member: DataFrame) -> DataFrame:
    """(rep, block): blocks of about DOC_BLOCK documents that share posting lists, so
    that the pairs of a group of copies lie in few pairs of blocks. A document's
    label is the smallest one within two steps of shared lists; documents of one
    label are cut by hash. The blocks decide only where a pair is confirmed."""
    label = member.select("token", "rep", F.col("rep").alias("label"))
    for _ in range(2):
        lowest = label.groupBy("token").agg(F.min("label").alias("low"))
        own = label.join(lowest, "token").groupBy("rep").agg(F.min("low").alias("label"))
        label = stored(label.select("token", "rep").join(own, "rep"), "labels")
    of = label.groupBy("rep").agg(F.min("label").alias("label"))
    size = of.groupBy("label").agg(F.ceil(F.count("*") / DOC_BLOCK).alias("parts"))
    return stored(of.join(size, "label").select("rep", F.xxhash64("label", F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("block")), "blocks")


def _pack_signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sigs = [np.array(x, dtype=np.int32).tobytes() for x in batch.column("signature").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sigs, pa.binary())], ["rep", "sig"])


def _confirmed(docs: DataFrame, sigs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) with enough equal coordinates and similar full sets."""
    a, b = sigs.select(F.col("rep").alias("u"), F.col("signature").alias("a")), sigs.select(F.col("rep").alias("v"), F.col("signature").alias("b"))
    close = pairs.join(a, "u").join(b, "v").where(_equal_coordinates("a", "b") >= MATCHES).select("u", "v")
    close = stored(close, "pairs")
    wanted = close.select(F.col("u").alias("doc_id")).unionByName(close.select(F.col("v").alias("doc_id"))).distinct()
    sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id bigint, shingles binary")
    sets = stored(sets.dropDuplicates(["doc_id"]), "sets")
    a, b = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    confirmed = stored(close.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(_confirm, "u bigint, v bigint"), "confirmed")
    drop_stored(docs.sparkSession, sets)
    return confirmed
