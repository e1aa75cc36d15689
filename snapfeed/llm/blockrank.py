"""Ranked lexical search with geometrically blocked posting lists.

Scores are integers: a document's score for an item is the sum, over the item's
distinct terms, of ``weight(term) * ((10**9 * tf) // (1000 * tf + 20 * m))`` with
``m = 50 + (50 * n * N) // L`` (see ``impacts``).

The index. Documents become chunks of about ``CHUNK_POSTINGS`` postings of the
terms that the items ask for: one forward vector a document. Within a chunk each
posting list is clustered by document similarity: pivots are drawn from the list
and every document joins the pivot with the largest inner product of their impact
vectors. A cluster is a block; its stored summary holds the maximum of each
coordinate over its documents. A chunk is bounded, so a term that all documents
have is many bounded lists, and no list is gathered anywhere.

The search. A block's summed summary over an item's terms bounds the score of all
its documents exactly, so a block is skipped only if that bound is below the
item's threshold; the documents of the others are scored in full. The threshold is
a proven lower bound of the item's k-th best score: the k-th best among a hash
sample of the documents, by a histogram of exact scores (``SAMPLE``; a tighter or
looser one changes the work, never the result). An item needs only the lists of
its essential terms: those left when the terms with the smallest maxima in the
chunk, together below the threshold, are set aside. Lists of documents with over
``OPEN_ENTRIES`` asked terms on average (long items meeting long documents) are
left open: they have no summaries, and all their documents are scored. All sums
are integers below 2**53, so the bounds are exact in double precision.

Items are answered in batches of about ``BATCH_TERMS`` item terms by hash. Only a
batch's terms, weights and thresholds are broadcast (``BATCH_TERMS`` entries, or
one longer item's); document vectors never leave their chunk.

Defined results: a null text has no terms, and a document or item without terms
matches nothing; an item is a row, so repeated item rows are answered each;
repeated documents rank one by one; equal scores by ascending doc_id, nulls last;
extra columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapfeed.llm.common import FOLDED_WORD_BYTES, Block, U64, drop_stored, slices, span_hashes, stored
from snapfeed.llm.katz import pack, unpack

BEST = 50
CHUNK_POSTINGS, CHUNK_DOCS = 1_000_000, 32_768
BATCH_TERMS = 50_000
BLOCK = 16  # documents in a block, on average
OPEN_ENTRIES = 1_000
MATRIX = 4_000_000  # entries of a list's part that is clustered at once
SAMPLE, SAMPLED_ALL = 16, 4096  # one document in 16 sets the thresholds; all of them in a table of this size
STEPS = 16  # histogram steps per doubling of a score

GAPS = np.ones(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    GAPS[_first:_last + 1] = False
_TERM_BYTES = np.where(GAPS, U64(0), FOLDED_WORD_BYTES)

_CHUNKS = "chunk bigint, n_docs bigint, n_terms bigint, doc_ids array<bigint>, vectors binary, df binary"
_INDEX = "chunk bigint, doc_ids array<bigint>, vectors binary, lists binary"
_FOUND = "item int, doc_id bigint, score bigint"


def terms_of(texts: pa.Array) -> tuple[Block, np.ndarray]:
    """The block of texts and a 64-bit hash of each of its terms (A-Z folded)."""
    block = Block(texts, GAPS)
    return block, span_hashes(block.buf, _TERM_BYTES, block.starts)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            block, hashes = terms_of(part.column("text"))
            lists = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(block.first[:-1], block.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("ref"), part.column("item_id"), pa.array(lists, pa.list_(pa.int64()))], ["ref", "item_id", "terms"])


@dataclass
class Batch:
    """Items of a batch: ``vocabulary`` (sorted hashes), and each item's terms as
    indices into it (``terms`` from ``first[i]`` to ``first[i + 1]``)."""

    vocabulary: np.ndarray
    first: np.ndarray
    terms: np.ndarray

    @classmethod
    def of(cls, lists: list[list[int]]) -> Batch:
        arrays = [np.array(x, dtype=np.int64).view(U64) for x in lists]
        flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=U64)
        vocabulary, terms = np.unique(flat, return_inverse=True)
        return cls(vocabulary, np.cumsum([0, *map(len, arrays)]), terms)

    def item(self, i: int) -> np.ndarray:
        return self.terms[self.first[i]:self.first[i + 1]]

    def __len__(self) -> int:
        return len(self.first) - 1


@dataclass
class Weights:
    n: int  # documents with a term
    total: int  # their terms
    of: np.ndarray  # per vocabulary term

    @classmethod
    def from_counts(cls, n: int, total: int, df: np.ndarray) -> Weights:
        return cls(n, total, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) if x else 0 for x in df], dtype=np.int64))

    def impacts(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 50 + (50 * length * self.n) // self.total
        return self.of[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers of each range, one range after the other."""
    total = int(sizes.sum())
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


class Vectors:
    """The documents of a chunk: entries (term, impact) of document d from
    ``first[d]`` to ``first[d + 1]``."""

    def __init__(self, packed, weights: Weights):
        lengths, sizes, terms, tfs = (x.astype(np.int64) for x in unpack(packed))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.sizes, self.term = sizes, terms
        self.impact = weights.impacts(terms, tfs, np.repeat(lengths, sizes))

    def __len__(self) -> int:
        return len(self.sizes)

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``asked`` flags an item's terms."""
        at = ranges(self.first[docs], self.sizes[docs])
        total = np.concatenate([[0], np.cumsum(np.where(asked[self.term[at]], self.impact[at], 0))])
        ends = np.cumsum(self.sizes[docs])
        return total[ends] - total[ends - self.sizes[docs]]


def _chunk(batch: Batch):
    vocabulary, size = batch.vocabulary, len(batch.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids, lengths, sizes, terms, tfs, n_docs, n_terms, held = [], [], [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, sizes, terms, tfs, n_docs, n_terms, held, seq
            join = lambda x: (np.concatenate(x) if x else np.zeros(0, dtype=np.int64)).astype(U64)
            term = join(terms)
            row = [[(part << 32) + seq], [n_docs], [n_terms], [[i for x in ids for i in x]], [pack(join(lengths), join(sizes), term, join(tfs))],
                   [pack(np.bincount(term.astype(np.int64), minlength=size).astype(U64))]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            ids, lengths, sizes, terms, tfs, n_docs, n_terms, held, seq = [], [], [], [], [], 0, 0, 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["chunk", "n_docs", "n_terms", "doc_ids", "vectors", "df"])

        for rows in batches:
            for p in slices(rows, "text"):
                block, hashes = terms_of(p.column("text"))
                n_docs += int((block.counts > 0).sum())
                n_terms += len(hashes)
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, size - 1))
                hit = vocabulary[at] == hashes if size else np.zeros(len(hashes), dtype=bool)
                pairs, tf = np.unique(block.doc[hit] * size + at[hit], return_counts=True)
                doc, term = np.divmod(pairs, max(1, size))
                some, per_doc = np.unique(doc, return_counts=True)
                ids.append(p.column("doc_id").take(pa.array(some)).to_pylist())
                lengths.append(block.counts[some])
                sizes.append(per_doc)
                terms.append(term)
                tfs.append(tf)
                held += len(term)
                if held >= CHUNK_POSTINGS or sum(map(len, ids)) >= CHUNK_DOCS:
                    yield flush()
        if n_docs:
            yield flush()
    return run


def _document_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for packed in batch.column("df").to_pylist():
                total += unpack(packed)[0].astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["term", "df"])
    return run


def _sampled(chunk: int, docs: int, rate: int) -> np.ndarray:
    """Documents of a chunk by a hash of their place."""
    place = np.arange(docs, dtype=U64) + U64(chunk & 0xFFFFFFFF) * U64(0x9E3779B97F4A7C15) + U64(chunk >> 32) * U64(0xD6E8FEB86659FD93)
    place = (place ^ (place >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    return np.flatnonzero((place >> U64(33)) % U64(rate) == 0)


def step_of(scores: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(scores) * STEPS).astype(np.int64)


def floor_of(step: int) -> int:
    """A score that no score of the histogram step is below."""
    return max(1, math.floor(2.0 ** (step / STEPS) * (1 - 1e-9)))


def _histogram(batch: Batch, weights: Weights, rate: int):
    """(item, step, n): exact scores of the sampled documents, counted."""
    order = np.argsort(batch.terms, kind="stable")
    item_of = np.repeat(np.arange(len(batch)), np.diff(batch.first))[order]  # items by term
    first = np.searchsorted(batch.terms[order], np.arange(len(batch.vocabulary) + 1))
    asked = np.diff(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for rows in batches:
            for chunk, packed in zip(rows.column("chunk").to_pylist(), rows.column("vectors").to_pylist(), strict=True):
                v = Vectors(packed, weights)
                docs = _sampled(chunk, len(v), rate)
                cost = np.array([asked[v.term[v.first[d]:v.first[d + 1]]].sum() for d in docs], dtype=np.int64)
                cut = np.searchsorted(np.cumsum(cost), np.arange(0, int(cost.sum()) + MATRIX, MATRIX), side="right")
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    some = docs[a:b]
                    at = ranges(v.first[some], v.sizes[some])
                    terms = v.term[at]
                    to = ranges(first[terms], asked[terms])
                    pair = np.repeat(np.repeat(np.arange(len(some)), v.sizes[some]), asked[terms]) * len(batch) + item_of[to]
                    keys, group = np.unique(pair, return_inverse=True)
                    scores = np.bincount(group, weights=np.repeat(v.impact[at], asked[terms]), minlength=len(keys))
                    good = scores > 0
                    keys, n = np.unique((keys[good] % len(batch)) * 4096 + step_of(scores[good]), return_counts=True)
                    for key, x in zip(keys.tolist(), n.tolist(), strict=True):
                        seen[divmod(key, 4096)] = seen.get(divmod(key, 4096), 0) + x
        rows = [(i, s, n) for (i, s), n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate((pa.int32(), pa.int32(), pa.int64()))], ["item", "step", "n"])
    return run


def _thresholds(chunks: DataFrame, batch: Batch, weights: Weights, best: int) -> np.ndarray:
    """For each item a score that at least ``best`` documents reach (1 if fewer are known to score)."""
    rate = max(1, min(SAMPLE, weights.n // SAMPLED_ALL))
    counted = chunks.select("chunk", "vectors").mapInArrow(_histogram(batch, weights, rate), "item int, step int, n bigint")
    above = Window.partitionBy("item").orderBy(F.col("step").desc())
    reached = counted.groupBy("item", "step").agg(F.sum("n").alias("n")).withColumn("above", F.sum("n").over(above)).where(F.col("above") >= best)
    out = np.ones(len(batch), dtype=np.int64)
    for r in reached.groupBy("item").agg(F.max("step").alias("step")).collect():  # a row an item of the batch
        out[r["item"]] = floor_of(r["step"])
    return out


def essential(batch: Batch, maxima: np.ndarray, thresholds: np.ndarray) -> list[np.ndarray]:
    """Each item's terms without those whose maxima in the chunk, summed from the
    smallest, stay below its threshold."""
    out = []
    for i in range(len(batch)):
        terms = batch.item(i)
        terms = terms[maxima[terms] > 0]
        terms = terms[np.argsort(maxima[terms], kind="stable")]
        out.append(terms[np.cumsum(maxima[terms]) >= thresholds[i]])
    return out


def cluster(matrix: np.ndarray, seed: int, size: int = BLOCK) -> list[np.ndarray]:
    """Rows of ``matrix`` grouped by the pivot row of largest inner product."""
    m = len(matrix)
    if m <= size:
        return [np.arange(m)]
    pivots = np.random.default_rng(seed).choice(m, -(-m // size), replace=False)
    scaled = (matrix / max(1.0, float(matrix.max()))).astype(np.float32)
    nearest = (scaled @ scaled[pivots].T).argmax(1)
    order = np.argsort(nearest, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(nearest[order])) + 1)


def build_lists(v: Vectors, batch: Batch, thresholds: np.ndarray) -> bytes:
    """The blocked posting lists of a chunk: per list its term and coordinates, per
    block its documents and its summary (nonzero coordinates and maxima)."""
    size = len(batch.vocabulary)
    by_term = np.argsort(v.term, kind="stable")
    starts = np.searchsorted(v.term[by_term], np.arange(size + 1))
    doc_of = np.repeat(np.arange(len(v)), v.sizes)[by_term]
    maxima = np.zeros(size, dtype=np.int64)
    np.maximum.at(maxima, v.term, v.impact)
    needs: dict[int, list[int]] = {}
    for i, terms in enumerate(essential(batch, maxima, thresholds)):
        for t in terms.tolist():
            needs.setdefault(t, []).append(i)
    column = np.full(size, -1, dtype=np.int64)
    heads, coordinates, block_sizes, docs_of, entries, at_column, values = [], [], [], [], [], [], []
    unions: dict[tuple[int, ...], np.ndarray] = {}
    for t, items in needs.items():
        docs = doc_of[starts[t]:starts[t + 1]]
        if v.sizes[docs].mean() > OPEN_ENTRIES:
            heads.append((t, 0, 1))
            block_sizes.append(len(docs)), docs_of.append(docs), entries.append(0)
            continue
        if (coords := unions.get(tuple(items))) is None:
            coords = unions[tuple(items)] = np.unique(np.concatenate([batch.item(i) for i in items]))
        column[coords] = np.arange(len(coords))
        rows, blocks = max(BLOCK, MATRIX // len(coords)), 0
        for a in range(0, len(docs), rows):
            some = docs[a:a + rows]
            at = ranges(v.first[some], v.sizes[some])
            where = column[v.term[at]]
            inside = where >= 0
            matrix = np.zeros((len(some), len(coords)))
            matrix[np.repeat(np.arange(len(some)), v.sizes[some])[inside], where[inside]] = v.impact[at][inside]
            for members in cluster(matrix, t + a):
                top = matrix[members].max(0)
                used = np.flatnonzero(top)
                block_sizes.append(len(members))
                docs_of.append(some[members])
                entries.append(len(used))
                at_column.append(used)
                values.append(top[used])
                blocks += 1
        heads.append((t, len(coords), blocks))
        coordinates.append(coords)
        column[coords] = -1
    join = lambda x: np.concatenate(x).astype(U64) if x else np.zeros(0, dtype=U64)
    flat = np.array(heads, dtype=U64).reshape(-1, 3)
    return pack(flat[:, 0], flat[:, 1], flat[:, 2], join(coordinates), np.array(block_sizes, dtype=U64), join(docs_of), np.array(entries, dtype=U64), join(at_column), join(values))


def _build(batch: Batch, weights: Weights, thresholds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                packed = rows.column("vectors")[i].as_py()
                lists = build_lists(Vectors(packed, weights), batch, thresholds)
                yield pa.RecordBatch.from_arrays([*(rows.column(c).slice(i, 1) for c in ("chunk", "doc_ids", "vectors")), pa.array([lists], pa.binary())],
                                                 ["chunk", "doc_ids", "vectors", "lists"])
    return run


def candidates(lists, v: Vectors, batch: Batch, thresholds: np.ndarray) -> np.ndarray:
    """Pairs (item * documents + document), distinct, from the blocks whose bound
    reaches the item's threshold."""
    term, n_coords, n_blocks, coords, block_sizes, docs, entries, at_column, values = (x.astype(np.int64) for x in unpack(lists))
    maxima = np.zeros(len(batch.vocabulary), dtype=np.int64)
    np.maximum.at(maxima, v.term, v.impact)
    needs: dict[int, list[int]] = {}
    for i, terms in enumerate(essential(batch, maxima, thresholds)):
        for t in terms.tolist():
            needs.setdefault(t, []).append(i)
    doc_at, entry_at = np.concatenate([[0], np.cumsum(block_sizes)]), np.concatenate([[0], np.cumsum(entries)])
    column = np.full(len(batch.vocabulary), -1, dtype=np.int64)
    found, c, b = [], 0, 0
    for t, width, blocks in zip(term.tolist(), n_coords.tolist(), n_blocks.tolist(), strict=True):
        items = needs[t]
        if not width:  # an open list
            found.append((np.array(items)[:, None] * len(v) + docs[doc_at[b]:doc_at[b + 1]]).ravel())
            b += 1
            continue
        here = coords[c:c + width]
        column[here] = np.arange(width)
        asked = np.zeros((width, len(items)))
        for j, i in enumerate(items):
            asked[column[batch.item(i)], j] = 1
        most = max(1, MATRIX // width)
        for x in range(b, b + blocks, most):
            y = min(b + blocks, x + most)
            summary = np.zeros((y - x, width))
            span = slice(entry_at[x], entry_at[y])
            summary[np.repeat(np.arange(y - x), entries[x:y]), at_column[span]] = values[span]
            block, j = np.nonzero(summary @ asked >= thresholds[items])
            block += x
            sizes = block_sizes[block]
            pairs = np.repeat(np.array(items)[j], sizes) * len(v) + docs[ranges(doc_at[block], sizes)]
            found.append(np.unique(pairs))
        column[here] = -1
        c, b = c + width, b + blocks
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def _search(batch: Batch, weights: Weights, thresholds: np.ndarray, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.zeros(len(batch.vocabulary), dtype=bool)
        for rows in batches:
            for ids, packed, lists in zip(rows.column("doc_ids"), rows.column("vectors").to_pylist(), rows.column("lists").to_pylist(), strict=True):
                v = Vectors(packed, weights)
                ids = ids.values
                order_of = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                item, doc = np.divmod(candidates(lists, v, batch, thresholds), max(1, len(v)))
                cut = np.searchsorted(item, np.arange(len(batch) + 1))
                for i in np.flatnonzero(np.diff(cut)).tolist():
                    docs = doc[cut[i]:cut[i + 1]]
                    asked[batch.item(i)] = True
                    scores = v.scores(docs, asked)
                    asked[batch.item(i)] = False
                    good = scores >= thresholds[i]
                    docs, scores = docs[good], scores[good]
                    top = np.lexsort((order_of[docs], -scores))[:best]
                    if len(top):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), i), pa.int32()), ids.take(pa.array(docs[top])), pa.array(scores[top])],
                                                         ["item", "doc_id", "score"])
    return run


def _answer(docs: DataFrame, items: list, best: int) -> DataFrame | None:
    """(ref, item_id, doc_id, score) candidates for the top of each item of a batch."""
    spark = docs.sparkSession
    batch = Batch.of([r["terms"] for r in items])
    chunks = stored(docs.mapInArrow(_chunk(batch), _CHUNKS), "vectors")
    n, total = chunks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    if not n or not len(batch.vocabulary):
        return None
    df = np.zeros(len(batch.vocabulary), dtype=np.int64)
    counted = chunks.select("df").mapInArrow(_document_counts(len(df)), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.collect():  # a row a term of the batch
        df[r["term"]] = r["df"]
    weights = Weights.from_counts(n, total, df)
    thresholds = _thresholds(chunks, batch, weights, best)
    index = stored(chunks.select("chunk", "doc_ids", "vectors").mapInArrow(_build(batch, weights, thresholds), _INDEX), "blocks")
    drop_stored(spark, chunks)
    found = index.select("doc_ids", "vectors", "lists").mapInArrow(_search(batch, weights, thresholds, best), _FOUND)
    names = spark.createDataFrame([(i, r["ref"], r["item_id"]) for i, r in enumerate(items)], "item int, ref bigint, item_id bigint")
    return found.join(F.broadcast(names), "item").select("ref", "item_id", "doc_id", "score")  # at most BATCH_TERMS items


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``docs``: (doc_id, text, ...), ``items``: (item_id, text, ...). Each item's
    ``best`` documents of highest score above 0: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.monotonically_increasing_id().alias("ref"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stored(items.mapInArrow(_item_terms, "ref bigint, item_id bigint, terms array<bigint>").where("size(terms) > 0"), "items")
    total = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    batches = -(-total // BATCH_TERMS)
    out = spark.createDataFrame([], "ref bigint, item_id bigint, doc_id bigint, score bigint")
    for b in range(batches):
        batch = items.where(F.pmod(F.xxhash64("ref"), F.lit(batches)) == b).orderBy("ref").collect()  # about BATCH_TERMS terms
        if batch and (answer := _answer(docs, batch, best)) is not None:
            out = out.unionByName(answer)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("ref").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())))
    return ranked.where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
