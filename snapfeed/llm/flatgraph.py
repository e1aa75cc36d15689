"""Near-duplicate vectors by a robust-pruned flat graph.

1. Vectors are brought to length 1 in double precision; equal ones form a class
   whose smallest vec_id stands for it.
2. Cells: k-means over a bounded sample (``SAMPLE`` classes by a hash). Every
   class goes to its ``overlap`` nearest cells. A cell is cut by hash into shards
   of about ``SHARD_ROWS`` vectors, so a cluster with a third of all rows is many
   shards.
3. In each shard a flat graph is built by batched insertion: a greedy beam search
   from the shard's medoid gives the candidates of a new vector, robust pruning
   (``ALPHA``) picks at most ``DEGREE`` of them, reverse edges are added and
   pruned alike. The adjacency lists of a class from all its shards are united.
4. Every class is searched in the shards of its cells, a block of classes
   against a shard at a time: greedy beam search from the shard's medoids and from
   the class's own neighbours, then range expansion: every vector found within
   the range has all its neighbours visited, until no new one is in range.
5. Links are verified in double precision (cosine >= ``COSINE``). An audit compares a
   bounded sample of queries (``AUDITS``) with all classes; while its recall is
   below ``RECALL`` the search is repeated with more cells and a wider beam, and
   all links found count.

Defined results: vectors that are null, empty or zero, or have null or
non-finite components, link with nothing; shorter vectors are padded with zeros;
rows that share a vec_id count as one vector (the first by value); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import drop_stored, stored
from snapfeed.llm.components import connected_components

COSINE = 0.9
SAMPLE = 20_000
CELL_ROWS, MOST_CELLS = 2_000, 1_000
SHARD_ROWS = 4_000
DEGREE, ALPHA, BEAM, BATCH = 32, 1.2, 64, 512
MEDOIDS = 8
AUDITS, AUDIT_LINKS, RECALL, LEAST_RECALL, ATTEMPTS = (512, 4096), 50, 0.97, 0.9, 3


def unit(v, width: int) -> np.ndarray | None:
    """The vector at length 1, or None if it links with nothing."""
    if v is None or any(x is None for x in v):
        return None
    a = np.zeros(width)
    a[:len(v)] = v
    top = np.abs(a).max(initial=0.0)
    if not np.isfinite(a).all() or top == 0:
        return None
    a /= top
    return a / np.sqrt(a @ a) + 0.0


def normalised(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit): unit as binary doubles, null for vectors without direction."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unit(v, max(width, 1)) for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())], ["vec_id", "unit"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id bigint, unit binary")


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1)


def centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norms = np.sqrt((sums ** 2).sum(1))
        c[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return c


class Graph:
    """A flat graph over ``x``: rows of neighbour indices, -1 for none."""

    def __init__(self, x: np.ndarray, edges: np.ndarray):
        self.x, self.edges = x, edges

    def beam(self, queries: np.ndarray, entries: np.ndarray, width: int, least: float = 2.0):
        """Greedy beam search of all queries in step. ``entries``: start nodes of
        each query, -1 for none. Returns the nodes of the beams, what was visited,
        and all visited (query, node) with a cosine of at least ``least``."""
        q, n = len(queries), len(self.x)
        rows = np.arange(q)[:, None]
        visited = np.zeros((q, n + 1), dtype=bool)
        visited[:, n] = True  # index -1
        nodes = np.full((q, width), -1)
        sims = np.full((q, width), -2.0)
        done = np.ones((q, width), dtype=bool)
        fresh = entries
        alive = np.arange(q)
        close = []
        while True:
            fresh = np.sort(fresh, axis=1)
            again = np.zeros(fresh.shape, dtype=bool)
            again[:, 1:] = fresh[:, 1:] == fresh[:, :-1]
            new = ~visited[alive[:, None], fresh] & ~again
            visited[alive[:, None], np.where(new, fresh, n)] = True
            found = np.where(new, np.einsum("qd,qrd->qr", queries[alive], self.x[fresh]), -2.0)
            if least <= 1:
                who, which = np.nonzero(found >= least)
                close.append((alive[who], fresh[who, which]))
            all_nodes = np.concatenate([nodes[alive], np.where(new, fresh, -1)], axis=1)
            all_sims = np.concatenate([sims[alive], found], axis=1)
            all_done = np.concatenate([done[alive], ~new], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            at = rows[:len(alive)]
            nodes[alive], sims[alive], done[alive] = all_nodes[at, best], all_sims[at, best], all_done[at, best]
            alive = alive[~done[alive].all(axis=1)]
            if not len(alive):
                return nodes, visited[:, :n], tuple(np.concatenate([c[i] for c in close]) for i in (0, 1)) if close else None
            first = (~done[alive]).argmax(axis=1)
            done[alive, first] = True
            fresh = self.edges[nodes[alive, first]]

    def in_range(self, queries: np.ndarray, entries: np.ndarray, width: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """All (query, node) that range expansion reaches with cosine >= ``least``."""
        _, visited, front = self.beam(queries, entries, width, least)
        out = [front]
        while len(front[0]):
            pieces = []
            for i in range(0, len(front[0]), 20_000):
                next_ = self.edges[front[1][i:i + 20_000]]
                who = np.repeat(front[0][i:i + 20_000], next_.shape[1])
                next_ = next_.ravel()
                new = (next_ >= 0) & ~visited[who, next_]
                key = np.unique(who[new] * len(self.x) + next_[new])
                who, next_ = key // len(self.x), key % len(self.x)
                visited[who, next_] = True
                near = np.einsum("md,md->m", queries[who], self.x[next_]) >= least
                pieces.append((who[near], next_[near]))
            front = tuple(np.concatenate([p[i] for p in pieces]) for i in (0, 1))
            out.append(front)
        return tuple(np.concatenate([p[i] for p in out]) for i in (0, 1))


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """For each point at most ``degree`` of its candidates (-1: none): the closest
    left is taken, and those that it is ``alpha`` times closer to than the point go."""
    candidates = np.sort(candidates, axis=1)
    gone = candidates < 0
    gone[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
    gone |= candidates == points[:, None]
    theirs = x[candidates]
    own = 1 - np.einsum("pd,pcd->pc", x[points], theirs)
    own[gone] = np.inf
    order = np.argsort(own, axis=1, kind="stable")
    at = np.arange(len(points))[:, None]
    candidates, own, gone, theirs = candidates[at, order], own[at, order], gone[at, order], theirs[at, order]
    out = np.full((len(points), degree), -1)
    rows = np.arange(len(points))
    for k in range(degree):
        first = (~gone).argmax(axis=1)
        has = ~gone[rows, first]
        if not has.any():
            break
        out[has, k] = candidates[has, first[has]]
        between = 1 - np.einsum("pd,pcd->pc", theirs[rows, first], theirs)
        gone |= (alpha * alpha * between <= own) & has[:, None]
        gone[rows, first] = True
    return out


def build(x: np.ndarray, beam: int = BEAM, seed: int = 11) -> np.ndarray:
    """Neighbour rows of a flat graph over ``x`` by insertion in growing batches."""
    n = len(x)
    edges = np.full((n, DEGREE), -1)
    if n < 2:
        return edges
    order = np.random.default_rng(seed).permutation(n)
    medoid = int((x @ x.mean(0)).argmax())
    order = np.concatenate([[medoid], order[order != medoid]])
    graph, at = Graph(x, edges), 1
    while at < n:
        batch = order[at:at + min(at, BATCH)]
        nodes, _, _ = graph.beam(x[batch], np.full((len(batch), 1), medoid), beam)
        among = x[batch] @ x[batch].T
        np.fill_diagonal(among, -2)
        few = min(8, len(batch) - 1)
        mates = batch[np.argpartition(-among, few - 1, axis=1)[:, :few]] if few else np.full((len(batch), 1), -1)
        edges[batch] = robust_prune(x, batch, np.concatenate([nodes, mates], axis=1))
        source, target = np.repeat(batch, DEGREE), edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        gains, start, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, count)
        for low in range(0, int(count.max()), 2 * DEGREE):  # at most 3 x DEGREE candidates at a time
            some = (place >= low) & (place < low + 2 * DEGREE)
            rows = np.searchsorted(gains, target[some])
            extra = np.full((len(gains), 2 * DEGREE), -1)
            extra[rows, place[some] - low] = source[some]
            touched = np.unique(rows)
            edges[gains[touched]] = robust_prune(x, gains[touched], np.concatenate([edges[gains[touched]], extra[touched]], axis=1))
        at += len(batch)
    return edges


def _build_shard(table: pa.Table) -> pa.Table:
    ids = table.column("rep").to_numpy()
    order = np.argsort(ids)
    ids, x = ids[order], _matrix(table.column("unit"))[order]
    edges = build(x)
    lists = [ids[e[e >= 0]] for e in edges]
    return pa.table({"rep": pa.array(ids), "neighbours": pa.array(lists, pa.list_(pa.int64()))})


def _search_shard(beam: int):
    def run(table: pa.Table) -> pa.Table:
        is_node = table.column("node").to_numpy().astype(bool)
        is_query = table.column("query").to_numpy().astype(bool)
        ids, x = table.column("rep").to_numpy(), _matrix(table.column("unit"))
        lists = table.column("neighbours").combine_chunks()
        flat, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
        base = np.flatnonzero(is_node)
        base = base[np.argsort(ids[base])]
        names = ids[base]
        if not len(names):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        where = np.searchsorted(names, flat)
        where[where == len(names)] = 0
        local = np.where(names[where] == flat, where, -1)
        degree = max(1, int(np.diff(cuts).max(initial=1)))
        rows = np.full((len(ids), degree), -1)
        length = np.diff(cuts)
        rows[np.repeat(np.arange(len(ids)), length), np.arange(len(flat)) - np.repeat(cuts[:-1] - cuts[0], length)] = local
        graph = Graph(x[base], rows[base])
        parts = [p for p in np.array_split(np.random.default_rng(3).permutation(len(base)), MEDOIDS) if len(p)]
        medoids = np.array([p[(graph.x[p] @ graph.x[p].mean(0)).argmax()] for p in parts])
        asked = np.flatnonzero(is_query)
        out = []
        for i in range(0, len(asked), BATCH):
            q = asked[i:i + BATCH]
            own = np.searchsorted(names, ids[q])
            own[own == len(names)] = 0
            own = np.where(names[own] == ids[q], own, -1)
            entries = np.concatenate([np.tile(medoids, (len(q), 1)), rows[q], own[:, None]], axis=1)
            who, node = graph.in_range(x[q], entries, beam, COSINE)
            u, v = ids[q][who], names[node]
            out.append((np.maximum(u, v)[u != v], np.minimum(u, v)[u != v]))
        u, v = (np.concatenate([p[k] for p in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
        both = np.unique(np.stack([u, v], axis=1), axis=0) if len(u) else np.zeros((0, 2), np.int64)
        return pa.table({"u": pa.array(both[:, 0], pa.int64()), "v": pa.array(both[:, 1], pa.int64())})
    return run


def _cells(reps: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """(cell, rep, unit): each class in its nearest cells."""
    few = min(overlap, len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _matrix(batch.column("unit")) @ centres.T
                best = np.argsort(-near, axis=1, kind="stable")[:, :few]
                for k in range(few):
                    yield pa.RecordBatch.from_arrays([pa.array(best[:, k].astype(np.int32)), batch.column("rep"), batch.column("unit")], ["cell", "rep", "unit"])

    return reps.mapInArrow(run, "cell int, rep bigint, unit binary")


def search(reps: DataFrame, centres: np.ndarray, overlap: int, beam: int) -> DataFrame:
    """Links (u, v), u > v, between classes (rep, unit)."""
    placed = stored(_cells(reps, centres, overlap), "cells")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # at most MOST_CELLS rows
    shards = {c: -(-n // SHARD_ROWS) for c, n in sizes.items()}
    count = F.element_at(F.create_map(*(F.lit(x) for item in shards.items() for x in item)), F.col("cell")) if shards else F.lit(1)
    placed = placed.withColumn("shards", count).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    edges = placed.groupBy("cell", "shard").applyInArrow(_build_shard, "rep bigint, neighbours array<bigint>")
    edges = stored(edges.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")), "adjacency")
    full = placed.join(edges, "rep").select("cell", "shards", "shard", "rep", "unit", "neighbours")
    other = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    nodes = full.withColumn("block", other).withColumn("node", F.lit(True)).withColumn("query", F.col("block") == F.col("shard"))
    asks = full.where("shards > 1").withColumn("block", F.col("shard")).withColumn("shard", other).where("block <> shard").withColumn("node", F.lit(False)).withColumn("query", F.lit(True))
    columns = ["cell", "shard", "block", "node", "query", "rep", "unit", "neighbours"]
    groups = nodes.select(*columns).unionByName(asks.select(*columns)).groupBy("cell", "shard", "block")
    return groups.applyInArrow(_search_shard(beam), "u bigint, v bigint").distinct()


def audit(reps: DataFrame, links: DataFrame) -> float | None:
    """Recall of the links of a bounded sample of classes against all classes. Samples of
    ``AUDITS`` are drawn until one has ``AUDIT_LINKS`` true links; None if the largest
    has no link at all, so that nothing was measured."""
    row = None
    for size in AUDITS:
        sample = reps.orderBy(F.xxhash64(F.lit("audit"), "rep"), "rep").limit(size).collect()
        if not sample:
            return None
        row = _audited(reps, links, np.array([r["rep"] for r in sample]), np.stack([np.frombuffer(r["unit"]) for r in sample]))
        if row["n"] >= AUDIT_LINKS or len(sample) < size:
            break
    return row["found"] / row["n"] if row["n"] else None


def _audited(reps: DataFrame, links: DataFrame, ids: np.ndarray, x: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q, at = np.nonzero(x @ _matrix(batch.column("unit")).T >= COSINE)
                u, v = ids[q], batch.column("rep").to_numpy()[at]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)[u != v]), pa.array(np.minimum(u, v)[u != v])], ["u", "v"])

    truth = reps.mapInArrow(run, "u bigint, v bigint").distinct()
    return truth.join(links.withColumn("found", F.lit(1)), ["u", "v"], "left").agg(F.count("*").alias("n"), F.count("found").alias("found")).first()


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vectors``: (vec_id, embedding, ...). One row per vector: vec_id, n_links,
    component_id, kept, audit_recall; see the module docstring."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    spark = vectors.sparkSession
    rows = stored(normalised(vectors), "units")
    each = rows.where("unit is not null and vec_id is not null").groupBy("vec_id").agg(F.min("unit").alias("unit"))
    reps = stored(each.groupBy("unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "classes")
    n = reps.count()
    cells = int(min(max(1, -(-2 * n // CELL_ROWS)), MOST_CELLS))
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("unit").collect()
    links = recall = None
    overlap, beam = 2, BEAM
    if sample:
        centres = centroids(np.stack([np.frombuffer(r["unit"]) for r in sample]), min(cells, len(sample)))
    for _ in range(ATTEMPTS if sample else 0):
        found = search(reps.select("rep", "unit"), centres, overlap, beam)
        links = stored(found if links is None else links.unionByName(found).distinct(), "vector-links")
        recall = audit(reps.select("rep", "unit"), links)
        drop_stored(spark)
        if recall is None or recall >= RECALL or overlap >= len(centres):
            break
        overlap, beam = min(2 * overlap, len(centres)), 2 * beam
    if recall is not None and recall < LEAST_RECALL:
        raise RuntimeError(f"the search found {recall:.3f} of the audited links; raise ATTEMPTS")
    if links is None:
        links = spark.createDataFrame([], "u bigint, v bigint")
    joined = connected_components(links)
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    other = reps.select(F.col("rep").alias("v"), "size")
    counts = both.join(other, "v").groupBy("u").agg(F.sum("size").alias("others"))
    classes = reps.join(counts, F.col("rep") == F.col("u"), "left").join(joined, F.col("rep") == F.col("node"), "left")
    classes = classes.select(F.col("unit").alias("of_unit"), (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("of_class"))
    member = each.join(classes, F.col("unit") == F.col("of_unit")).select(F.col("vec_id").alias("of_id"), "links", "of_class")
    out = rows.select("vec_id").join(member, F.col("vec_id") == F.col("of_id"), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("of_class", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.expr("vec_id is null or vec_id = component_id")).withColumn("audit_recall", F.lit(recall).cast("double"))
