import llm_brute as brute
import numpy as np
import pytest

from snapfeed.llm import flatgraph


def planted(seed=4, n=500, groups=(2, 2, 2, 5, 40, 90)):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 32))
    for g in groups:
        centre = rng.normal(size=32)
        x = np.vstack([x, centre + 0.2 * rng.normal(size=(g, 32))])
    return x / np.linalg.norm(x, axis=1)[:, None]


def links(x, ids):
    near = np.argwhere(np.triu(x @ x.T >= 0.9, 1))
    return {(ids[max(a, b)], ids[min(a, b)]) for a, b in near.tolist()}


@pytest.mark.parametrize("shard_rows, cell_rows", [(4000, 2000), (120, 150)])
def test_recall(spark, monkeypatch, shard_rows, cell_rows):
    """One shard, and many small ones with cells that are several shards."""
    monkeypatch.setattr(flatgraph, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(flatgraph, "CELL_ROWS", cell_rows)
    x = planted()
    ids = list(range(1000, 1000 + len(x)))
    rows = flatgraph.near_duplicates(spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, size int")).collect()
    want = links(x, ids)
    got = {r.vec_id: r for r in rows}
    assert sum(r.n_links for r in rows) >= 0.97 * 2 * len(want)
    degree = {i: sum(i in p for p in want) for i in ids}
    assert all(r.n_links <= degree[r.vec_id] for r in rows)
    component = brute.components(ids, want)
    assert np.mean([got[i].component_id == component[i] for i in ids]) >= 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_hard_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, v), (2, v), (3, [2.0, 4.0, 6.0]), (4, [-1.0, -2.0, -3.0]), (5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 3.0]), (9, [float("nan"), 1.0, 1.0]),
            (10, [float("inf"), 1.0, 1.0]), (11, [1e300, 2e300, 3e300]), (12, [5.0]), (13, [7.0, 0.0]), (None, v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.n_links, r.component_id) for r in flatgraph.near_duplicates(df).collect()]
    assert len(got) == len(rows)
    assert set(got) == {(1, 3, 1), (2, 3, 1), (3, 3, 1), (11, 3, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 0, 10), (12, 1, 12), (13, 1, 12), (None, 0, None)}
    assert flatgraph.near_duplicates(df.where("false")).count() == 0


def test_robust_prune_keeps_directions():
    x = np.array([[1.0, 0.0], [0.99, 0.14], [0.98, 0.2], [0.0, 1.0], [-1.0, 0.0]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = flatgraph.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, -1, 0, 1]]), degree=3)[0]
    assert got[0] == 1 and 2 not in got and len(set(got[got >= 0])) == (got >= 0).sum()


def test_audit_says_when_it_measured_nothing(spark, monkeypatch):
    """Without a true link in the sample the recall is null, and a search that misses
    most links is refused instead of returned."""
    apart = spark.createDataFrame([(i, np.eye(8)[i].tolist()) for i in range(8)], "vec_id long, embedding array<double>")
    assert {r.audit_recall for r in flatgraph.near_duplicates(apart).collect()} == {None}
    x = planted()
    linked = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    assert {r.audit_recall >= 0.97 for r in flatgraph.near_duplicates(linked).collect()} == {True}
    monkeypatch.setattr(flatgraph, "search", lambda reps, *_: spark.createDataFrame([], "u bigint, v bigint"))
    with pytest.raises(RuntimeError, match="audited links"):
        flatgraph.near_duplicates(linked)
