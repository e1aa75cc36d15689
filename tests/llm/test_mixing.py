import numpy as np
import pytest

from llm_cases import HARD, SF_SMALL
from snapfeed.llm import mixing
from snapfeed.session import read_table

import llm_brute as brute


def wanted(sizes):
    """Targets of {source: words} by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, free, total = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        rest, w = total - sum(out.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > 2 * sizes[s]]
        for s in over or free:
            out[s] = 2 * sizes[s] if over else rest * weight[s] / w
        free -= set(over) if over else free
    return out


def check(docs, rows):
    sizes = {}
    for d in rows:
        sizes[d[3]] = sizes.get(d[3], 0) + len(brute.words(d[1]))
    want = wanted(sizes)
    got = mixing.taken_words(docs).collect()
    assert sorted((str(r.doc_id), r["size"], r.source_size, round(r.target, 6)) for r in got) == sorted((str(d[0]), len(brute.words(d[1])), sizes[d[3]], round(want[d[3]], 6)) for d in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert abs(sum(r.taken for r in got) - sum(want.values())) <= len(want)
    again = mixing.taken_words(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    return got


def test_targets_and_takes(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    got = check(docs, rows)
    source = {r[0]: r[3] for r in rows}
    taken = {}
    for r in got:
        n, t = taken.get(source[r.doc_id], (0, r.target))
        taken[source[r.doc_id]] = n + r.taken, t
    assert all(abs(n - t) <= 1 for n, t in taken.values())


def test_hard_rows(hard, no_docs):
    check(hard, HARD)
    assert mixing.taken_words(no_docs).count() == 0
    mixed = mixing.mixed_documents(hard)
    assert mixed.columns == hard.columns
    taken = sum(r.taken for r in mixing.taken_words(hard).collect())
    assert sum(len(brute.words(r.text)) for r in mixed.collect()) == taken
    assert mixing.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations(n):
    p = mixing.permuted(np.arange(n), n, 99)
    assert sorted(p) == list(range(n))
    assert (mixing.permuted(p, n, 99, back=True) == np.arange(n)).all()


def test_slots_are_never_broadcast(spark, hard):
    """The slots' size estimate comes from a few rows of counts, so only a hint keeps
    a growing table from being broadcast."""
    placed, _, slots = mixing.plan(hard)
    plan = mixing.mix(placed, slots)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_few_files_between_steps(spark, monkeypatch):
    """Documents in many parts don't make as many small files of their sizes and places."""
    files = []

    def stored(df, *args, keep=mixing.stored):
        out = keep(df, *args)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(mixing, "stored", stored)
    docs = spark.range(200).selectExpr("id as doc_id", "repeat('some words ', int(id % 5)) as text", "concat('s', id % 3) as source").repartition(50)
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == 200 and sum(r["size"] for r in rows) == 800
    assert max(files) <= spark.sparkContext.defaultParallelism
