import random

from llm_cases import SF_SMALL
from snapfeed.llm import minhash
from snapfeed.llm.components import connected_components
from snapfeed.session import read_table

import llm_brute as brute


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(60)] + [(5, 5), (None, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = brute.components({x for p in real for x in p}, real)
    assert got == want


def test_matches_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    want = brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    assert result(docs) == want


def test_groups_of_near_copies(spark):
    """Copies with edits, a shared passage, a chain whose ends are not similar."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    docs, passage = [], [word() for _ in range(60)]
    base = [word() for _ in range(200)]
    for i in range(60):
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(len(copy))] = word()
        docs.append(" ".join(copy))
    for i in range(90):  # many of them similar to some others only
        copy = list(base)
        for _ in range(rnd.randint(0, 14)):
            copy[rnd.randrange(len(copy))] = word()
        docs.append(" ".join(copy))
    for i in range(40):
        docs.append(" ".join([*(word() for _ in range(100)), *passage, *(word() for _ in range(100))]))
    chain = [word() for _ in range(200)]
    for i in range(12):
        docs.append(" ".join(chain))
        chain = chain[15:] + [word() for _ in range(15)]
    rows = list(enumerate(docs))
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute.near_duplicates(rows)


def test_hard_rows(hard, no_docs):
    rows = minhash.near_duplicates(hard).collect()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == 12
    assert (1, 8, 1, True) in got and (2, 8, 1, False) in got and (None, 8, 1, True) in got
    assert (3, 0, 3, True) in got and (8, 0, 8, True) in got and (7, 1, 7, True) in got
    assert (6, 29_997, 5, False) in got
    assert minhash.near_duplicates(no_docs).count() == 0
