import numpy as np

from snapfeed.llm import pairwise
from snapfeed.llm.queries import REGISTRY
from snapfeed.session import read_table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = REGISTRY["op8_quality_classifier"](spark, SF).collect()
    assert len(rows) == 1000 and all((r.predicted == 1) == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_pairs_recover_the_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    true = x @ np.array([2.0, -1.0, 0.0, 0.5])
    good = true + rng.logistic(size=2000) > 0
    ranker = pairwise.fit(x[good], x[~good])
    assert np.corrcoef(ranker.raw(x), true)[0, 1] > 0.99
    assert 0.6 < (ranker.score(x) >= pairwise.THRESHOLD)[good].mean()


def test_hard_rows(hard, no_docs, hard_labels):
    ranker = pairwise.train(hard, hard_labels)
    rows = pairwise.classify(hard, ranker, ["doc_id"]).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    nothing = pairwise.train(no_docs, hard_labels)
    assert {(r.score, r.predicted) for r in pairwise.classify(hard, nothing, ["doc_id"]).collect()} == {(0.7, 1)}
    assert pairwise.classify(no_docs, ranker, ["doc_id"]).count() == 0
    assert pairwise.train(hard, hard_labels.where("false")).weights is None
