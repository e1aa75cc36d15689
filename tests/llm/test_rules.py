import math

import numpy as np

from llm_cases import HARD, SF_SMALL
from snapfeed.llm import rules
from snapfeed.session import read_table

import llm_brute as brute


def test_counts_match_brute_force(spark, hard, hard_labels):
    labels = read_table(spark, SF_SMALL, "labels")
    docs = read_table(spark, SF_SMALL, "documents")
    got = {r.doc_id: r for r in rules.judge(docs, labels).collect()}
    for d in docs.collect():
        r, want = got[d.doc_id], brute.counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    rows = rules.judge(hard, hard_labels).collect()
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows) == sorted(str((d, *brute.counts(t))) for d, t, *_ in HARD)
    assert {r.doc_id for r in rows if r.kept} == {5, 6}


def test_empty_tables(no_docs, hard, hard_labels):
    assert rules.judge(no_docs, hard_labels).count() == 0
    assert rules.judge(hard, hard_labels.where("false")).where("kept").count() == 2


def test_accepted_keeps_columns(hard, hard_labels):
    kept = rules.accepted(hard, hard_labels)
    assert kept.columns == hard.columns and {r.doc_id for r in kept.collect()} == {5, 6}


def test_binomial():
    for k, n, p in ((0, 10, 0.2), (3, 10, 0.2), (9, 10, 0.9), (10, 10, 0.3), (40, 1000, 0.05)):
        want = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        assert abs(rules.binomial_at_most(k, n, p) - want) < 1e-9
    assert abs(rules.binomial_at_most(3, 50, rules.upper_bound(3, 50, 0.05)) - 0.05) < 1e-9


def test_cutoffs_hold_the_risk():
    """Over many samples the chosen cutoff's true rate of false rejections exceeds
    the risk at most as often as the error allows."""
    rng = np.random.default_rng(2)
    shape = np.linspace(1, 0, rules.GRID + 1)
    shape /= shape.sum()
    true_over = 1 - np.cumsum(shape)
    wrong = 0
    for _ in range(200):
        good = np.bincount(rng.choice(rules.GRID + 1, 2000, p=shape), minlength=rules.GRID + 1)
        bad = np.bincount(rng.integers(0, rules.GRID + 1, 200_000), minlength=rules.GRID + 1)
        cutoff = rules.choose(good, bad, 0.05)
        wrong += cutoff is not None and true_over[cutoff.step] > rules.RISK
    assert wrong <= 20


def test_cutoff_separates_or_is_off():
    good, bad = np.zeros(rules.GRID + 1, dtype=int), np.zeros(rules.GRID + 1, dtype=int)
    good[5], bad[100] = 500, 50
    cutoff = rules.choose(good, bad, 0.01)
    assert 5 <= cutoff.step < 100 and cutoff.bound < rules.RISK
    assert rules.choose(good, np.roll(good, 0), 0.01) is None  # nothing to gain
    assert rules.choose(good // 50, bad, 0.01) is None  # too few labels
