import math
import re
from collections import Counter

import numpy as np
import pytest

from llm_cases import HARD, SF_SMALL
from snapfeed.llm import blockrank
from snapfeed.session import read_table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, best=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:best], 1)]
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk, sample, batch", [(1_000_000, 4096, 50_000), (700, 1, 50_000), (2_000, 8, 60)])
def test_matches_brute_force(spark, monkeypatch, chunk, sample, batch):
    """The same ranks with one chunk, exact thresholds and one batch, and with many
    chunks, thresholds from a small sample and many batches."""
    monkeypatch.setattr(blockrank, "CHUNK_POSTINGS", chunk)
    monkeypatch.setattr(blockrank, "SAMPLED_ALL", sample)
    monkeypatch.setattr(blockrank, "BATCH_TERMS", batch)
    docs, items = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "benchmark")
    items = items.limit(8) if batch < 100 else items  # a small fixture
    best = 5 if batch < 100 else 50
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], best)
    assert rows(blockrank.search(docs, items, best)) == sorted(want, key=str)


def test_hard_rows(spark, hard, no_docs):
    """Nulls, empty and long texts, ties, repeated rows on both sides, extra columns."""
    queries = [(1, "ONE two. three", "x"), (1, "ONE two. three", "x"), (2, None, "x"), (3, "", "x"), (None, "word5 end été", "x"), (4, "line-line 😀 😀", None),
               (5, "nothing here matches", "x"), (6, " ".join(f"word{i}" for i in range(30_000)), "x")]
    items = spark.createDataFrame(queries, "item_id long, text string, doc_id string")
    assert rows(blockrank.search(hard, items)) == sorted(brute([r[:2] for r in HARD], [q[:2] for q in queries]), key=str)
    assert blockrank.search(no_docs, items).count() == 0 and blockrank.search(hard, items.where("false")).count() == 0
    assert blockrank.search(hard, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_end_at_ascii_marks_only():
    import pyarrow as pa

    texts = ["a_b-c\x00d\x7fe", "É«naïve»9Z", "", None, "x" * 2_000_000]
    block, hashes = blockrank.terms_of(pa.array(texts))
    assert block.counts.tolist() == [len(terms(t)) for t in texts]
    assert hashes[0] == blockrank.terms_of(pa.array(["...A!"]))[1][0]


def corpus(rng, docs=600, words=300):
    """Documents of two topics over shared common words."""
    v, lengths, sizes, term, tf = [], [], [], [], []
    for d in range(docs):
        own = 30 + (d % 2) * 130 + rng.integers(0, 130, 25)
        t, n = np.unique(np.concatenate([rng.integers(0, 30, 20), own]), return_counts=True)
        lengths.append(n.sum()), sizes.append(len(t)), term.append(t), tf.append(n)
    as_u64 = lambda x: np.asarray(x).astype(np.uint64)
    packed = blockrank.pack(as_u64(lengths), as_u64(sizes), as_u64(np.concatenate(term)), as_u64(np.concatenate(tf)))
    df = np.bincount(np.concatenate(term), minlength=words)
    return blockrank.Vectors(packed, blockrank.Weights.from_counts(docs, int(sum(lengths)), df))


def test_skips_blocks_but_no_answer():
    """With good thresholds most documents of the lists are skipped, and every document
    that reaches its item's threshold is a candidate."""
    rng = np.random.default_rng(3)
    v = corpus(rng)
    lists = [np.unique(np.concatenate([rng.integers(0, 30, 6), 30 + (i % 2) * 130 + rng.integers(0, 130, 12)])) for i in range(20)]
    batch = blockrank.Batch(np.arange(300, dtype=np.uint64), np.cumsum([0, *map(len, lists)]), np.concatenate(lists))
    every = np.arange(len(v))
    scores = []
    for i in range(len(batch)):
        asked = np.zeros(300, dtype=bool)
        asked[batch.item(i)] = True
        scores.append(v.scores(every, asked))
    thresholds = np.array([np.sort(s)[-10] for s in scores])
    got = set(blockrank.candidates(blockrank.build_lists(v, batch, thresholds), v, batch, thresholds).tolist())
    listed = sum(int((s > 0).sum()) for s in scores)
    assert {i * len(v) + d for i, s in enumerate(scores) for d in np.flatnonzero(s >= thresholds[i]).tolist()} <= got
    assert len(got) < 0.6 * listed


def test_histogram_floor():
    for score in [1, 2, 3, 999, 10**9, 123_456_789_012, 2**40, 2**40 - 1]:
        step = int(blockrank.step_of(np.array([score]))[0])
        assert blockrank.floor_of(step) <= score < 1.05 * blockrank.floor_of(step + 1) + 1
