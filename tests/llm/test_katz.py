import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_cases import HARD, SF_SMALL
from snapfeed.llm import katz
from snapfeed.session import read_table

import llm_brute as brute


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def brute_scores(docs):
    tokens = [(i, [*brute.folded(t), "\n"]) for i, t in docs]
    train = [t for i, t in tokens if not held(i)]
    words, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["\t", *t], t))
    n, v = sum(words.values()), len(words)
    tally = lambda c: np.bincount([min(x, 7) for x in c.values()], minlength=8)
    d1, d2 = katz.discounts(tally(words)), katz.discounts(tally(pairs))
    starred = lambda c, d: c * (d[c] if c < len(d) else 1)
    p1 = {w: starred(c, d1) / (n + katz.RESERVE) for w, c in words.items()}
    unknown = math.fsum([1, *(-p for p in p1.values())])
    of = Counter()
    for (h, _), c in pairs.items():
        of[h] += c
    p2 = {(h, w): starred(c, d2) / (of[h] + katz.RESERVE) for (h, w), c in pairs.items()}
    seen, lower = defaultdict(list), defaultdict(list)
    for (h, w), p in p2.items():
        seen[h].append(p)
        lower[h].append(p1[w])
    seen, lower = ({h: math.fsum(v) for h, v in d.items()} for d in (seen, lower))
    alpha = {h: (1 - seen[h]) / (1 - lower[h]) for h in seen}
    for h in list(of)[:200]:  # the distribution after h sums to 1
        rest = 1 - lower[h]
        assert abs(seen[h] + alpha[h] * rest - 1) < 1e-9 and alpha[h] > 0
    out = []
    for i, t in tokens:
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = 0.0
        for h, w in zip(["\t", *t], t):
            score += math.log10(p2[h, w] if (h, w) in p2 else alpha.get(h, 1.0) * p1.get(w, unknown))
        out.append((i, held(i), len(t), sum(w in words for w in t), n, base, score))
    return out


@pytest.mark.parametrize("chunk, bucket", [(2_000_000, 1_000_000), (9_000, 4_000)])
def test_matches_brute_force(spark, monkeypatch, chunk, bucket):
    """The same scores with one chunk and bucket and with many of them."""
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    docs = read_table(spark, SF_SMALL, "documents").repartition(3)
    got = {r.doc_id: tuple(r) for r in katz.score(docs).collect()}
    for want in brute_scores([(r.doc_id, r.text) for r in docs.collect()]):
        assert got[want[0]][:5] == want[:5]
        assert got[want[0]][5:] == pytest.approx(want[5:], rel=1e-9)
    model, base = (sum(r[k] for r in got.values() if r[1]) for k in (6, 5))
    assert model > base


def test_hard_rows(hard, no_docs):
    got = sorted((tuple(r) for r in katz.score(hard).collect()), key=str)
    want = sorted(brute_scores([(d, t) for d, t, *_ in HARD]), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
    assert katz.score(no_docs).count() == 0


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(60) if held(i)], "doc_id long, text string")
    for r in katz.score(docs).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 3 and r.base_score == 0 and r.score == 0


def test_packing():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    counts, sums = np.arange(1000).astype(np.uint64), np.linspace(-1, 1, 1000)
    a, b, c = katz.unpack_keys(katz.pack_keys(keys, counts, sums))
    assert (a == keys).all() and (b == counts).all() and (c == sums).all()
    assert [len(x) for x in katz.unpack_keys(katz.pack_keys(keys[:0], counts[:0]))] == [0, 0]
