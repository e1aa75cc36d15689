"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in measures of its text. The weights are learned
from preference pairs (a document labelled 1 over one labelled 0): the
probability that a wins over b is sigmoid(score(a) - score(b)), so the logistic
loss is on the difference of the measures. Documents are then accepted above a
quantile of the training scores, the one that separates the labels best, and
scores are moved so that this quantile reads ``THRESHOLD``.

The fit uses at most ``MOST_TRAIN`` labelled documents of each label (the first
by a hash of doc_id) and ``PAIRS`` random pairs of them, a bounded sample;
everything is scored. Only texts enter a score.

Defined results: a null or empty text is scored as the empty text; several labels
of a doc_id count by their majority, ties and null labels not at all; without
training documents of both labels every score is THRESHOLD; repeated rows are
scored one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import Block, slices
from snapfeed.llm.features import counts

MOST_TRAIN = 10_000
PAIRS = 200_000
THRESHOLD = 0.7
RIDGE = 1e-3
ROUNDS = 50


def measures(block: Block) -> np.ndarray:
    """Documents x measures, each roughly in 0..3."""
    c = {k: v.astype(float) for k, v in counts(block).items()}
    words, letters, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "n_letters", "word_chars", "n_lines"))
    columns = [
        np.sqrt(c["n_symbols"] / words), np.sqrt(c["n_exclaim"] / words), np.sqrt(c["n_bars"] / words), c["n_upper"] / letters,
        c["n_repeat_words"] / words, np.sqrt(c["n_same_next"] / words), c["n_dup_lines"] / lines, np.sqrt(c["n_digits"] / chars),
        np.sqrt(c["n_stops"] / words), np.minimum(c["word_chars"] / words, 30) / 10, np.minimum(words / lines, 200) / 100,
        np.log(c["n_distinct"] + 1) / np.log(words + 1), np.log1p(c["n_words"]) / 5, (c["n_words"] < 5).astype(float),
    ]
    return np.minimum(np.column_stack(columns), 3.0)


@dataclass
class Ranker:
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    cut: float = 0.0
    spread: float = 1.0
    shift: float = field(default=float(np.log(THRESHOLD / (1 - THRESHOLD))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), THRESHOLD)
        z = np.clip((self.raw(x) - self.cut) / self.spread + self.shift, -60, 60)
        return np.where(self.raw(x) >= self.cut, np.maximum(1 / (1 + np.exp(-z)), THRESHOLD), np.minimum(1 / (1 + np.exp(-z)), np.nextafter(THRESHOLD, 0)))


def fit(good: np.ndarray, bad: np.ndarray, seed: int = 17) -> Ranker:
    """Newton steps on the pairwise logistic loss with a small ridge."""
    if not len(good) or not len(bad):
        return Ranker()
    everything = np.vstack([good, bad])
    centre, scale = everything.mean(0), np.maximum(everything.std(0), 1e-6)
    rng = np.random.default_rng(seed)
    n = min(PAIRS, len(good) * len(bad))
    d = ((good[rng.integers(0, len(good), n)] - bad[rng.integers(0, len(bad), n)]) / scale)
    w = np.zeros(d.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))
        gradient = -(d * p[:, None]).mean(0) + RIDGE * w
        curvature = (d * (p * (1 - p))[:, None]).T @ d / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    ranker = Ranker(centre, scale, w)
    g, b = np.sort(ranker.raw(good)), np.sort(ranker.raw(bad))
    edges = np.quantile(np.concatenate([g, b]), np.linspace(0, 1, 1001))
    right = (1 - np.searchsorted(g, edges) / len(g)) + np.searchsorted(b, edges) / len(b)
    best = np.flatnonzero(right == right.max())
    ranker.cut = float((edges[best[0]] + edges[best[-1]]) / 2)
    ranker.spread = float(max(np.std(np.concatenate([g, b])) / 2, 1e-6))
    return ranker


def training_fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    votes = labels.where("doc_id is not null and quality is not null").where(training_fold(F.col("doc_id")))
    votes = votes.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("vote"))
    sample = None
    for good in (True, False):
        part = votes.where("vote > 0.5" if good else "vote < 0.5").select("doc_id", F.lit(good).alias("good"))
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_TRAIN)
        sample = part if sample is None else sample.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = measures(Block(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("good"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "good", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # at most 2 x MOST_TRAIN ids
    got = rows.select("doc_id", "text", "good").mapInArrow(run, "doc_id bigint, good boolean, x array<double>").dropDuplicates(["doc_id"])
    got = sorted(got.collect(), key=lambda r: r["doc_id"])
    width = len(got[0]["x"]) if got else 0
    sides = [[r["x"] for r in got if r["good"] is g] for g in (True, False)]
    good, bad = (np.array(side, dtype=float).reshape(len(side), width) for side in sides)
    return fit(good, bad)


def classify(docs: DataFrame, ranker: Ranker, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, score and predicted for every row."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                score = ranker.score(measures(Block(part.column(text_col))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], [*keep, "score", "predicted"])

    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, f"{kinds}, score double, predicted int")
