"""Quality rules with risk-controlled thresholds.

A document fails the base rule if it has under 50 words or more than half of its
words lie in repeated 3-word windows. Beyond that, each rule rejects documents
whose measure (``MEASURES``, higher is worse) exceeds a cutoff chosen from
labelled documents, separately for each stratum (language):

* the labelled documents that pass the base rule are counted per stratum,
  measure, grid value and label; only these counts reach the driver (strata x
  measures x ``GRID`` at most);
* cutoffs are tested from the most lenient on. A cutoff passes if the exact
  binomial probability of at most the seen number of rejected good documents,
  were the true rate of false rejections ``RISK``, is at most ``ERROR`` divided
  by the number of (stratum, rule) tests (Bonferroni); testing stops at the
  first that doesn't pass (fixed sequence, so the grid needs no correction);
* of the passing cutoffs the one is used that rejects most bad documents, with
  ``COST`` good documents weighing as one bad; the middle one on ties. If none
  rejects bad documents on balance, the rule is off.

A stratum without enough labels to pass any cutoff uses those of all strata
together, which are tested as one more stratum.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; a null language is a stratum of its own; several labels of a doc_id
count by their majority, ties and null labels not at all; without labels only
the base rule acts; repeated rows are judged one by one; extra columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import aside, stored
from snapfeed.llm.features import text_counts

RISK = 0.05
ERROR = 0.05
COST = 20
GRID = 200
ALL = "\x00all"

_per_word = "/ greatest(n_words, 1)"
#: Measure -> (SQL over the counts, the value at the top of the grid).
MEASURES = {
    "symbols_per_word": (f"n_symbols {_per_word}", 2.0),
    "repeated_words": (f"n_repeat_words {_per_word}", 1.0),
    "repeated_lines": ("n_dup_lines / greatest(n_lines, 1)", 1.0),
    "upper_case": ("n_upper / greatest(n_letters, 1)", 1.0),
    "exclamations": (f"n_exclaim {_per_word}", 2.0),
    "same_next_word": (f"n_same_next {_per_word}", 1.0),
    "long_words": (f"word_chars {_per_word}", 40.0),
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(n - i + 1) - np.log(i))]) + np.arange(k + 1) * math.log(p) + (n - np.arange(k + 1)) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def upper_bound(k: int, n: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper bound of a rate with k of n seen."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_at_most(k, n, mid) > error else (low, mid)
    return high


@dataclass
class Cutoff:
    """Documents with a grid value above ``step`` are rejected; ``bound`` is the
    exact upper bound of the rate of false rejections at the corrected level."""

    step: int
    bound: float


def choose(good: np.ndarray, bad: np.ndarray, error: float, risk: float = RISK) -> Cutoff | None:
    """``good`` / ``bad``: labelled documents by grid value 0..GRID."""
    n = int(good.sum())
    over_good = n - np.cumsum(good)  # rejected if the cutoff is this step
    over_bad = bad.sum() - np.cumsum(bad)
    best, at = 0, []
    for step in range(GRID - 1, -1, -1):
        if n == 0 or binomial_at_most(int(over_good[step]), n, risk) > error:
            break
        gain = int(over_bad[step]) - COST * int(over_good[step])
        if gain > best:
            best, at = gain, [step]
        elif gain == best and best > 0:
            at.append(step)
    if not at:
        return None
    step = at[len(at) // 2]
    return Cutoff(step, upper_bound(int(over_good[step]), n, error))


def grid_value(measure: str) -> Column:
    sql, top = MEASURES[measure]
    return F.least(F.ceil(F.expr(sql) / top * GRID), F.lit(GRID)).cast("int")


def choose_cutoffs(counted: DataFrame, labels: DataFrame) -> dict[tuple[str, str], Cutoff]:
    """(stratum, measure) -> cutoff, from labelled documents."""
    votes = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("vote"))
    votes = votes.where("vote <> 0.5").select("doc_id", (F.col("vote") > 0.5).alias("good"))
    seen = counted.where(f"not ({BASE_FAILED})").join(votes, "doc_id")
    each = seen.select("stratum", "good", F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), grid_value(m).alias("step")) for m in MEASURES))).alias("m"))
    histogram: dict[tuple[str, str], np.ndarray] = {}
    for r in each.groupBy("stratum", "good", "m.measure", "m.step").count().collect():
        for stratum in (r["stratum"], ALL):
            histogram.setdefault((stratum, r["measure"]), np.zeros((2, GRID + 1), dtype=np.int64))[int(r["good"]), r["step"]] += r["count"]
    strata = {s for s, _ in histogram}
    error = ERROR / max(1, len(strata) * len(MEASURES))
    enough = {s: binomial_at_most(0, int(histogram[s, next(iter(MEASURES))][1].sum()), RISK) <= error for s in strata}
    out = {}
    for (stratum, measure), (bad, good) in histogram.items():
        if enough[stratum] and (cutoff := choose(good, bad, error)):
            out[stratum, measure] = cutoff
    for stratum in strata:
        for measure in MEASURES:
            if not enough[stratum] and (ALL, measure) in out:
                out[stratum, measure] = out[ALL, measure]
    return {k: v for k, v in out.items()} | {(ALL, m): out[ALL, m] for m in MEASURES if (ALL, m) in out}


def with_stratum(docs: DataFrame) -> DataFrame:
    return docs.withColumn("stratum", F.coalesce(F.col("lang").cast("string"), F.lit("")))


def count_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, counts) of every document, stored."""
    docs = with_stratum(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text")))
    return stored(text_counts(docs, ["doc_id", "stratum"]), "counted")


def verdict(counted: DataFrame, cutoffs: dict[tuple[str, str], Cutoff]) -> DataFrame:
    """Adds base_failed and kept to rows with counts and stratum."""
    strata = {s for s, _ in cutoffs} - {ALL}
    rejected = F.lit(False)
    for measure in MEASURES:
        for stratum in strata:
            if (stratum, measure) in cutoffs:
                rejected |= (F.col("stratum") == stratum) & (grid_value(measure) > cutoffs[stratum, measure].step)
        if (ALL, measure) in cutoffs:  # strata without labels
            rejected |= ~F.col("stratum").isin(*strata) & (grid_value(measure) > cutoffs[ALL, measure].step)
    return counted.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", ~F.col("base_failed") & ~rejected)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``: (doc_id, text, lang, ...); ``labels``: (doc_id, quality, ...).
    One row per document with the counts, base_failed and kept."""
    counted = count_documents(docs)
    return verdict(counted, choose_cutoffs(counted, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns. The counts are made
    a second time beside the text, which costs less than joining texts by doc_id."""
    cutoffs = choose_cutoffs(count_documents(docs), labels)
    renamed, restore = aside(docs, ["doc_id", "text", "lang"])
    return restore(verdict(text_counts(with_stratum(renamed), [*renamed.columns, "stratum"]), cutoffs).where("kept"))
