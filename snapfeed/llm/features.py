"""Numbers about whole texts, computed block by block over UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapfeed.llm.common import LINE_BYTES, U64, Block, mixed, slices, span_hashes

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_exclaim", "n_same_next",
          "n_digits", "n_stops", "n_bars", "n_distinct"]


def _flags(*chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for group in chars:
        table[list(group.encode())] = True
    return table


SYMBOLS = _flags("#*$%&|<>")
UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = _flags("abcdefghijklmnopqrstuvwxyz")
EXCLAIM, DIGITS, STOPS, BARS = _flags("!"), _flags("0123456789"), _flags(".?,;:"), _flags("|")


def _repeats(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (doc, key) entries: which have an equal one, and which have an equal one earlier."""
    both = mixed(keys + doc.astype(U64) * U64(0xA0761D6478BD642F))
    order = np.argsort(both, kind="stable")
    ranked = both[order]
    same = ranked[1:] == ranked[:-1]
    later, any_ = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def counts(block: Block) -> dict[str, np.ndarray]:
    """Per document of the block: the numbers named in COUNTS."""
    buf, inside, doc = block.buf, block.inside, block.doc
    words = block.word_hashes(fold=False)
    n = len(words)

    windows = max(0, n - 2)
    within = doc[:windows] == doc[2:] if windows else np.zeros(0, dtype=bool)
    key = (words[:windows] * U64(0xD6E8FEB86659FD93) + words[1:windows + 1]) * U64(0xD6E8FEB86659FD93) + words[2:windows + 2]
    at = np.flatnonzero(within)
    twice, _ = _repeats(doc[at], mixed(key[at]))
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[at[twice] + k] = True

    feeds = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([block.offsets[:-1], feeds + 1]), kind="stable")
    line_doc = np.searchsorted(block.offsets[1:], np.sort(feeds), side="right")
    line_doc = np.sort(np.concatenate([np.arange(block.n), line_doc]), kind="stable")
    feed_or_end = np.sort(np.concatenate([block.offsets[1:], feeds]), kind="stable")
    ends = feed_or_end
    spoken = np.searchsorted(block.starts, ends) > np.searchsorted(block.starts, starts)
    lines = np.flatnonzero(spoken)
    total = span_hashes(buf, LINE_BYTES, np.minimum(starts[lines], max(0, len(buf) - 1)), ends[lines])
    _, again = _repeats(line_doc[lines], total)

    same_next = np.zeros(n, dtype=bool)
    if n > 1:
        same_next[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    _, seen_before = _repeats(doc, words)
    return {
        "n_words": block.counts.astype(np.int64),
        "word_chars": block.per_doc(inside & ((buf & 0xC0) != 0x80)),
        "n_symbols": block.per_doc(SYMBOLS[buf]),
        "n_dup_lines": np.bincount(line_doc[lines][again], minlength=block.n).astype(np.int64),
        "n_repeat_words": block.per_doc_words(covered),
        "n_lines": np.bincount(line_doc[lines], minlength=block.n).astype(np.int64),
        "n_upper": block.per_doc(UPPER[buf]),
        "n_letters": block.per_doc(UPPER[buf] | LOWER[buf]),
        "n_exclaim": block.per_doc(EXCLAIM[buf]),
        "n_same_next": block.per_doc_words(same_next),
        "n_digits": block.per_doc(DIGITS[buf]),
        "n_stops": block.per_doc(STOPS[buf]),
        "n_bars": block.per_doc(BARS[buf]),
        "n_distinct": block.counts - block.per_doc_words(seen_before),
    }


def text_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus COUNTS of every row's whole text (null: empty)."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                got = counts(Block(part.column(text_col)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(got[c], pa.int64()) for c in COUNTS)], [*keep, *COUNTS])

    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, ", ".join([kinds, *(f"{c} bigint" for c in COUNTS)]))
