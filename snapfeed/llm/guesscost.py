"""Secret scan: fixed patterns, and values in credential contexts that are costly to guess.

Patterns (``assign``, ``access``, ``hex``): see ``pattern_spans``; matches are leftmost
and non-overlapping per kind, spans are those of the whole match in code points.

Guess costs (``guess``). A value after a credential word (``CONTEXT``), in an
authorization header or in a URL is a secret if the least log10 number of guesses for it
is ``THRESHOLD`` or more. ``Guesser`` finds that by dynamic programming over all
segmentations of the value into

* words: the share of the word among the words of the corpus, or its rank in
  ``COMMON``, whichever is cheaper, plus a factor of two for each upper-case letter
  (one for a capital or all capitals) and for each digit or mark in place of a letter;
* dates: days times years, with or without separators, and years alone;
* repeats of a unit: the unit's own cost times the number of repeats;
* keyboard walks: a start key, the length and a direction at each turn;
* brute-force spans: the size of each character's class.

Every segment but brute force pays for naming its kind. A value inside a pattern's
span is not reported twice.

How it runs. One pass finds pattern spans and context values; a vectorised pre-filter
leaves only texts that may have any to the regular expressions. The distinct values'
letter runs, read without substitutions, give the substrings that might be words. Their
hashes set bits of a map of fixed size (``MAP_BITS``), which is broadcast; a second pass
counts the words of all texts, outside of context values, that hit the map. A join of the
exact hashes brings the counts to each distinct value, which is costed once, however many
documents hold it.

Defined results: a null or empty text has no spans; rows are scanned one by one, so
repeated rows repeat; values under ``SHORTEST`` characters are no candidates; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import FOLDED_WORD_BYTES, Block, U64, slices, span_hashes, stored

KINDS = ["assign", "access", "hex", "guess"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

_WORDS = r"password|passwd|passphrase|passcode|pass|pwd|secret|token|credentials?|auth|api[_-]?key|access[_-]?key|private[_-]?key|login"
_S = r"[\t-\r ]"
CONTEXT = re.compile(rf"""(?<![A-Za-z0-9])(?:{_WORDS})["'`]?(?:{_S}{{0,8}}(?::=|=>|[:=]){_S}{{0,8}}|{_S}{{1,8}}is{_S}{{1,8}})["'`]?([^\t-\r "'`<>,;]+)""", re.I | re.A)
HEADER = re.compile(rf"(?<![A-Za-z0-9])(?:bearer|basic){_S}{{1,8}}([A-Za-z0-9+/_.=~-]+)", re.I | re.A)
URL = re.compile(r"://[^\t-\r /:@]+:([^\t-\r /@]+)@")
MAY_HAVE = (rf"""(?i)(?:{_WORDS})["'`]?(?: *[:=]|{_S}{{0,8}}(?::=|=>|[:=])|{_S}{{1,8}}is{_S})|(?:bearer|basic){_S}|://[^\t-\r /:@]+:[^\t-\r /@]+@"""
            r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}")
SHORTEST = 6
THRESHOLD = 10.0  # log10 of the guesses

# Passwords and words of passwords that are known to be common, by rank.
COMMON = """password qwerty letmein welcome admin login abc monkey dragon master iloveyou sunshine princess football baseball shadow superman batman trustno
starwars secret freedom whatever hello charlie michael jordan hunter soccer summer winter spring autumn love pass test guest user root default changeme
sample dummy placeholder required optional none null true false unknown public private token key value string name email company server mysql
oracle system demo temp temporary access account security house home family mother father brother sister daniel thomas robert george andrew jessica
jennifer ashley amanda maggie pepper ginger cookie banana orange purple yellow silver golden diamond flower butterfly chocolate computer internet samsung
google facebook killer ranger tigger buster thunder falcon eagle tiger lion bear wolf horse star moon sky blue red green black white happy lucky magic
angel devil god jesus heaven forever friend friends money power energy matrix phoenix mustang corvette ferrari porsche yankee cowboys steelers lakers
arsenal chelsea liverpool barcelona madrid london paris berlin monday friday january march april june july august october december""".split()
# Characters that stand in for letters.
STANDS_FOR = str.maketrans("@4310!5$7+", "aaeioisstt")
LONGEST_WORD, LONGEST_UNIT, LONGEST_WALK = 24, 8, 48
KIND = math.log10(5)
LEAST_COUNT = 3  # a word of the corpus occurs so often, outside of credential values
MAP_BITS = 1 << 24

_ROWS = [("`1234567890-=", 0.0), ("qwertyuiop[]\\", 1.5), ("asdfghjkl;'", 1.75), ("zxcvbnm,./", 2.25)]
_SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
_PLACE = {c: (x + shift, float(y)) for y, (keys, shift) in enumerate(_ROWS) for x, c in enumerate(keys)}
_DATES = [re.compile(p) for p in (r"(19|20)\d\d([-/._ ]?)(0?[1-9]|1[0-2])\2(0?[1-9]|[12]\d|3[01])", r"(0?[1-9]|[12]\d|3[01])([-/._ ]?)(0?[1-9]|1[0-2])\2((?:19|20)?\d\d)",
                                  r"(0?[1-9]|1[0-2])([-/._ ]?)(0?[1-9]|[12]\d|3[01])\2((?:19|20)?\d\d)", r"(19|20)\d\d")]
_DATE_COST = [math.log10(365 * 120), math.log10(365 * 120), math.log10(365 * 120), math.log10(120)]


def class_cost(c: str) -> float:
    """log10 of the size of a character's class."""
    if c.isascii():
        return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() else math.log10(33)
    return 2.0


def _step(a: str, b: str) -> tuple[float, float] | None:
    """The move from a key to a neighbouring one."""
    p, q = _PLACE.get(a), _PLACE.get(b)
    if p is None or q is None:
        return None
    move = (q[0] - p[0], q[1] - p[1])
    return move if a != b and abs(move[0]) <= 1 and abs(move[1]) <= 1 else None


def periods(value: str) -> list[list[int]]:
    """For each unit length and place: how many characters from there on equal the
    one a unit later."""
    out = []
    for unit in range(1, min(LONGEST_UNIT, len(value) // 2) + 1):
        same = [0] * (len(value) + 1)
        for i in range(len(value) - unit - 1, -1, -1):
            same[i] = same[i + 1] + 1 if value[i] == value[i + unit] else 0
        out.append(same)
    return out


class Guesser:
    """Least guess costs of values. ``words``: log10 costs of known lower-case words."""

    def __init__(self, words: dict[str, float]):
        self.units: dict[str, float] = {}
        self.words = {w: math.log10(i + 1) for i, w in enumerate(COMMON)}
        for w, cost in words.items():
            self.words[w] = min(cost, self.words.get(w, math.inf))

    def segments(self, value: str, start: int, plain: str, keys: str, same: list[list[int]]) -> Iterator[tuple[int, float]]:
        """(end, cost) of every segment of known structure that starts here."""
        n = len(value)
        caps = subs = 0
        for end in range(start + 1, min(n, start + LONGEST_WORD) + 1):
            c = value[end - 1]
            if not plain[end - 1].isalpha():
                break
            caps += c.isupper()
            subs += c.lower() != plain[end - 1]
            if end - start > 2 and (cost := self.words.get(plain[start:end])) is not None:
                few = min(caps, 1) if caps == value[start].isupper() or caps == end - start - subs else caps
                yield end, KIND + cost + (few + subs) * math.log10(2)
        if "0" <= value[start] <= "9":
            for pattern, cost in zip(_DATES, _DATE_COST, strict=True):
                if m := pattern.match(value, start):
                    yield m.end(), KIND + cost + (math.log10(5) if m.re.groups > 1 and m[2] else 0)
        for unit, ahead in enumerate(same, 1):
            times = ahead[start] // unit + 1
            if times > 1 and times * unit > 2:
                yield start + times * unit, KIND + self.unit_cost(value[start:start + unit]) + math.log10(times)
        end, turns, before = start + 1, 0, None
        while end < min(n, start + LONGEST_WALK) and (move := _step(keys[end - 1], keys[end])) is not None:
            turns += move != before
            before = move
            end += 1
            if end - start > 2:
                shifts = sum(a != b for a, b in zip(value[start:end].lower(), keys[start:end], strict=True)) + (value[start:end] != value[start:end].lower())
                yield end, KIND + math.log10(len(_PLACE)) + turns * math.log10(6) + math.log10(end - start) + shifts * math.log10(2)

    def unit_cost(self, unit: str) -> float:
        """The cost of a unit of a repeat, without repeats in it."""
        if unit not in self.units:
            self.units[unit] = self.cost(unit, False)
        return self.units[unit]

    def cost(self, value: str, repeats: bool = True) -> float:
        """log10 of the guesses for ``value`` by its cheapest segmentation."""
        same = periods(value) if repeats else []
        lower = "".join(c.lower() if c.isascii() else c for c in value)
        plain, keys = lower.translate(STANDS_FOR), lower.translate(_SHIFTED)
        best = [0.0] + [math.inf] * len(value)
        for i, c in enumerate(value):
            best[i + 1] = min(best[i + 1], best[i] + class_cost(c))
            for end, cost in self.segments(value, i, plain, keys, same):
                best[end] = min(best[end], best[i] + cost)
        return best[-1]


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns; matches whose secret is too short are dropped."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def context_values(text: str) -> list[tuple[int, int]]:
    """Spans of the values in credential contexts, without closing punctuation."""
    found = {m.span(1) for pattern in (CONTEXT, HEADER, URL) for m in pattern.finditer(text)}
    trimmed = {(a, a + len(text[a:b].rstrip(".:!?)]}"))) for a, b in found}
    return sorted((a, b) for a, b in trimmed if b - a >= SHORTEST)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_VALUES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
_FOUND = "row bigint, doc_id bigint, spans array<struct<start:int,rank:int,end:int,kind:string>>, values array<struct<start:int,end:int,value:string>>"


def _some(texts: pa.Array) -> np.ndarray:
    """Rows that may have a span or a value."""
    return np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, MAY_HAVE), False).to_numpy(zero_copy_only=False))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            spans: list[list] = [[] for _ in range(part.num_rows)]
            values: list[list] = [[] for _ in range(part.num_rows)]
            texts = part.column("text")
            for i in _some(texts):
                text = texts[i].as_py()
                fixed = pattern_spans(text)
                spans[i] = [{"start": a, "rank": KINDS.index(k), "end": b, "kind": k} for k, a, b in fixed]
                values[i] = [{"start": a, "end": b, "value": text[a:b]} for a, b in context_values(text) if not any(x <= a and b <= y for _, x, y in fixed)]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), pa.array(spans, _SPANS), pa.array(values, _VALUES)], ["row", "doc_id", "spans", "values"])


def _runs(value: str) -> Iterator[str]:
    lower = "".join(c.lower() if c.isascii() else c for c in value)
    yield from re.findall(r"[^\W\d_]{3,}", lower.translate(STANDS_FOR))


def _pieces(value: str) -> list[str]:
    """Distinct substrings of a value that might be words."""
    return list({run[a:b] for run in _runs(value) for a in range(len(run) - 2) for b in range(a + 3, min(len(run), a + LONGEST_WORD) + 1)})


_GAPS = np.ones(256, dtype=bool)  # a word of the corpus: letters, and whatever is not ASCII
for _first, _last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _GAPS[_first:_last + 1] = False
_LETTERS = np.where(_GAPS, U64(0), FOLDED_WORD_BYTES)


def _hashes(texts: pa.Array) -> np.ndarray:
    block = Block(texts, _GAPS)
    return span_hashes(block.buf, _LETTERS, block.starts)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vid, h) of each value's pieces."""
    for batch in batches:
        for vid, value in zip(batch.column("vid").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if pieces := _pieces(value):
                h = _hashes(pa.array(pieces)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), vid)), pa.array(h)], ["vid", "h"])


def _bit(h: np.ndarray) -> np.ndarray:
    return (h.view(U64) >> U64(7)) & U64(MAP_BITS - 1)


def _counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value, bitorder="little")
        total = 0
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                h = _hashes(texts)
                own = [text[a:b] for i in _some(texts) for text in (texts[i].as_py(),) for a, b in context_values(text)]
                total += len(h)
                words, n = np.unique(h[bits[_bit(h)] > 0], return_counts=True)
                inside, less = np.unique(_hashes(pa.array(own, pa.string())), return_counts=True)  # words of the values themselves
                at = np.searchsorted(inside, words)
                known = np.isin(words, inside)
                n[known] -= less[at[known]]
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["h", "n"])
    return run


def word_counts(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """(h, n) of the corpus words among the pieces; the row of the null hash has the
    number of all words."""
    spark = docs.sparkSession
    slot = F.shiftright(F.col("h"), 7).bitwiseAND(MAP_BITS - 1)
    filled = pieces.select(F.shiftright(slot, 3).alias("byte"), F.expr("shiftleft(1, cast(shiftright(h, 7) & 7 as int))").alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(MAP_BITS // 8, dtype=np.uint8)
    for r in filled.toLocalIterator():  # at most MAP_BITS / 8 rows
        bits[r["byte"]] = r["bits"]
    return docs.select("text").mapInArrow(_counts(spark.sparkContext.broadcast(bits)), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _costed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = []
        for value, known, total in zip(*(batch.column(c).to_pylist() for c in ("value", "known", "total")), strict=True):
            words = {}
            if known:
                of = {k["h"]: k["n"] for k in known}
                pieces = _pieces(value)
                words = {p: math.log10(total / of[h]) for p, h in zip(pieces, _hashes(pa.array(pieces)).view(np.int64).tolist(), strict=True) if h in of}
            costs.append(guesser().cost(value) if not words else Guesser(words).cost(value))
        yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(costs, pa.float64())], ["value", "cost"])


@lru_cache(maxsize=1)
def guesser() -> Guesser:
    return Guesser({})


def value_costs(docs: DataFrame, values: DataFrame) -> DataFrame:
    """``values``: (value). (value, cost) of the distinct values, costed with the words
    of ``docs`` (text)."""
    values = stored(values.distinct().select(F.monotonically_increasing_id().alias("vid"), "value"), "values")
    pieces = values.mapInArrow(_exploded, "vid bigint, h bigint")
    counts = stored(word_counts(docs, pieces), "words")
    total = counts.where("h is null").select(F.col("n").alias("total"))
    known = pieces.join(counts.where(f"n >= {LEAST_COUNT}"), "h").groupBy("vid").agg(F.collect_list(F.struct("h", "n")).alias("known"))
    total = total.first()
    return values.join(known, "vid", "left").select("value", "known", F.lit(total[0] if total else 1).cast("long").alias("total")).mapInArrow(_costed, "value string, cost double")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs``: (doc_id, text, ...). (doc_id, spans) per row: spans as structs of start,
    rank, end, kind, ordered by start and kind; starts and ends in code points."""
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(docs.mapInArrow(_scan, _FOUND), "spans")
    each = found.select("row", F.explode("values").alias("v")).select("row", "v.start", "v.end", "v.value")
    if each.isEmpty():
        return found.select("doc_id", "spans")
    costs = value_costs(docs.select("text"), each.select("value")).where(F.col("cost") >= THRESHOLD).select("value")
    span = F.struct("start", F.lit(KINDS.index("guess")).alias("rank"), "end", F.lit("guess").alias("kind"))
    more = each.join(costs, "value").groupBy("row").agg(F.collect_list(span).alias("more"))
    both = found.select("row", "doc_id", "spans").join(more, "row", "left")
    return both.select("doc_id", F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", "more"))).alias("spans"))


def span_text(spans: str) -> str:
    """SQL: spans as ``kind:start:end``, comma-joined."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, cast(s.start as string), cast(s.end as string))), ',')"


def report(docs: DataFrame) -> DataFrame:
    """Counts per pattern, a digest of the pattern spans, and all spans as text."""
    base = "filter(spans, s -> s.kind <> 'guess')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]]
    return find_secrets(docs).select("doc_id", *counts, F.sha2(F.expr(span_text(base)), 256).alias("base_sha256"), F.expr(span_text("spans")).alias("spans"))
