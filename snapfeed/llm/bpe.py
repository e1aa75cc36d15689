"""BPE encoding and decoding with a tokenization automaton.

``Automaton`` compiles a merge list into a deterministic automaton over tokens
by successive merge gadgets. It starts as one state with a loop for every
byte. The gadget of a merge ``a b -> c`` works on the state ``q`` that arcs
labelled ``a`` lead to, if it has an arc ``b``: arcs labelled ``a`` are led to a
copy of ``q`` without the arc ``b``, and every state with an arc ``a`` gets an
arc ``c`` to where ``b`` led. A merge whose ``q`` has no arc ``b`` can never
happen, so its token gets no arcs. All arcs with one label lead to the same
state throughout, so the arcs are stored as a table ``target[label]`` plus the
arcs that are missing (``removed``: state, label -> number of the merge that
took it away); a copy inherits what its parent lacked at that time, and an arc
``c`` exists exactly where ``a`` existed when it was added. Every byte string
then has exactly one accepted token path, the BPE tokenization. Encoding a
pre-split word finds that path by table look-ups, longest label first; decoding
emits the labels of the arcs.

Defined results: a null or empty text has no tokens and decodes to the empty
text; rows are encoded one by one, so ties and repeated rows give repeated
results; the literal text of a special token becomes that token, as the
tokenizers library does by default. Extra columns are passed over.
"""

from __future__ import annotations

import functools
import hashlib
import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from snapfeed.llm.common import slices

# Fixed values of the byte-level pre-tokenizer: the word pattern and the
# printable character that stands for each byte.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

NEVER = 1 << 60
CACHE_WORDS = 250_000  # about 12 MB; dropped at the end of a task
CACHE_ARCS = 500_000
TEXT_BYTES = 2 << 20  # of the texts encoded together
WORDS, LONGEST, FEW = 20_000, 64, 50  # words encoded side by side, their bytes, and how many go alone
SPACE, LETTER, NUMBER, OTHER = range(4)


def byte_characters() -> dict[str, int]:
    """Character -> byte: printable bytes stand for themselves, the others for
    the code points from 256 on."""
    own = {chr(b): b for b in PRINTABLE}
    rest = [b for b in range(256) if chr(b) not in own]
    return own | {chr(256 + i): b for i, b in enumerate(rest)}


class Table:
    """A map from 64-bit keys (not -1) to integers that is read for whole arrays: open
    addressing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, room: int = 0):
        bits = max(4, int(2 * max(len(keys), room)).bit_length())
        self.mask, self.shift, self.used = (1 << bits) - 1, np.uint64(64 - bits), 0
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int32)
        self.add(np.asarray(keys, dtype=np.int64), np.asarray(values, dtype=np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet; there must be room."""
        self.used += len(keys)
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == -1)
            free = free[np.unique(at[free], return_index=True)[1]]  # one key a slot
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            left = np.ones(len(keys), dtype=bool)
            left[free] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 where a key is missing."""
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class Automaton:
    """The compiled automaton of one merge list; see the module docstring."""

    def __init__(self, vocab: dict[str, int], merges: list, specials: dict[str, int]):
        byte_of = byte_characters()
        self.specials = dict(specials)
        self.label: dict[int, bytes] = {}
        for token, i in vocab.items():
            if all(c in byte_of for c in token):
                self.label[i] = bytes(byte_of[c] for c in token)
        for token, i in specials.items():
            self.label[i] = token.encode()
        self.left: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.target: dict[int, int] = {}
        self.removed: dict[int, int] = {}  # state << 20 | token -> merge number
        # per state: itself and the states it was copied from, each with the last
        # merge number whose removals it shares
        self.chains: list[tuple[tuple[int, int], ...]] = [((0, NEVER),)]
        self.lacking: set[int] = set()  # states with removals of their own
        labels_to = [1]  # the start keeps state 0 for itself
        for c in byte_of:
            if c in vocab:
                i = vocab[c]
                self.left[i], self.born[i], self.target[i] = -1, -1, 0
                labels_to[0] += 1
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            first, second, whole = vocab[a], vocab[b], vocab[a + b]
            if first not in self.target or second not in self.target or whole in self.target:
                continue
            q, goes_to = self.target[first], self.target[second]
            if not self.has_arc(q, second):
                continue
            if labels_to[q] > 1 or first == second:  # "a a": the arc that stays is needed after "aa"
                labels_to[q] -= 1
                copy = len(self.chains)
                self.chains.append(((copy << 20, NEVER), *((at, min(until, rank - 1)) for at, until in self.chains[q] if at in self.lacking)))
                labels_to.append(1)
                q = self.target[first] = copy
            self.removed[q << 20 | second] = rank
            self.lacking.add(q << 20)
            self.left[whole], self.born[whole], self.target[whole] = first, rank, goes_to
            labels_to[goes_to] += 1
        self.words = {self.label[i]: i for i in self.target}
        self.arcs = Table([], [], CACHE_ARCS)  # state << 20 | token -> 1 for an arc, as used so far
        steps: dict[int, int] = {}  # token trie: node << 8 | byte -> node
        token_at = [-1]
        for word, i in self.words.items():
            node = 0
            for byte in word:
                child = steps.get(node << 8 | byte)
                if child is None:
                    child = steps[node << 8 | byte] = len(token_at)
                    token_at.append(-1)
                node = child
            token_at[node] = i
        self.steps: dict[int, int] = {}  # the trie and arcs again, as single words ask for them
        self.known: dict[int, bool] = {}
        self.trie = Table(np.fromiter(steps.keys(), np.int64), np.fromiter(steps.values(), np.int64))
        self.token_at = np.array(token_at, dtype=np.int32)
        size = max(self.label, default=-1) + 1
        self.goes_to, self.length = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for i, to in self.target.items():
            self.goes_to[i], self.length[i] = to, len(self.label[i])
        del self.words, self.target

    def has_arc(self, state: int, token: int) -> bool:
        """An arc exists if it was never removed and, when it was added, the arc of
        its left part was there."""
        removed, chains, left, born = self.removed, self.chains, self.left, self.born
        limit = NEVER
        while True:
            for at, until in chains[state]:
                when = removed.get(at | token)
                if when is not None and when <= limit and when <= until:
                    return False
            first = left[token]
            if first < 0:
                return True
            limit, token = born[token], first

    def has_arcs(self, keys: np.ndarray) -> np.ndarray:
        """``has_arc`` for an array of state << 20 | token."""
        out = self.arcs.get(keys)
        if (out < 0).any():
            new = np.unique(keys[out < 0])
            if self.arcs.used + len(new) > CACHE_ARCS:
                self.arcs = Table([], [], max(CACHE_ARCS, len(new)))
                new = np.unique(keys)
            self.arcs.add(new, np.array([self.has_arc(k >> 20, k & 0xFFFFF) for k in new.tolist()], dtype=np.int32))
            out = self.arcs.get(keys)
        return out > 0

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word's only accepted path."""
        return self.encode_array(pa.array(words, pa.large_binary())).to_pylist()

    def encode_array(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The same for an array of words, all side by side.

        A prefix of a word has exactly one accepted path too, so a label that ends it
        is its last one if the path of what stands before has an arc for it. From
        each place that a path reaches, the tables give the labels that start there
        and the arcs of the path's state; the paths are read off backwards."""
        if len(words) < FEW:
            return pa.array([self._encode_alone(w) for w in words.to_pylist()], pa.large_binary())
        data, cuts = _bytes_of(words)
        lens = np.diff(cuts)
        order = np.argsort(lens, kind="stable")  # words of like length together
        short = int(np.searchsorted(lens[order], LONGEST, side="right"))
        tokens, counts = [], []
        for at in range(0, short, WORDS):
            some = order[at:min(at + WORDS, short)]
            t, n = self._encode_block(data, cuts[some], lens[some])
            tokens.append(t)
            counts.append(n)
        for i in order[short:].tolist():
            tokens.append(np.frombuffer(self._encode_alone(words[i].as_py()), dtype="<u4"))
            counts.append(np.array([len(tokens[-1])]))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return _binary(np.concatenate(tokens), 4 * _cuts(np.concatenate(counts))).take(pa.array(place))

    def encode_word(self, word: bytes) -> list[int]:
        return np.frombuffer(self.encode_words([word])[0], dtype="<u4").tolist()

    def _encode_alone(self, word: bytes) -> bytes:
        """The same, step by step, for a single or a long word."""
        if not self.steps:
            filled = self.trie.keys >= 0
            self.steps = dict(zip(self.trie.keys[filled].tolist(), self.trie.values[filled].tolist(), strict=True))
        n, last = len(word), [-1] * (len(word) + 1)
        known = self.known
        if len(known) > CACHE_ARCS // 4:
            known.clear()
        for start in range(n):
            if start and last[start] < 0:
                continue
            state, node = int(self.goes_to[last[start]]) if start else 0, 0
            for end in range(start, n):
                node = self.steps.get(node << 8 | word[end], -1)
                if node < 0:
                    break
                token = int(self.token_at[node])
                if token >= 0 and last[end + 1] < 0:
                    key = state << 20 | token
                    if key not in known:
                        known[key] = self.has_arc(state, token)
                    if known[key]:
                        last[end + 1] = token
        path = []
        while n:
            if last[n] < 0:
                raise ValueError("no token path for a word; the vocabulary lacks single bytes")
            path.append(last[n])
            n -= int(self.length[last[n]])
        return np.array(path[::-1], dtype="<u4").tobytes()

    def _encode_block(self, data: np.ndarray, at: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places of ``data``, and how many each has."""
        n, widest = len(lens), int(lens.max(initial=0))
        rows = np.zeros((widest, n), dtype=np.int64)  # byte by byte
        for i in range(widest):
            rows[i] = data[np.minimum(at + i, len(data) - 1)]
        last = np.full((widest + 1, n), -1, dtype=np.int32)
        for start in range(widest):
            live = np.flatnonzero((lens > start) & ((last[start] >= 0) | (start == 0)))
            state = self.goes_to[last[start, live]] << 20 if start else np.zeros(len(live), dtype=np.int64)
            node = np.zeros(len(live), dtype=np.int64)
            for end in range(start, widest):
                if not len(live):
                    break
                node = self.trie.get(node << 8 | rows[end, live]).astype(np.int64)
                keep = (node >= 0) & (lens[live] > end)
                live, state, node = live[keep], state[keep], node[keep]
                token = self.token_at[node]
                ends = np.flatnonzero((token >= 0) & (last[end + 1, live] < 0))
                ends = ends[self.has_arcs(state[ends] | token[ends])]
                last[end + 1, live[ends]] = token[ends]
        place, path = lens.copy(), []
        while (live := np.flatnonzero(place)).size:
            token = last[place[live], live]
            if (token < 0).any():
                bad = live[token < 0][0]
                raise ValueError(f"no token path for {data[at[bad]:at[bad] + lens[bad]].tobytes()!r}; the vocabulary lacks single bytes")
            path.append((live, token))
            place[live] -= self.length[token]
        word = np.concatenate([w for w, _ in reversed(path)]) if path else np.zeros(0, dtype=np.int64)
        tokens = np.concatenate([t for _, t in reversed(path)]) if path else np.zeros(0, dtype=np.int32)
        return tokens[np.argsort(word, kind="stable")].astype("<u4"), np.bincount(word, minlength=n)

    def __getstate__(self):
        return self.__dict__ | {"arcs": Table([], [], CACHE_ARCS), "lacking": set(), "steps": {}, "known": {}}


def load_automaton(path: str) -> Automaton:
    """Compile the merges of a byte-level BPE ``tokenizer.json``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return Automaton(spec["model"]["vocab"], spec["model"]["merges"], {t["content"]: t["id"] for t in spec.get("added_tokens", [])})


def _bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large string or binary array without nulls, and where each
    entry starts in them (one more than entries)."""
    if not len(array):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    cuts = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    low, high = int(cuts[0]), int(cuts[-1])
    return np.frombuffer(array.buffers()[2], dtype=np.uint8)[low:high] if high > low else np.zeros(0, dtype=np.uint8), cuts - low


def _binary(data: np.ndarray, cuts: np.ndarray) -> pa.LargeBinaryArray:
    """The array whose entries are the bytes of ``data`` between the cuts."""
    cuts = np.ascontiguousarray(cuts, dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])


def _cuts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


@functools.cache
def _kinds() -> np.ndarray:
    """For every code point the class that the word pattern puts it in."""
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[ord(every[m.start()]):ord(every[m.end() - 1]) + 1] = kind
    return out


def _code_points(buf: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """The code points of the characters of more than one byte that start at ``chars``."""
    out = buf[chars].astype(np.int64)
    size = 2 + (out >= 0xE0) + (out >= 0xF0)
    out &= 0x7F >> size
    for i in range(1, 4):
        more = size > i
        out[more] = out[more] << 6 | (buf[chars[more] + i] & 0x3F)
    return out


def word_starts(buf: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the words of ``WORD_PATTERN`` start in the UTF-8 bytes of texts that start
    at ``texts``. The words cover the texts without gaps.

    A word starts: with a text; where the class changes after a visible character;
    with the white-space character right before a visible one; with a visible
    character right after white space other than a single space. What is left to
    the contractions: one is matched at an apostrophe that starts a word."""
    n = len(buf)
    chars = None if not n or buf.max() < 0x80 else np.flatnonzero((buf & 0xC0) != 0x80)
    char = buf if chars is None else buf[chars]
    kind = _kinds()[char]
    if chars is not None:
        wide = np.flatnonzero(char >= 0x80)
        kind[wide] = _kinds()[_code_points(buf, chars[wide])]
    first = np.zeros(len(char) + 1, dtype=bool)
    first[-1] = True
    own = texts[texts < n]
    first[own if chars is None else np.searchsorted(chars, own)] = True
    start = first.copy()
    space = kind == SPACE
    start[1:-1] |= np.where(space[:-1], ~space[1:] & (char[:-1] != 0x20), kind[1:] != kind[:-1])
    start[:-2] |= space[:-1] & ~space[1:] & ~first[1:-1]
    quote = np.flatnonzero(char == 0x27)
    quote = quote[start[quote]]
    one, two = (np.where(quote + i < len(char), char[np.minimum(quote + i, max(len(char) - 1, 0))], 0) for i in (1, 2))
    one[first[quote + 1]] = 0
    two[first[np.minimum(quote + 2, len(char))]] = 0
    long = np.isin(one.astype(np.int64) << 8 | two, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])
    short = np.isin(one, list(b"stmd"))
    start[quote[long | short] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    at = np.flatnonzero(start[:-1])
    return at if chars is None else chars[at]


class _Recent:
    """The packed ids of recent words. When there are too many, those that were not
    used for the longest time go; long words are not kept."""

    def __init__(self, automaton: Automaton, most: int):
        self.automaton, self.most, self.turn = automaton, most, 0
        self.words = self.packed = pa.array([], pa.large_binary())
        self.used = np.zeros(0, dtype=np.int64)

    def of(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The packed ids of distinct words."""
        self.turn += 1
        have = len(self.words)
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(place < 0)
        place[fresh] = have + np.arange(len(fresh))
        new = words.take(pa.array(fresh))
        packed = pa.concat_arrays([self.packed, self.automaton.encode_array(new)])
        out = packed.take(pa.array(place))
        used = np.concatenate([self.used, np.zeros(len(fresh), dtype=np.int64)])
        used[place] = self.turn
        kept = np.flatnonzero(np.concatenate([np.ones(have, dtype=bool), np.diff(_bytes_of(new)[1]) <= LONGEST]))
        if len(kept) > self.most:
            kept = np.sort(kept[np.argsort(-used[kept], kind="stable")[:self.most // 2]])
        self.words, self.packed = (pa.concat_arrays([self.words, new]), packed) if len(kept) == len(used) else (
            pa.concat_arrays([self.words, new]).take(pa.array(kept)), packed.take(pa.array(kept)))
        self.used = used[kept]
        return out


class Codec:
    """Encodes and decodes blocks of texts with an automaton; keeps the ids of recent
    words, as packed little-endian 32-bit numbers.

    A block's texts are cut into words at once, each distinct word that is not
    known yet is encoded, and the ids are put together by the words' numbers: no
    step is made in Python for a single word or token."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        specials = sorted(automaton.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.recent = _Recent(automaton, CACHE_WORDS)
        self.labels = pa.array([automaton.label.get(i) for i in range(max(automaton.label, default=-1) + 1)], pa.large_binary())

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), and where each text's begin (one more
        entry than texts)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts.validate(full=True)
        specials = self.automaton.specials
        if not any(pc.any(pc.match_substring(texts, s)).as_py() for s in specials):
            return self._plain(texts)
        parts, first = [], [0]
        for text in texts.to_pylist():
            parts += self.cut.split(text)
            first.append(len(parts))
        fixed = np.array([specials.get(p, -1) for p in parts], dtype=np.int64)
        ids, at = self._plain(pa.array(["" if p in specials else p for p in parts], pa.large_string()))
        ids = np.insert(ids, at[:-1][fixed >= 0], fixed[fixed >= 0])
        return ids, (at + _cuts(fixed >= 0))[first]

    def _plain(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        buf, cuts = _bytes_of(texts)
        starts = word_starts(buf, cuts[:-1])
        words = _binary(buf, np.append(starts, len(buf))).dictionary_encode()
        ids, at = _bytes_of(self.recent.of(words.dictionary).take(words.indices))
        return ids.view("<u4"), at[np.searchsorted(starts, cuts)] // 4

    def texts(self, ids: np.ndarray | pa.Array, at: np.ndarray) -> list[str]:
        """The texts whose ids begin at ``at`` (one more entry than texts)."""
        labels = self.labels.take(ids)
        if labels.null_count:
            raise KeyError("an id without a token")
        buf, cuts = _bytes_of(labels)
        data, cuts = memoryview(buf), cuts[at].tolist()
        return [str(data[a:b], "utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def prepare(self, texts: list[str]) -> None:
        """Encode the new words of some texts together."""
        self.tokens(pa.array(texts, pa.large_string()))

    def encode(self, text: str) -> list[int]:
        return self.tokens(pa.array([text], pa.large_string()))[0].tolist()

    def decode(self, ids) -> str:
        return self.texts(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))[0]


def share_automaton(spark: SparkSession, path: str):
    """Broadcast the compiled automaton; its size is fixed by the vocabulary
    (a few MB for 50,000 merges), not by the data."""
    return spark.sparkContext.broadcast(load_automaton(path))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, batch.schema.names[1], TEXT_BYTES)


def encode(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids array<int>) of every row's whole text."""
    shared = share_automaton(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for some in _blocks(batches):
            ids, at = codec.tokens(some.column(1))
            yield pa.RecordBatch.from_arrays([some.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view("<i4")))], [id_col, ids_col])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, `{ids_col}` array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """(id, text) of every row's token ids; a null list decodes to the empty text."""
    shared = share_automaton(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            lists = batch.column(1)
            at = _cuts(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            texts = codec.texts(lists.flatten(), at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, text_col])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, `{text_col}` string")


def digests(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode and decode every text in one pass and return per row: the id,
    n_tokens, the SHA-256 of the ids (little-endian unsigned 32-bit) and of the
    decoded text. Same codec as ``encode`` and ``decode``, without moving the ids
    and texts out of the task."""
    shared = share_automaton(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for some in _blocks(batches):
            ids, at = codec.tokens(some.column(1))
            data, cuts = memoryview(ids.view(np.uint8)), (4 * at).tolist()
            of_ids = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            of_text = [hashlib.sha256(text.encode()).hexdigest() for text in codec.texts(ids, at)]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(np.diff(at)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
