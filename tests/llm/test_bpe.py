import hashlib
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from llm_cases import HARD
from snapfeed.llm import bpe
from snapfeed.llm.queries import tokenizer_path



@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_automaton(tokenizer_path()))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def agree(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids, repr(text)
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False), repr(text)


def test_toy_merges():
    """Every string over a, b has exactly the path that merging in order gives."""
    vocab = {c: i for i, c in enumerate(["a", "b", "aa", "ab", "aab", "aaab", "ba", "bb"])}
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "b")]
    automaton = bpe.Automaton(vocab, merges, {})
    for n in range(1, 11):
        for bits in range(1 << n):
            word = "".join("ab"[bits >> i & 1] for i in range(n))
            parts = list(word)
            for a, b in merges:
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == a and parts[i + 1] == b:
                        parts[i:i + 2] = [a + b]
                    i += 1
            assert automaton.encode_word(word.encode()) == [vocab[p] for p in parts], word


def test_random_texts(codec, library):
    rnd = random.Random(7)
    odd = [chr(x) for x in [*range(0x180), 0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000, 0xFEFF, 0x4E2D, 0x1F600, 0x301, 0x660, 0x2167, 0x10FFFF]]
    labels = [codec.automaton.label[i].decode("utf-8", "ignore") for i in codec.automaton.left]
    for k in range(1500):
        if k % 3 == 0:
            text = "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 40)))
        elif k % 3 == 1:
            text = "".join(rnd.choice(labels) for _ in range(rnd.randint(0, 20)))
        else:
            text = "".join(rnd.choice("aabhe -=_\n\t  'st.") for _ in range(rnd.randint(0, 60)))
        agree(codec, library, text + "<|endoftext|>" * (k % 50 == 0) + text * (k % 50 == 0))


def test_words_side_by_side(codec):
    """Blocks of words, single words and long words take the same paths."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("thenaiou .é") for _ in range(rnd.randint(0, 30))).encode() for _ in range(400)] + [b"ab" * 200, b"", b"x"]
    assert codec.automaton.encode_words(words) == [codec.automaton._encode_alone(w) for w in words]


def test_prepared_texts_encode_the_same(codec, library):
    texts = ["one two\nthree  four", "", "\n\n a", "three four's", "x" * 200 + " y", " lead", "one two"] * 3
    codec.prepare(texts)
    for text in texts:
        agree(codec, library, text)


def test_long_runs(codec, library):
    for text in ("a" * 5000, "-" * 3000, " " * 1000 + "x", "ab" * 2500, "\n" * 99, "x \n y", " lead", "trail "):
        agree(codec, library, text)


def test_query_digests(spark, hard, no_docs, codec, library):
    rows = bpe.digests(hard, tokenizer_path()).collect()
    want = []
    for doc_id, text, *_ in HARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.digests(no_docs, tokenizer_path()).count() == 0


def test_round_trip(spark, hard):
    encoded = bpe.encode(hard, tokenizer_path())
    back = bpe.decode(encoded, tokenizer_path())
    assert sorted((r.doc_id, r.text) for r in back.where("doc_id is not null").collect()) == sorted((d, t or "") for d, t, *_ in HARD if d is not None)


def test_no_step_for_each_word(codec):
    """New words cost no Python steps of their own (their arcs may, once)."""
    texts = [" ".join(f"word{i}x{k}" for i in range(500)) + f"\nénd's {k}" for k in range(40)]
    bpe.Codec(codec.automaton).prepare(texts)
    fresh = bpe.Codec(codec.automaton)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        fresh.prepare(texts)
    finally:
        sys.setprofile(None)
    assert calls < 40 * 500 // 10


def test_word_starts():
    """All words of many texts at once, as the pattern finds them in each."""
    rnd = random.Random(5)
    find = regex.compile(bpe.WORD_PATTERN).findall
    odd = [*"aZ09'strevldm  \n\t\r.,-", "'s", "'ll", "''t", "'re've", "\u00a0", "\u3000", "\u0301", "\u0660", "é", "中", "\U0001f600", "\x1c", "\x85", "\u2028"]
    texts = ["".join(rnd.choices(odd, k=rnd.randint(0, 12))) for _ in range(20_000)] + ["'", "s", "'", "r", "", "'l", "l"]
    data = [t.encode() for t in texts]
    cuts = np.cumsum([0] + [len(x) for x in data])
    buf = np.frombuffer(b"".join(data), dtype=np.uint8)
    want = [w.encode() for t in texts for w in find(t)]
    starts = bpe.word_starts(buf, cuts[:-1])
    assert [buf[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(buf)], strict=True)] == want


def test_every_code_point_in_its_class():
    chars = [c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    kinds = bpe._kinds()
    for kind, pattern in ((bpe.SPACE, r"\s"), (bpe.LETTER, r"\p{L}"), (bpe.NUMBER, r"\p{N}")):
        of = set(regex.findall(pattern, "".join(chars)))
        assert all((kinds[ord(c)] == kind) == (c in of) for c in chars)


def test_forgotten_words_encode_the_same(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    small = bpe.Codec(codec.automaton)
    rnd = random.Random(9)
    for _ in range(60):
        texts = [" ".join(f"{rnd.choice('abcde')}{rnd.randint(0, 40)}" for _ in range(15)) + "y" * 70 * rnd.randint(0, 1) for _ in range(3)] + [None, "a<|endoftext|><|endoftext|> b"]
        ids, at = small.tokens(pa.array(texts))
        assert len(small.recent.words) <= 20
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
        assert small.texts(ids, at) == [library.decode(i, skip_special_tokens=False) for i in want]


def test_unknown_ids_are_refused(codec):
    for ids in ([1, 10**6], [-1], [1, None]):
        with pytest.raises((KeyError, IndexError)):
            codec.texts(pa.array(ids, pa.int64()), np.array([0, len(ids)]))
