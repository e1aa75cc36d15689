"""Katz backoff language model: bigrams over unigrams, Good-Turing discounts,
exactly normalised backoff weights.

Tokens are the words of a text (A-Z folded) and one end per text. The model,
with c* the Good-Turing discounted count (``discounts``), N the training tokens:

    P(w)     = c*(w) / (N + reserve)             known words and the end
    P(<unk>) = 1 - sum of P(w)                   the class of all unknown words
    P(w|h)   = c*(h w) / (c(h) + reserve)        if c(h w) > 0
             = alpha(h) * P(w)                   if c(h) > 0
             = P(w)                              else
    alpha(h) = (1 - sum P(w|h)) / (1 - sum P(w)) over the w seen after h

so every distribution sums to 1; ``reserve`` (0.1 of a count) keeps a share for
backing off where no count is discounted. The first word's history is a start
mark that is never predicted.

How it runs. Texts become chunks of about ``CHUNK_TOKENS`` tokens: documents, a
sorted vocabulary of 64-bit word hashes and the tokens as indices into it. A
chunk sends each distinct word and each distinct bigram once, with its training
count, to a bucket by hash; a bucket adds the counts up, stores them as one part
of the count table and tells each chunk the totals (and one chunk, the owner,
of each bigram that it is). So a word or pair that makes up a third of the
corpus is one entry per chunk. Owners sum P(w|h) and P(w) of their bigrams per
history; buckets of histories add these sums, which gives alpha(h), and return
it to the chunks that backed off from h. Buckets and chunks have a bounded size
and grow in number with the corpus; every step is stored in the shared folder.

Defined results: a null or empty text is one token, the end; without training
tokens P(<unk>) is 1; a null doc_id counts as the empty text in the fold; rows
are scored one by one, so repeated rows count and score repeatedly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import Block, U64, drop_stored, hash_pair, slices, stored

CHUNK_TOKENS = 2_000_000
BUCKET_TOKENS = 1_000_000
DISCOUNTED = 5  # counts up to this are discounted
RESERVE = 0.1
END, START = U64(0xE4D0000000000001), U64(0x57A27000000000FF)

WORD, PAIR = 1, 2
CHUNKS = "chunk bigint, doc_ids array<bigint>, held array<boolean>, lengths binary, vocabulary binary, tokens binary, n_tokens bigint, n_train bigint"
COUNTS = "role int, kind int, bucket int, chunk bigint, payload binary"
PARTIAL = "role int, kind int, bucket int, chunk bigint, payload binary, doc_ids array<bigint>, held array<boolean>"
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
ANSWER, TABLE, STATS, REQUEST, REST = range(5)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary(),
          "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([tuple(_TYPES[x] if i else x for i, x in enumerate(column.split(" "))) for column in ddl.split(", ")])


def _row(ddl: str, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_schema(ddl))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, integers in planes of only as many bytes as they need."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        if a.dtype.kind == "u":
            width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
            data = a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        else:
            width, data = 0, a.astype("<f8").tobytes()
        out.append(np.array([width, len(a)], dtype="<i8").tobytes() + data)
    return b"".join(out)


def unpack(data) -> list[np.ndarray]:
    out, at, data = [], 0, memoryview(data)
    while at < len(data):
        width, n = map(int, np.frombuffer(data[at:at + 16], dtype="<i8"))
        size = n * (width or 8)
        raw = np.frombuffer(data[at + 16:at + 16 + size], dtype=np.uint8)
        if width:
            full = np.zeros((n, 8), dtype=np.uint8)
            full[:, :width] = raw.reshape(width, n).T
            out.append(full.reshape(-1).view("<u8"))
        else:
            out.append(raw.view("<f8"))
        at += 16 + size
    return out


def pack_keys(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """Sorted keys as steps (of 5 or 6 bytes in practice), with aligned arrays."""
    return pack(keys[:1], np.diff(keys), *others)


def unpack_keys(data) -> list[np.ndarray]:
    first, steps, *others = unpack(data)
    keys = np.empty(len(first) + len(steps), dtype=U64)
    if len(first):
        keys[0] = first[0]
        keys[1:] = steps
        keys = np.cumsum(keys, dtype=U64)
    return [keys, *others]


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of sorted keys starts, and the end."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    held: list = []  # blocks of this chunk
    size = 0

    def flush():
        nonlocal held, size, seq
        ids = [i for x in held for i in x[0]]
        out = np.concatenate([x[1] for x in held])
        lengths = np.concatenate([x[2] for x in held])
        words = np.concatenate([x[3] for x in held])
        order = np.argsort(out, kind="stable")  # training documents first
        starts = np.cumsum(lengths) - lengths
        take = np.repeat(starts[order] - (np.cumsum(lengths[order]) - lengths[order]), lengths[order]) + np.arange(len(words))
        vocabulary, tokens = np.unique(words[take], return_inverse=True)
        lengths = lengths[order]
        row = {"chunk": (part << 32) + seq, "doc_ids": [ids[i] for i in order], "held": out[order].tolist(), "lengths": pack(lengths.astype(U64)),
               "vocabulary": pack_keys(vocabulary), "tokens": pack(tokens.astype(U64)), "n_tokens": len(words), "n_train": int(lengths[~out[order]].sum())}
        seq, held, size = seq + 1, [], 0
        return _row(CHUNKS, [row]).to_batches()

    for batch in batches:
        for p in slices(batch, "text"):
            block = Block(p.column("text"))
            n = block.counts + 1
            words = np.full(int(n.sum()), END, dtype=U64)
            words[np.arange(len(block.starts)) + block.doc] = block.word_hashes()
            held.append((p.column("doc_id").to_pylist(), p.column("held").to_numpy(zero_copy_only=False).astype(bool), n.astype(np.int64), words))
            size += len(words)
            if size >= CHUNK_TOKENS:
                yield from flush()
    if held:
        yield from flush()


class _Chunk:
    """A chunk read back: histories and words of each token, and its distinct pairs."""

    def __init__(self, row: dict):
        self.lengths = unpack(row["lengths"])[0].astype(np.int64)
        self.vocabulary = unpack_keys(row["vocabulary"])[0]
        self.tokens = unpack(row["tokens"])[0].astype(np.int64)
        self.n_train = row["n_train"]
        self.words = self.vocabulary[self.tokens]
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.history = np.empty_like(self.tokens)  # index into vocabulary; its length for the start
        self.history[1:] = self.tokens[:-1]
        self.history[self.firsts] = len(self.vocabulary)
        self.names = np.append(self.vocabulary, START)
        keys = hash_pair(self.names[self.history], self.words)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        new = np.empty(len(ranked), dtype=bool)
        new[:1] = True
        new[1:] = ranked[1:] != ranked[:-1]
        at = np.flatnonzero(new)
        self.pairs = ranked[at]
        self.pair_of = np.empty(len(keys), dtype=np.int64)
        self.pair_of[order] = np.cumsum(new) - 1
        self.at_first = order[at]  # a token that is this pair

    def requests(self, chunk: int, buckets: int) -> list[dict]:
        rows = []
        train = slice(0, self.n_train)
        for kind, keys, ids in ((WORD, self.vocabulary, self.tokens), (PAIR, self.pairs, self.pair_of)):
            counts = np.bincount(ids[train], minlength=len(keys)).astype(U64)
            cut = bounds(keys, buckets)
            rows += [{"role": REQUEST, "kind": kind, "bucket": b, "chunk": chunk, "payload": pack_keys(keys[i:j], counts[i:j])}
                     for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
        return rows


def _merge(table: pa.Table) -> pa.Table:
    """All requests of one bucket: totals for each, the table part, its statistics."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    kind, bucket = rows[0]["kind"], rows[0]["bucket"]
    parts = [unpack_keys(r["payload"]) for r in rows]
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    ranked, own = keys[order], counts[order].astype(np.int64)
    new = np.empty(len(ranked), dtype=bool)
    new[:1] = True
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    totals = np.add.reduceat(own, at)
    owner = np.zeros(len(keys), dtype=U64)
    having = np.flatnonzero(own)
    first = having[np.unique(group[having], return_index=True)[1]]
    owner[order[first]] = 1
    answer = np.empty(len(keys), dtype=U64)
    answer[order] = totals[group].astype(U64)
    answer = answer * U64(2) + owner
    out, start = [], 0
    for r, p in zip(rows, parts, strict=True):
        out.append({"role": ANSWER, "kind": kind, "bucket": bucket, "chunk": r["chunk"], "payload": pack(answer[start:start + len(p[0])])})
        start += len(p[0])
    seen = totals > 0
    by_count = np.bincount(np.minimum(totals[seen], DISCOUNTED + 2), minlength=DISCOUNTED + 3).astype(U64)
    out.append({"role": TABLE, "kind": kind, "bucket": bucket, "chunk": -1, "payload": pack_keys(ranked[at][seen], totals[seen].astype(U64))})
    out.append({"role": STATS, "kind": kind, "bucket": bucket, "chunk": -1, "payload": pack(by_count, np.array([totals.sum()], dtype=U64))})
    return _row(COUNTS, out)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[kind, *map(int, np.concatenate(unpack(p)))] for kind, p in zip(batch.column("kind").to_pylist(), batch.column("payload").to_pylist(), strict=True)]
        names = ["kind", *(f"n{r}" for r in range(DISCOUNTED + 3)), "total"]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], names)


def discounts(by_count: np.ndarray, largest: int = DISCOUNTED) -> np.ndarray:
    """Katz's Good-Turing discount of counts 0..largest (``by_count[r]``: how many
    entries have count r). A count whose discount isn't in (0, 1) keeps 1."""
    d = np.ones(largest + 1)
    n = [float(x) for x in by_count]
    if n[1] and n[largest + 1]:
        rest = (largest + 1) * n[largest + 1] / n[1]
        for r in range(1, largest + 1):
            if n[r] and rest != 1:
                value = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest)
                if 0 < value < 1:
                    d[r] = value
    return d


class Model:
    """The numbers that all chunks share."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, n: int):
        self.n, self.v = n, int(words.sum())
        self.words, self.pairs = discounts(words), discounts(pairs)
        freed = sum(r * float(words[r]) * (1 - self.words[r]) for r in range(1, DISCOUNTED + 1))
        self.unknown = (freed + RESERVE) / (n + RESERVE)

    def p_word(self, c: np.ndarray) -> np.ndarray:
        d = np.where(c > DISCOUNTED, 1.0, self.words[np.minimum(c, DISCOUNTED)])
        return np.where(c > 0, d * c / (self.n + RESERVE), self.unknown)

    def p_pair(self, c: np.ndarray, history: np.ndarray) -> np.ndarray:
        d = np.where(c > DISCOUNTED, 1.0, self.pairs[np.minimum(c, DISCOUNTED)])
        return d * c / (history + RESERVE)


def _answers(table: pa.Table, kind: int, n: int) -> np.ndarray:
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
    got = np.concatenate([unpack(r["payload"])[0] for r in rows]) if rows else np.zeros(0, dtype=U64)
    if len(got) != n:
        raise ValueError(f"{len(got)} answers for {n} keys")
    return got


def _evaluate(model: Model, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            c = _Chunk(row)
            words = (_answers(right, WORD, len(c.vocabulary)) >> U64(1)).astype(np.int64)
            got = _answers(right, PAIR, len(c.pairs))
            pairs, owner = (got >> U64(1)).astype(np.int64), (got & U64(1)).astype(bool)
            ends = words[np.searchsorted(c.vocabulary, END)]  # one a training text
            as_history = np.append(words, ends)
            p = model.p_word(words)

            token_words, token_pairs = words[c.tokens], pairs[c.pair_of]
            base = np.log10((token_words + 0.5) / (model.n + 0.5 * (model.v + 1)))
            seen = token_pairs > 0
            value = np.log10(np.where(seen, model.p_pair(token_pairs, as_history[c.history]), p[c.tokens]))
            backs = ~seen & (as_history[c.history] > 0)

            own = np.flatnonzero(owner)
            h, w = c.history[c.at_first[own]], c.tokens[c.at_first[own]]
            after = np.bincount(h, weights=model.p_pair(pairs[own], as_history[h]), minlength=len(c.names))
            lower = np.bincount(h, weights=p[w], minlength=len(c.names))
            needed = np.bincount(c.history[backs], minlength=len(c.names)) > 0
            used = np.flatnonzero((after > 0) | needed)
            used = used[np.argsort(c.names[used], kind="stable")]
            names = c.names[used]
            cut = bounds(names, buckets)
            for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if j > i:
                    u = used[i:j]
                    out.append({"role": REQUEST, "kind": PAIR, "bucket": b, "chunk": row["chunk"], "payload": pack_keys(names[i:j], after[u], lower[u], needed[u].astype(U64))})
            asked = used[needed[used]]  # alpha comes back in this order
            place = np.zeros(len(c.names), dtype=np.int64)
            place[asked] = np.arange(len(asked))
            doc = np.repeat(np.arange(len(c.lengths)), c.lengths)
            sums = [np.add.reduceat(x, c.firsts) for x in (base, value, (token_words > 0).astype(np.int64))]
            payload = pack(c.lengths.astype(U64), sums[2].astype(U64), sums[0], sums[1], doc[backs].astype(U64), place[c.history[backs]].astype(U64))
            out.append({"role": REST, "kind": 0, "bucket": 0, "chunk": row["chunk"], "payload": payload, "doc_ids": row["doc_ids"], "held": row["held"]})
        return _row(PARTIAL, out)
    return run


def _alphas(table: pa.Table) -> pa.Table:
    """All sums of one bucket of histories: the backoff weights that chunks asked for."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    parts = [unpack_keys(r["payload"]) for r in rows]
    names = np.concatenate([p[0] for p in parts])
    distinct, group = np.unique(names, return_inverse=True)
    after, lower = (np.bincount(group, weights=np.concatenate([p[i] for p in parts]), minlength=len(distinct)) for i in (1, 2))
    alpha = np.log10((1 - after) / (1 - lower))
    out, start = [], 0
    for r, p in zip(rows, parts, strict=True):
        asked = p[3].astype(bool)
        if asked.any():
            out.append({"role": ANSWER, "kind": PAIR, "bucket": r["bucket"], "chunk": r["chunk"], "payload": pack(alpha[group[start:start + len(asked)]][asked])})
        start += len(asked)
    return _row(COUNTS, out)


def _finish(model: Model):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        alpha = [unpack(r["payload"])[0] for r in sorted(right.to_pylist(), key=lambda r: r["bucket"])]
        alpha = np.concatenate(alpha) if alpha else np.zeros(0)
        tables = []
        for row in left.to_pylist():
            lengths, known, base, value, doc, place = unpack(row["payload"])
            value = value + np.bincount(doc.astype(np.int64), weights=alpha[place.astype(np.int64)], minlength=len(lengths))
            n = len(lengths)
            tables.append(pa.Table.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(lengths.astype(np.int64)),
                                                pa.array(known.astype(np.int64)), pa.array(np.full(n, model.n, dtype=np.int64)), pa.array(base), pa.array(value)], schema=_schema(SCORES)))
        return pa.concat_tables(tables) if tables else _schema(SCORES).empty_table()
    return run


def _count(chunks: DataFrame, buckets: int) -> DataFrame:
    """Answers, count tables and statistics of all buckets, stored."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from _row(COUNTS, _Chunk(row).requests(row["chunk"], buckets)).to_batches()

    light = chunks.withColumns({"doc_ids": F.lit(None).cast("array<bigint>"), "held": F.lit(None).cast("array<boolean>")})
    asked = light.mapInArrow(ask, COUNTS)
    return stored(asked.groupBy("kind", "bucket").applyInArrow(_merge, COUNTS), "counts", ["role"])


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def score(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """Learn from the rows of (doc_id, text) that are not ``held`` and score all."""
    spark = docs.sparkSession
    held = held_out(F.col("doc_id")) if held is None else held
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held.alias("held"))
    chunks = stored(docs.mapInArrow(_chunks, CHUNKS), "chunks")
    tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-tokens // BUCKET_TOKENS))

    counts = _count(chunks, buckets)
    drop_stored(spark)
    names = [f"n{r}" for r in range(DISCOUNTED + 3)] + ["total"]
    listed = counts.where(F.col("role") == STATS).mapInArrow(_statistics, "kind int, " + ", ".join(f"{x} bigint" for x in names))
    stats = {r["kind"]: [r[x] for x in names] for r in listed.groupBy("kind").agg(*(F.sum(x).alias(x) for x in names)).collect()}
    nothing = [0] * len(names)
    words = stats.get(WORD, nothing)
    model = Model(np.array(words[:-1], dtype=float), np.array(stats.get(PAIR, nothing)[:-1], dtype=float), words[-1])

    answers = counts.where(F.col("role") == ANSWER)
    partial = stored(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_evaluate(model, buckets), PARTIAL), "partial", ["role"])
    drop_stored(spark, chunks, counts)
    sums = partial.where(F.col("role") == REQUEST).select("role", "kind", "bucket", "chunk", "payload")
    alphas = sums.groupBy("bucket").applyInArrow(_alphas, COUNTS)
    rest = partial.where(F.col("role") == REST).groupBy("chunk")
    return rest.cogroup(alphas.groupBy("chunk")).applyInArrow(_finish(model), SCORES)
