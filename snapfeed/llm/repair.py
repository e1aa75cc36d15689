"""Conversation structure repair: the cheapest edits that give each conversation
the roles ``(s?(ua)+)?``, with the least audit on ties.

Edits per turn: Keep 0, Rerole to user / assistant 1, Delete 2; Insert an empty
user / assistant turn anywhere 5; a truncated turn that stays costs 5 more; blank
and duplicate turns must go. The audit is the edits' initials in order.

Persistent audits. The dynamic program runs over turns and the role pattern's
states (nothing yet, after system, user, assistant). The audit of a cell is a
linked ``Step`` that shares its prefix with the cells it came from and holds its
ancestors at distances 1, 2, 4, ... and a rolling hash of all labels up to it. Two
audits of equal cost are compared by their longest common prefix, found by
descending those ancestors while the hashes differ; equal hashes are then verified
label by label until the two paths are one, and a collision falls back to the
whole audits. No audit of a cell is a proper prefix of another one of equal cost
(the longer would have more inserts), so the lesser prefix stays the lesser audit
whatever follows.

How it runs. Turns shrink to (conversation, turn, role, SHA-256 of the text,
copies, faults), pre-aggregated, and are range-partitioned and sorted in that
order. Each task cuts its conversations into segments of ``SEGMENT`` rows; a
segment that starts inside a conversation is solved for all four entry states, so
a conversation with a third of all turns is spread over tasks. The segments of a
conversation are then joined in order by the same comparison, with whole segments
as labels. Last, the texts are sorted beside their conversation's audit and
hashed as a stream; one conversation's digest is sequential by its nature, but
holds no more than a batch of texts and the audit.

Defined results: a null role or text is one space; null conv_ids are one
conversation; turns sort by number (nulls first), then role, then SHA-256 of the
text, so repeated rows are adjacent and ties are settled; a conversation without
rows left (``copies`` 0) has zeros, an empty audit and the hash of the empty
string; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import stored

SEGMENT = 4096
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\f\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
BEFORE = {SYSTEM: (NOTHING,), USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
ACCEPTED = (NOTHING, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}

_MOD, _BASE = (1 << 61) - 1, 0x1F3B5D79A2C4E681 % ((1 << 61) - 1)


class Step:
    """A persistent audit: the labels from the root to here."""

    __slots__ = ("label", "depth", "hash", "up")

    def __init__(self, parent: Step | None = None, label: str = ""):
        self.label = label
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, []
            return
        value = parent.hash
        for c in label:
            value = (value * _BASE + ord(c)) % _MOD
        self.depth, self.hash = parent.depth + 1, value
        up, k, at = [parent], 0, parent
        while len(at.up) > k:
            at = at.up[k]
            up.append(at)
            k += 1
        self.up = up

    def ancestor(self, depth: int) -> Step:
        at, k = self, 0
        rise = self.depth - depth
        while rise:
            if rise & 1:
                at = at.up[k]
            rise >>= 1
            k += 1
        return at

    def labels(self, after: int = 0) -> str:
        """All labels of steps deeper than ``after``, joined."""
        out, at = [], self
        while at.depth > after:
            out.append(at.label)
            at = at.up[0]
        return "".join(reversed(out))


def verified(a: Step, b: Step) -> bool:
    """Whether two steps of equal depth and hash have equal labels."""
    while a is not b:
        if a.label != b.label:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Step, b: Step) -> bool:
    """Whether the audit of ``a`` sorts before that of ``b``."""
    if a is b:
        return False
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if x.hash == y.hash:
        same = depth
        p, q = x, y
    else:
        for k in range(len(x.up) - 1, -1, -1):
            if len(x.up) > k and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        p, q = x.up[0], y.up[0]
        same = p.depth
        if verified(p, q) and not x.label.startswith(y.label) and not y.label.startswith(x.label):
            return x.label < y.label
    return a.labels(same) < b.labels(same) if verified(p, q) else a.labels() < b.labels()


Cell = tuple[int, Step]


def better(now: Cell | None, cost: int, parent: Step, label: str) -> Cell:
    """The cheaper of a cell and a continuation, the lesser audit on ties."""
    if now is None or cost < now[0]:
        return cost, Step(parent, label)
    if cost > now[0]:
        return now
    other = Step(parent, label)
    return (cost, other) if less(other, now[1]) else now


def inserted(cells: list[Cell | None]) -> list[Cell | None]:
    """Cells with inserts after the last row; two suffice, as three come back."""
    cells = list(cells)
    for to in (USER, ASSISTANT):
        for at in BEFORE[to]:
            if cells[at] is not None:
                cells[to] = better(cells[to], cells[at][0] + INSERT, cells[at][1], "I")
    return cells


def advanced(cells: list[Cell | None], role: str, copies: int, must_go: bool, truncated: bool) -> list[Cell | None]:
    """Cells after ``copies`` equal rows, of which all but the first are duplicates."""
    after: list[Cell | None] = [None if c is None else (c[0] + DELETE, Step(c[1], "D")) for c in cells]
    if not must_go:
        more = STAYS_TRUNCATED if truncated else 0
        keeps = AFTER.get(role[:1])
        for to in (SYSTEM, USER, ASSISTANT):
            for at in BEFORE[to]:
                c = cells[at]
                if c is None:
                    continue
                if to == keeps:
                    after[to] = better(after[to], c[0] + KEEP + more, c[1], "K")
                elif to != SYSTEM:
                    after[to] = better(after[to], c[0] + REROLE + more, c[1], "R")
    if copies > 1:
        after = [None if c is None else (c[0] + DELETE * (copies - 1), Step(c[1], "D" * (copies - 1))) for c in after]
    return inserted(after)


def chosen(cells: list[Cell | None]) -> tuple[int, str]:
    """Cost and audit of the best accepted state."""
    a, b = (cells[s] for s in ACCEPTED)
    if a is None or (b is not None and (b[0] < a[0] or (b[0] == a[0] and less(b[1], a[1])))):
        a = b
    return a[0], a[1].labels()


_SEGMENTS = pa.schema([
    ("cid", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()),
    ("low", pa.int64()), ("high", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string())])
_SEGMENTS_DDL = ("cid bigint, part int, seq bigint, costs array<bigint>, audits array<string>, blank bigint, duplicate bigint, truncated bigint, "
                 "illegal bigint, turns bigint, low bigint, high bigint, first_role string, last_role string")


def _is_illegal(one: str, two: str) -> bool:
    return one + two not in ("su", "ua", "au")


class _Segment:
    """The rows of one conversation, as far as a task has them: tables from each
    entry state it may have to each exit state, and counts."""

    def __init__(self, cid: int | None, entries: tuple[int, ...], begins: bool):
        self.cid = cid
        self.tables = {}
        for e in entries:
            cells: list[Cell | None] = [None] * 4
            cells[e] = (0, Step())
            self.tables[e] = inserted(cells) if begins and e == NOTHING else cells
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first_role = self.last_role = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, cut: bool, first: bool) -> None:
        must_go = blank or not first
        self.tables = {e: advanced(cells, role, copies, must_go, cut) for e, cells in self.tables.items()}
        self.rows += 1
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - first
        self.truncated += not must_go and cut
        initial = role[:1]
        if self.last_role is None:
            self.first_role = initial
        else:
            self.illegal += _is_illegal(self.last_role, initial)
        self.illegal += (copies - 1) * _is_illegal(initial, initial)
        self.last_role = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self, part: int, seq: int) -> dict:
        costs, audits = [], []
        for e in range(4):
            for cell in self.tables.get(e, [None] * 4):
                costs.append(-1 if cell is None else cell[0])
                audits.append(None if cell is None else cell[1].labels())
        return {"cid": self.cid, "part": part, "seq": seq, "costs": costs, "audits": audits} | {
            x: getattr(self, x) for x in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_role", "last_role")}


def _segments(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        now: _Segment | None = None
        for batch in batches:
            done = []
            names = ("cid", "turn", "role", "copies", "blank", "cut", "first")
            for cid, turn, role, copies, blank, cut, first in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if now is None:  # the conversation may have begun in an earlier task, with one row or more
                    now = _Segment(cid, (NOTHING, SYSTEM, USER, ASSISTANT), True)
                elif now.cid != cid:
                    done.append(now.row(part, seq))
                    seq += 1
                    now = _Segment(cid, (NOTHING,), True)
                elif now.rows >= size:
                    done.append(now.row(part, seq))
                    seq += 1
                    now = _Segment(cid, (NOTHING, SYSTEM, USER, ASSISTANT), False)
                now.add(turn, role, copies, blank, cut, first)
            if done:
                yield from pa.Table.from_pylist(done, _SEGMENTS).to_batches()
        if now is not None:
            yield from pa.Table.from_pylist([now.row(part, seq)], _SEGMENTS).to_batches()
    return run


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_AUDITS_DDL = "cid bigint, audit string, " + ", ".join(f"{x} bigint" for x in _REPORT)
_AUDITS = pa.schema([("cid", pa.int64()), ("audit", pa.string()), *((x, pa.int64()) for x in _REPORT)])


class _Joined:
    """The segments of one conversation, joined in order."""

    def __init__(self, row: dict):
        self.row = dict(row)
        root = Step()
        self.cells: list[Cell | None] = [None if c < 0 else (c, Step(root, a)) for c, a in zip(row["costs"][:4], row["audits"][:4], strict=True)]

    def add(self, row: dict) -> None:
        cells: list[Cell | None] = [None] * 4
        for i, (c, audit) in enumerate(zip(row["costs"], row["audits"], strict=True)):
            at = self.cells[i // 4]
            if c >= 0 and at is not None:
                cells[i % 4] = better(cells[i % 4], at[0] + c, at[1], audit)
        self.cells = cells
        now = self.row
        now["illegal"] += row["illegal"] + _is_illegal(now["last_role"], row["first_role"])
        now["turns"] += row["turns"] - (row["low"] is not None and row["low"] == now["high"])
        for x in ("blank", "duplicate", "truncated"):
            now[x] += row[x]
        now["last_role"] = row["last_role"]
        now["low"] = row["low"] if now["low"] is None else now["low"]
        now["high"] = now["high"] if row["high"] is None else row["high"]

    def result(self) -> dict:
        cost, audit = chosen(self.cells)
        low, high = self.row["low"], self.row["high"]
        gaps = 0 if low is None else high - low + 1 - self.row["turns"]
        return {x: self.row[x] for x in ("cid", "blank", "duplicate", "truncated", "illegal")} | {"cost": cost, "audit": audit, "gaps": gaps}


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Joined | None = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if now is not None and now.row["cid"] == row["cid"]:
                now.add(row)
                continue
            if now is not None:
                done.append(now.result())
            now = _Joined(row)
        if done:
            yield from pa.Table.from_pylist(done, _AUDITS).to_batches()
    if now is not None:
        yield from pa.Table.from_pylist([now.result()], _AUDITS).to_batches()


_RESULT_DDL = "conv_id bigint, " + ", ".join(f"{x} bigint" for x in _REPORT) + ", audit string, repaired_sha256 string"
_RESULT = pa.schema([("conv_id", pa.int64()), *((x, pa.int64()) for x in _REPORT), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Replay:
    """Applies an audit to the rows of a conversation in order: ``role:text`` of the
    turns that result."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def _other(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return NAMES[self.state]

    def inserts(self) -> Iterator[str]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield f"{self._other()}:"

    def row(self, role: str, text: str, copies: int) -> Iterator[str]:
        for _ in range(copies):
            yield from self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = AFTER[role[:1]]
                yield f"{role}:{text}"
            elif edit == "R":
                yield f"{self._other()}:{text}"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: dict | None = None
    replay, digest, lines = Replay(""), hashlib.sha256(), 0

    def take(parts: Iterator[str]) -> None:
        nonlocal lines
        for p in parts:
            digest.update((("\n" if lines else "") + p).encode())
            lines += 1

    def result() -> dict:
        take(replay.inserts())
        return now | {"repaired_sha256": digest.hexdigest()}

    for batch in batches:
        done = []
        names = ("cid", "kind", "role", "text", "copies", "audit", *_REPORT)
        for cid, kind, role, text, copies, audit, *report in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
            if now is None or now["conv_id"] != cid:
                if now is not None:
                    done.append(result())
                now = {"conv_id": cid, "audit": audit or ""} | {x: v or 0 for x, v in zip(_REPORT, report, strict=True)}
                replay, digest, lines = Replay(audit or ""), hashlib.sha256(), 0
            if kind:
                take(replay.row(role, text, copies))
        if done:
            yield from pa.Table.from_pylist(done, _RESULT).to_batches()
    if now is not None:
        yield from pa.Table.from_pylist([result()], _RESULT).to_batches()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) damaged by a hash of their key, with
    ``copies``: 0 dropped, 2 repeated. Null roles and texts become one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    how = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce("text", space)
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(how == 4, "user").otherwise(F.coalesce("role", space)).alias("role"), text.alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("long").alias("copies"))


def repair(turns: DataFrame, segment: int | None = None) -> DataFrame:
    """``turns``: (conv_id, turn, role, text) and, if there, ``copies`` (how often
    the row counts; 0 only names the conversation). One row per conversation:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256."""
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    space = F.lit(" ")
    rows = turns.select(F.col("conv_id").cast("long").alias("cid"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), copies.alias("copies"))
    rows = rows.withColumn("h", F.unhex(F.sha2("text", 256)))
    order = ["cid", "turn", "role", "h"]

    spoken = F.rtrim(F.col("text"), F.lit(SPACES))
    marked = rows.where("copies > 0").select(*order, "copies", (spoken == "").alias("blank"), (~F.substring(spoken, -1, 1).isin(".", "!", "?")).alias("cut"))
    narrow = stored(marked.groupBy(*order).agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut")), "turns")
    earliest = narrow.groupBy("cid", "role", "h").agg(F.min(F.struct("turn")).alias("t"))
    earliest = earliest.select("cid", F.col("t.turn").alias("turn"), "role", "h", F.lit(0).cast("long").alias("copies"), F.lit(False).alias("blank"), F.lit(False).alias("cut"), F.lit(True).alias("first"))
    both = narrow.withColumn("first", F.lit(False)).unionByName(earliest)
    ordered = both.groupBy(*order).agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.max("first").alias("first"))

    ranged = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("cid", "turn", "role", "copies", "blank", "cut", "first")
    segments = stored(ranged.mapInArrow(_segments(segment or SEGMENT), _SEGMENTS_DDL), "segments")
    audits = segments.repartition("cid").sortWithinPartitions("cid", "part", "seq").mapInArrow(_joined, _AUDITS_DDL)

    beside = rows.select("cid", F.lit(1).alias("kind"), "turn", "role", "h", "copies", F.when(F.col("copies") > 0, F.col("text")).otherwise("").alias("text"))
    beside = audits.withColumn("kind", F.lit(0)).unionByName(beside, allowMissingColumns=True)
    streamed = beside.repartition("cid").sortWithinPartitions("cid", "kind", "turn", "role", "h")
    return streamed.select("cid", "kind", "role", "text", "copies", "audit", *_REPORT).mapInArrow(_digests, _RESULT_DDL)
