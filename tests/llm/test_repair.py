import hashlib
import heapq
import random
import zlib

import pytest

from llm_cases import SF_SMALL
from snapfeed.llm import repair
from snapfeed.session import read_table

SPACES = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if how == 1 else "".join(c for c in text if c not in ".!?") if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text, how)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def cheapest(faults):
    """Shortest path over (cost, audit): pops in order of cost, then audit, so the
    first accepted end is the answer."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        state = said[-1:]
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(faults) and state in ("", "a"):
            return cost, audit, said
        grow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        step = lambda c, e, j, r="": heapq.heappush(heap, (cost + c, audit + e, j, said + r))
        for r in grow:
            if r != "s":
                step(5, "I", i, r)
        if i < len(faults):
            initial, fault = faults[i]
            step(2, "D", i + 1)
            if fault in ("", "t"):
                more = 5 if fault else 0
                for r in grow:
                    if r == initial:
                        step(more, "K", i + 1, r)
                    if r != "s":
                        step(1 + more, "R", i + 1, r)


def brute(conv, rows):
    """rows: (turn, role, text) after damage, in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        spoken = text.rstrip(SPACES)
        faults.append("b" if not spoken else "d" if (role, text) in seen else "t" if spoken[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit, said = cheapest([(r[1][:1], f) for r, f in zip(rows, faults, strict=True)])
    left, roles, lines = iter(rows), iter(said), []
    for edit in audit:
        if edit == "I":
            lines.append({"u": "user", "a": "assistant"}[next(roles)] + ":")
            continue
        _, role, text = next(left)
        if edit != "D":
            now = next(roles)
            lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[now]}:{text}")
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(original, after):
    return {c: brute(c, [r[1:4] for r in after if r[0] == c]) for c in {r[0] for r in original}}


def test_query_matches_brute_force(spark):
    table = read_table(spark, SF_SMALL, "conversations")
    original = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r) for r in repair.repair(repair.damage(table)).collect()}
    assert got == expected(original, damaged(original))


COLUMNS = "conv_id long, turn long, role string, text string, audit string, kind int, copies string"


def test_hard_rows(spark):
    """Nulls in every column, ties, repeated rows, odd roles, extra columns that clash."""
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 1, "user", "Hi?"), (1, None, "user", "first."), (1, 2, "assistant", None),
            (2, None, None, None), (None, None, None, None), (None, 5, "user", "x."), (None, 5, "assistant", "y."), (None, 5, "assistant", "y."),
            (3, 0, "", "no role."), (3, 9, "tool", "z."), (3, 4, "assistant", " \x0b\t"), (4, 0, "user", "é" * 50_000 + "!"), (4, 1, "assistant", "…"),
            (5, -3, "assistant", "a."), (5, 7, "assistant", "a."), (5, 8, "user", "u\n\n?  \r\n"), (5, 9, "ubuntu", "text: more.")]
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS)
    got = {r.conv_id: tuple(r) for r in repair.repair(repair.damage(table)).collect()}
    assert got == expected(rows, damaged(rows))
    plain = {r.conv_id: tuple(r) for r in repair.repair(table.drop("copies")).collect()}
    assert plain == expected(rows, [(c, t, " " if r is None else r, " " if x is None else x, 9) for c, t, r, x in rows])
    assert repair.repair(repair.damage(table.where("false"))).count() == 0


def test_all_rows_dropped(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "hello.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in repair.repair(repair.damage(table)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_segments(spark, segment):
    """One conversation with most rows, cut into segments and over tasks."""
    rng = random.Random(segment)
    rows = [(7 if i % 4 else i, rng.randrange(300), rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c!", "", f"n{i}."])) for i in range(400)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: tuple(r) for r in repair.repair(table, segment).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(rows, [(*r, 9) for r in rows])


def audits(faults):
    cells = [None] * 4
    cells[repair.NOTHING] = (0, repair.Step())
    cells = repair.inserted(cells)
    for role, fault in faults:
        cells = repair.advanced(cells, role, 1, fault in ("b", "d"), fault == "t")
    return repair.chosen(cells)


def test_random_conversations():
    rng = random.Random(5)
    for _ in range(3000):
        faults = [(rng.choice("suat "), rng.choice(["", "", "b", "d", "t"])) for _ in range(rng.randrange(12))]
        assert audits(faults) == cheapest(faults)[:2]


def test_colliding_hashes_are_verified(monkeypatch):
    """With a hash that often collides the audits stay the same."""
    monkeypatch.setattr(repair, "_MOD", 3)
    test_random_conversations()


def test_equal_paths_and_long_labels():
    root = repair.Step()
    a = repair.Step(repair.Step(root, "KD"), "RK")
    b = repair.Step(repair.Step(root, "KD"), "RD")
    assert repair.less(b, a) and not repair.less(a, b) and not repair.less(a, repair.Step(repair.Step(root, "KD"), "RK"))
    c = repair.Step(repair.Step(root, "KDI"), "RK")
    assert repair.less(c, a) and not repair.less(a, c)  # "KDI.." and "KDR..": one label begins the other
