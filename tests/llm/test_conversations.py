"""Conversation repair against all lists of edits, tried one by one."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from cobasket.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, at long, cost string"


def brute_rows(rows):
    """Rows (role, text, fault) of a conversation in order, from (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
    seen, out = set(), []
    for turn, role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else \
            "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def brute_repair(rows, costs, most):
    """The smallest (cost, edits) over all lists of edits with at most ``most`` rows put in, and the rows left."""
    best = None

    def go(i, left, cost, edits, kept):
        nonlocal best
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in kept)) and (best is None or (cost, edits) < best[:2]):
                best = cost, edits, kept
        if left:
            for role in ("user", "assistant"):
                go(i, left - 1, cost + costs.insert, edits + "I", kept + [(role, "")])
        if i < len(rows):
            _, role, text, fault = rows[i]
            go(i + 1, left, cost + costs.delete, edits + "D", kept)
            if fault not in ("blank", "duplicate"):
                stay = costs.truncated if fault else 0
                go(i + 1, left, cost + stay, edits + "K", kept + [(role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, left, cost + stay + costs.rerole, edits + "R", kept + [(other, text)])

    go(0, most, 0, "", [])
    return best


def brute_report(rows, costs=cv.Costs(), most=0):
    rows = brute_rows(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    cost, edits, kept = brute_repair(rows, costs, most)
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(r[3] == f for r in rows) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, edits,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def random_rows(rng, n):
    texts = ["Yes.", "No", "Why?", "", " \t", "Well! ", "é.", None, "x\ny."]
    return [(rng.choice([None, 0, 1, 2, 3, 4, 7, i]), rng.choice(["user", "assistant", "system", "user", "assistant", "", None,
                                                                 "tool"]), rng.choice(texts)) for i in range(n)]


def frame(spark, conversations):
    return spark.createDataFrame([(i, *row, -1, "x") for i, rows in conversations for row in rows], SCHEMA)


@pytest.mark.parametrize("page", [512, 7, 1])
def test_same_as_all_lists_of_edits(spark, page):
    rng = random.Random(page)
    known = [(i, random_rows(rng, rng.choice([1, 2, 3, 5, 6, 7]))) for i in range(60)]
    found = {r.conv_id: tuple(r)[1:] for r in cv.repair(frame(spark, known), page=page).collect()}
    assert found == {i: brute_report(rows) for i, rows in known}


def test_inserted_rows(spark):
    """Insertions pay only where they cost little; then they are in the graph, and edits may be more than rows."""
    rng = random.Random(5)
    for costs in (cv.Costs(), cv.Costs(insert=1), cv.Costs(rerole=3, delete=4, insert=2, truncated=1), cv.Costs(1, 9, 1, 0)):
        known = [(i, random_rows(rng, rng.choice([1, 2, 3, 3]))) for i in range(25)]
        found = {r.conv_id: tuple(r)[1:] for r in cv.repair(frame(spark, known), costs, page=2).collect()}
        for i, rows in known:
            want = brute_report(rows, costs, 5 if costs.insert < 5 else 2)
            assert found[i] == want, (costs, rows)
    assert any("I" in f[6] for f in found.values())


def test_a_long_conversation_is_worked_on_in_pages(spark):
    """One conversation with most of the rows: edits and counts don't depend on the pages, nor on its neighbours."""
    rng = random.Random(9)
    long = [(t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b?", "c", f"{t}!", f"{t}."]))
            for t in range(3000)]
    known = [(1, long[:4]), (2, long), (3, long[5:9])]
    reports = [sorted(map(tuple, cv.repair(frame(spark, known), page=p).collect())) for p in (4096, 100, 13)]
    assert reports[0] == reports[1] == reports[2]
    rows = [cv.Row(r[1][:1], r[3]) for r in brute_rows(long)]
    assert (reports[0][1][6], reports[0][1][7]) == cv.solved(rows, cv.Costs())
    kept = cv.repaired(frame(spark, known), page=100).filter("conv_id = 2").orderBy("position").collect()
    assert [r.position for r in kept] == list(range(1, len(kept) + 1))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == reports[0][1][8]
    assert re.fullmatch("s?(ua)+", "".join(r.role[:1] for r in kept))


def test_weights_of_paths_add_up():
    """A path cut anywhere has the weight of its two parts joined, also with rows put in."""
    rng = random.Random(3)
    for most in (0, 3):
        for _ in range(30):
            rows = [cv.Row(rng.choice("sua x"), rng.choice([None, None, "truncated", "blank"])) for _ in range(6)]
            at = rng.randrange(7)
            whole = cv.paths(rows, cv.BEGIN, cv.Costs(), most)
            parts = {}
            for (mid, i), one in cv.paths(rows[:at], cv.BEGIN, cv.Costs(), most).items():
                for (end, j), two in cv.paths(rows[at:], mid, cv.Costs(), most).items():
                    w = cv.joined(one, at + i, two, len(rows) - at + j)
                    parts[end, i + j] = min(w, parts.get((end, i + j), w))
            assert {k: parts[k] for k in whole} == whole


def test_damage(spark):
    rows = [(i, t, r, x, 0, "") for i, t in product((1, 2, None), (0, 1, 2, None)) for r, x in (("user", "Oh. Yes!"), (None, None))]
    rows = rows + rows[:1]
    found = [tuple(r) for r in cv.damage(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = []
    for i, t, r, x, *_ in rows:
        part = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        text = "" if part == 1 else re.sub("[.!?]", "", x or " ") if part == 2 else x or " "
        want += [(i, t, "user" if part == 4 else r or " ", text)] * {0: 0, 3: 2}.get(part, 1)
    assert sorted(found, key=str) == sorted(want, key=str)


def test_odd_tables(spark):
    known = [(None, [(1, "user", "A."), (2, "assistant", "B.")]), (4, [(None, None, None)] * 3), (5, [(0, "user", "x.")] * 4)]
    docs = frame(spark, known)
    every = frame(spark, [*known, (77, [(0, "user", "gone")])])
    found = {r.conv_id: tuple(r)[1:] for r in cv.repair(docs, every=every).collect()}
    assert found.pop(77) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found == {i: brute_report(rows) for i, rows in known}
    assert cv.repair(docs.limit(0)).count() == 0 and cv.repaired(docs.limit(0)).columns == ["conv_id", "position", "role", "text"]
    words = docs.selectExpr("concat('c', conv_id) AS conv_id", "turn", "role", "text")
    assert {r.conv_id for r in cv.repair(words).collect()} == {None, "c4", "c5"}
    long = [(9, [(0, "user", "y" * 1_000_000 + "."), (1, "assistant", " " * 1_000_000), (2, "assistant", ". " * 300_000)])]
    assert {r.conv_id: tuple(r)[1:] for r in cv.repair(frame(spark, long)).collect()} == {9: brute_report(long[0][1])}
