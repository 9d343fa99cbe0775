"""Conversation repair against trying every edit list."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

import __spark_entry__ as contract
from threadloom.llm import repair

GOOD = re.compile("(s?(ua)+)?")
SPACE = "[\x20\x09-\x0d]"


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(f"{SPACE}+$", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def every_repair(rows, faults, most_inserted=2):
    """(cost, letters, kept lines) of all edit lists with few insertions at a place, whether they are good or not."""
    def go(at, inserted, cost, letters, lines):
        if inserted < most_inserted:
            for role in ("user", "assistant"):
                yield from go(at, inserted + 1, cost + 5, letters + "I", [*lines, f"{role}:"])
        if at == len(rows):
            yield cost, letters, lines
            return
        _, role, text = rows[at]
        yield from go(at + 1, 0, cost + 2, letters + "D", lines)
        if faults[at] in ("blank", "duplicate"):
            return
        more = 5 if faults[at] == "truncated" else 0
        yield from go(at + 1, 0, cost + more, letters + "K", [*lines, f"{role}:{text}"])
        for other in ("user", "assistant"):
            yield from go(at + 1, 0, cost + 1 + more, letters + "R", [*lines, f"{other}:{text}"])

    yield from go(0, 0, 0, "", [])


def brute(rows):
    good = (x for x in every_repair(rows, plain_faults(rows)) if GOOD.fullmatch("".join(line[0] for line in x[2])))
    return min(good, key=lambda x: (x[0], x[1]))


def forward(rows):
    """The same by a table over rows and states, keeping (cost, letters, lines) of each."""
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", [])}

    def put(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def inserted(table):
        for _ in range(3):
            for state, (cost, letters, lines) in list(table.items()):
                put(table, nxt[state], (cost + 5, letters + "I", [*lines, f"{name[nxt[state]]}:"]))
        return table

    for (_, role, text), fault in zip(rows, plain_faults(rows)):
        after = {}
        more = 5 if fault == "truncated" else 0
        for state, (cost, letters, lines) in inserted(best).items():
            put(after, state, (cost + 2, letters + "D", lines))
            if fault not in ("blank", "duplicate"):
                if (role[:1] == "s" and state == "") or (role[:1] in name and role[:1] == nxt[state]):
                    put(after, role[:1], (cost + more, letters + "K", [*lines, f"{role}:{text}"]))
                put(after, nxt[state], (cost + 1 + more, letters + "R", [*lines, f"{name[nxt[state]]}:{text}"]))
        best = after
    return min((x for s, x in inserted(best).items() if s in ("", "a")), key=lambda x: x[:2])


def random_rows(rng, n):
    texts = ["Yes.", "No", " \t", "", "Why?", "ok!", "so\n", "b.", "c.", "d."]
    return [(k, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", " "]), rng.choice(texts) if rng.random() < 0.4 else f"t{k}.") for k in range(n)]


def mended(rows):
    found = repair.repaired([{"turn": t, "role": r, "text": x} for t, r, x in rows], set())
    lines = [f"{e['role']}:{e['text']}" for e in found["edits"] if e["edit"] != "D"]
    return found["cost"], "".join(e["edit"] for e in found["edits"]), lines


def test_cheapest_edits():
    rng = random.Random(2)
    for t in range(150):
        rows = random_rows(rng, t % 4)
        assert mended(rows) == brute(rows) == forward(rows)
    for _ in range(300):
        rows = random_rows(rng, rng.randint(0, 60))
        assert mended(rows) == forward(rows)


def test_long_runs():
    """Runs of thousands of equal symbols: powers, not steps, and the same letters as the plain table."""
    rows = [(k, "user", f"u{k}.") for k in range(1000)] + [(k, "assistant", f"a{k}") for k in range(1000, 1500)] + [(k, "user", "") for k in range(1500, 2500)]
    cost, letters, lines = mended(rows)
    wanted = forward(rows[:1500])
    assert (cost, letters, lines) == (wanted[0] + 2000, wanted[1] + "D" * 1000, wanted[2])
    symbol = ("u", False)
    slow = repair.IDENTITY
    for _ in range(13):
        slow = repair.product(slow, repair.power(symbol, 0))
    fast = repair.product(repair.product(repair.power(symbol, 3), repair.power(symbol, 2)), repair.power(symbol, 0))
    assert slow == fast


def reported(rows):
    faults = plain_faults(rows)
    cost, letters, lines = forward(rows)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, sha


@pytest.mark.parametrize("piece_rows", [7, 4096])
def test_repair(spark, piece_rows):
    """Conversations within one task, over many pieces, with null ids and turns, repeated rows and long texts."""
    rng = random.Random(piece_rows)
    talks = {k: random_rows(rng, rng.randint(1, 12)) for k in range(40)}
    talks[100] = [(k // 2, r, x) for k, r, x in random_rows(rng, 400)]
    talks[101] = [(None, r, x) for _, r, x in random_rows(rng, 60)]
    talks[102] = [(5, "user", "same.")] * 90
    talks[103] = [(0, "user", "q " * 200_000 + "."), (9, "assistant", "a.")]
    talks[104] = [(None, None, None), (2, "user", None), (3, None, "x.")]
    talks[None] = random_rows(rng, 30)
    flat = [(c, t, r, x, "extra", 1) for c, rows in talks.items() for t, r, x in rows]
    rng.shuffle(flat)
    frame = spark.createDataFrame(flat, "conv_id bigint, turn bigint, role string, text string, edits string, cost int").repartition(3)
    pieces = repair.repair(frame, piece_rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.report(pieces, frame).collect()}
    assert set(got) == set(talks)
    for c, rows in talks.items():
        rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert got[c] == reported(rows), c
    assert repair.repair(frame.where("false")).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(12)
    rows = [(c, t, r, x) for c in range(120) for t, r, x in random_rows(rng, rng.randint(1, 9))]
    rows += [(next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "Gone.")]
    rows += [(500, None, None, None), (None, 1, "user", "Hi."), (None, None, "assistant", "So.")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in contract.queries()["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    left: dict = {c: [] for c, *_ in rows}
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
        left[c] += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == {c: reported(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c, v in left.items()}
    assert any(not v for v in left.values())
